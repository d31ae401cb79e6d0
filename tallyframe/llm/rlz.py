"""Substring dedup by relative Lempel-Ziv parsing: words of passages that stand anywhere else go.

A run of WINDOW words in a row with the same smallest run of SEED words (their
anchor) makes a piece of a document: the words of these windows. Equal windows have
equal anchors at equal offsets; so only pieces whose anchor stands somewhere else go
on, and all windows that can be equal meet in the reference block of their anchor.
A block joins its distinct pieces to one reference of words, indexed by a suffix
array. Each piece is factored greedily against it: a factor is the longest match of
the words from its first word on with any other place of the reference, a word
without a match is a literal. Factors of WINDOW words or more are duplicate spans.
Windows across the boundary of two factors are in neither, so each is looked up in
the index by itself, and is a span if all of it stands elsewhere.

Documents are dealt into groups and packed; groups ask for anchors, send their
distinct pieces and get back spans, and the text is shuffled once. A passage of a
third of all documents costs one row for each group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .groups import number_of_groups, packed, unpacked
from .words import BY_SPACE, Words, runs, sliced

WINDOW = 35
SEED = 6


class Pieces(NamedTuple):
    """Of some texts: the hash of every word, and of each piece the anchor, its first window and its number of windows."""

    words: np.ndarray
    anchors: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def of(self, i: int, window: int) -> bytes:
        """The word hashes of a piece; its last window ends with its last word."""
        lo = self.starts[i]
        return self.words[lo : lo + self.sizes[i] + window - 1].tobytes()


def pieces_of(words: Words, window: int) -> Pieces:
    """The pieces of all texts; a text of fewer than window words has none. Windows are numbered by their first word."""
    hashes = words.hashes(fold=False)
    seed = min(SEED, window)
    seeds = runs(hashes, seed)
    counts = words.counts()
    within = np.arange(len(hashes)) - np.repeat(words.first[:-1], counts)
    at = np.flatnonzero(within + window <= np.repeat(counts, counts))
    if not len(at):
        empty = np.empty(0, dtype=np.int64)
        return Pieces(hashes, empty.astype(np.uint64), empty, empty)
    width = window - seed + 1
    views = np.lib.stride_tricks.sliding_window_view(seeds, width)
    place = np.concatenate([views[at[lo : lo + 65536]].argmin(axis=1) for lo in range(0, len(at), 65536)]) + at
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))))
    return Pieces(hashes, seeds[place[new]], at[new], np.diff(np.append(new, len(at))))


def _read(blobs: pd.Series, window: int) -> Iterator[tuple[pa.RecordBatch, Words, Pieces]]:
    for batch in unpacked(blobs):
        for rows, words in sliced(batch, "text", BY_SPACE):
            yield rows, words, pieces_of(words, window)


def _ask(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """The anchors of a group, and how many pieces have them."""
    anchors = [p.anchors for _, _, p in _read(pdf["docs"], window)]
    anchors, n = np.unique(np.concatenate(anchors) if anchors else np.empty(0, np.uint64), return_counts=True)
    return pd.DataFrame({"group": pdf["group"].iloc[0], "anchor": anchors.view(np.int64), "n": n})


def _print(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "big", signed=True)


def _shared(pieces: Pieces, anchors: np.ndarray) -> np.ndarray:
    """Numbers of the pieces whose anchor is one of the given."""
    return np.flatnonzero(np.isin(pieces.anchors, anchors))


def _send(pdf: pd.DataFrame, told: pd.DataFrame, window: int, blocks: int) -> pd.DataFrame:
    """The distinct pieces of a group with shared anchors, and how often they stand in it."""
    known, found = told["anchor"].to_numpy().astype(np.int64).view(np.uint64), {}
    if len(known):
        for _, _, pieces in _read(pdf["docs"], window):
            for i in _shared(pieces, known):
                key = int(pieces.anchors[i]), pieces.of(i, window)
                found[key] = found.get(key, 0) + 1
    anchors = np.array([a for a, _ in found], dtype=np.uint64)
    return pd.DataFrame({
        "block": (anchors % np.uint64(blocks)).astype(np.int64),
        "group": pdf["group"].iloc[0] if len(pdf) else 0,
        "n": list(found.values()),
        "piece": [s for _, s in found],
    })


def longest_matches(words: np.ndarray) -> np.ndarray:
    """For each place of the reference, how many words from there on also stand at some other place.

    By a suffix array: ranks of runs of 1, 2, 4, ... words, until no two places are
    equal; neighbours in the final order are compared run by run, longest first.
    """
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1]
    levels = [rank]
    while n and rank.max() < n - 1:
        step = 1 << (len(levels) - 1)
        follows = np.append(rank[step:], np.full(min(step, n), -1))[:n]
        rank = np.unique(rank * (n + 1) + follows + 1, return_inverse=True)[1]
        levels.append(rank)
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    one, other = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), dtype=np.int64)
    for level in range(len(levels) - 2, -1, -1):
        inside = (one < n) & (other < n)
        same = inside & (levels[level][np.minimum(one, n - 1)] == levels[level][np.minimum(other, n - 1)])
        for part in (one, other, common):
            part += same.astype(np.int64) << level
    longest = np.zeros(n, dtype=np.int64)
    longest[order[:-1]] = common
    longest[order[1:]] = np.maximum(longest[order[1:]], common)
    return longest


def factors(longest: np.ndarray) -> list[tuple[int, int]]:
    """Greedy factors (start, length) of a piece, from the longest match at each of its places; words without one are literals."""
    out, at, n = [], 0, len(longest)
    longest = longest.tolist()
    while at < n:
        length = longest[at]
        if length:
            out.append((at, length))
        at += length or 1
    return out


def duplicate_windows(longest: np.ndarray, window: int, boundaries: bool = True) -> list[tuple[int, int]]:
    """Runs (first, beyond the last) of a piece's windows that stand elsewhere: those within factors, and across their boundaries.

    Without boundaries, windows that no factor contains are not looked up.
    """
    found = np.zeros(len(longest) + 1, dtype=bool)
    for start, length in factors(longest):
        inner = max(start, start + length - window + 1)
        found[start:inner] = True
        if boundaries:
            found[inner : start + length] = longest[inner : start + length] >= window
    edges = np.flatnonzero(np.diff(np.concatenate(([False], found[:-1], [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def parse_block(rows: list[bytes], copies: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """Duplicate windows of each distinct piece of a block; all of a piece that stands more than once."""
    sizes = np.array([len(r) // 8 for r in rows], dtype=np.int64)
    known, ids = np.unique(np.frombuffer(b"".join(rows), dtype=np.uint64), return_inverse=True)
    # a word of its own after each piece, which no match crosses
    reference = np.insert(ids, np.cumsum(sizes), len(known) + np.arange(len(rows)))
    longest, out, lo = longest_matches(reference), [], 0
    for size, n in zip(sizes.tolist(), copies.tolist()):
        own = longest[lo : lo + size]
        if n > 1:
            out.append([(0, size - window + 1)])
        else:
            out.append(duplicate_windows(own, window) if own.max(initial=0) >= window else [])
        lo += size + 1
    return out


def _parse(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """(group, print, spans) of the pieces of a block that have duplicate windows."""
    distinct = pdf.groupby("piece", sort=True)["n"].sum()
    spans = dict(zip(distinct.index, parse_block(list(distinct.index), distinct.to_numpy(), window)))
    prints = {s: _print(s) for s, found in spans.items() if found}
    own = pdf[pdf["piece"].map(prints.__contains__)]
    return pd.DataFrame({
        "group": own["group"],
        "print": own["piece"].map(prints),
        "spans": pd.Series([[x for span in spans[s] for x in span] for s in own["piece"]], index=own.index, dtype=object),
    })


def _remove(pdf: pd.DataFrame, told: pd.DataFrame, window: int) -> pd.DataFrame:
    """The texts of a group without the words of duplicate windows."""
    known = dict(zip(told["print"], told["spans"])) if len(told) else {}
    ids, texts, n_words, n_removed = [], [], [], []
    for rows, words, pieces in _read(pdf["docs"], window):
        change = np.zeros(len(words.starts) + 1, dtype=np.int64)
        if known:
            for i, lo in enumerate(pieces.starts.tolist()):
                spans = known.get(_print(pieces.of(i, window)))
                if spans is not None:
                    for a, b in zip(spans[::2], spans[1::2]):
                        change[lo + a] += 1
                        change[lo + b - 1 + window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        raw = words.data.tobytes()
        ids += rows.column(0).to_pylist()
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            stay = np.flatnonzero(~gone[a:b]) + a
            texts.append(b" ".join(raw[s:e] for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist())).decode())
            n_words.append(b - a)
            n_removed.append(b - a - len(stay))
    return pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "text": texts, "n_words": n_words, "n_removed": n_removed})


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text (the kept words, one space apart), n_words, n_removed of every row of docs (doc_id, text).

    A word is removed if it lies in a run of window words that starts at any
    other place, in the same row or another one; all copies go. Words are cut
    at ASCII white space and compared as they are. Null and empty texts have no
    words. Repeated rows are each other's copies, whatever their ids. Words are
    compared by 64-bit hashes. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    groups = number_of_groups(docs)
    dealt = packed(docs, groups, ["doc_id", "text"])
    asked = dealt.groupBy("group").applyInPandas(lambda pdf: _ask(pdf, window), "group long, anchor long, n long")
    # a row for each group and anchor, however often the passage stands in the group
    total = F.sum("n").over(Window.partitionBy("anchor"))
    answers = asked.withColumn("total", total).where("total > 1").select("group", "anchor")
    sent = dealt.groupBy("group").cogroup(answers.groupBy("group")).applyInPandas(
        lambda pdf, told: _send(pdf, told, window, groups), "block long, group long, n long, piece binary"
    )
    found = sent.groupBy("block").applyInPandas(lambda pdf: _parse(pdf, window), "group long, print long, spans array<long>")
    return dealt.groupBy("group").cogroup(found.groupBy("group")).applyInPandas(
        lambda pdf, told: _remove(pdf, told, window), "doc_id long, text string, n_words long, n_removed long"
    )
