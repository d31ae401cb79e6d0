"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

The automaton knows every run of words of every item. A document's words
stream through it; the state gives the longest run ending here that an item
holds. Where it reaches a window (WINDOW words, or a whole shorter item), the
words of the window are hit, and the state names the items.

Items are cut into blocks of bounded text by a hash of their id. Each block has
its own automaton, which goes to all tasks, and one pass over the documents;
what the passes find is united. A usual benchmark is one block.
"""

from __future__ import annotations

import math
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .scratch import Scratch
from .words import BY_LETTER

WINDOW = 13
#: Bytes of item text in a block (a longer item is a block of its own).
BLOCK_BYTES = 4 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if BY_LETTER[b] else 32 for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, other ASCII letters and digits and all beyond ASCII kept, the rest separates."""
    return (text or "").encode().translate(_LOWER).split()


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items at each window."""

    def __init__(self, items: list[list[bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = array("q", [-1]), array("q", [0])
        ids = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for words in items]
        for sequence in ids:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        #: items that hold the run of window words of a state, and the shorter items at a state
        self.long: dict[int, set[int]] = {}
        self.short: dict[int, dict[int, set[int]]] = {}
        for item, sequence in enumerate(ids):
            self._mark(item, sequence)
        self.least = min((min(len(s), window) for s in ids if s), default=0)

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(-1)
        return len(self.next) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """The child's runs up to the parent's length plus one get a state of their own."""
        copy = self._state(self.length[parent] + 1, dict(self.next[child]))
        self.link[copy], self.link[child] = self.link[child], copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state, p = self._state(self.length[last] + 1, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p < 0:
            self.link[state] = 0
        else:
            child = self.next[p][word]
            self.link[state] = child if self.length[child] == self.length[p] + 1 else self._split(p, word, child)
        return state

    def holder(self, state: int, length: int) -> int:
        """The state of the suffix of that length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest run after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0

    def _mark(self, item: int, sequence: list[int]) -> None:
        state = length = 0
        for word in sequence:
            state, length = self.step(state, length, word)
            if length >= self.window:
                self.long.setdefault(self.holder(state, self.window), set()).add(item)
        if 0 < len(sequence) < self.window:
            self.short.setdefault(self.holder(state, len(sequence)), {}).setdefault(len(sequence), set()).add(item)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans (first word, one beyond; in order of their ends) of a text, and the items of its windows."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if not self.least or len(words) < self.least:
            return spans, items
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        # only runs of known words that can hold a window are worth streaming
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo < self.least:
                continue
            state = length = 0
            for at, word in enumerate(ids[lo:hi].tolist(), lo + 1):
                state, length = self.step(state, length, word)
                if length >= self.window:
                    spans.append((at - self.window, at))
                    items |= self.long.get(self.holder(state, self.window), set())
                if self.short:
                    s = state
                    while s > 0:
                        for n, found in self.short.get(s, {}).items():
                            if n <= length:
                                spans.append((at - n, at))
                                items |= found
                        s = self.link[s]
        return spans, items


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _one_pass(found: DataFrame, kind: StructType, automaton: ItemAutomaton, names: list[str]) -> tuple[DataFrame, Broadcast]:
    """found with the hits of one block of items added, and what it sent to the tasks."""
    shared = found.sparkSession.sparkContext.broadcast((automaton, names))

    def scan(batches):
        known, item_names = shared.value
        for batch in batches:
            counts, spans, items = [], [], []
            texts = batch.column(0).field("text").cast(pa.binary()).to_pylist()
            for text, old_spans, old_items in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = (text or b"").translate(_LOWER).split()
                hits, matched = known.scan(words)
                counts.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in united(hits + [(s["start"], s["stop"]) for s in old_spans])])
                items.append(sorted({*old_items, *(item_names[i] for i in matched)}))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "spans", "items"])

    return found.mapInArrow(scan, kind), shared


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """row (all columns of docs as a struct), n_words, n_hit, spans, items of every row of docs.

    spans are the hit words as (start, stop), disjoint and in order; items the
    ids, as sorted strings, of the items with a window in the text. Items beyond
    BLOCK_BYTES of text are looked for in several passes, whose results are written
    to the shared folder in between. Null and
    empty texts have no words; items without words have no windows; rows of one
    item_id are one item, and an item without id has an empty name. No items
    hit nothing. No rows give no rows.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    found = docs.select(
        F.struct("*").alias("row"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:long,stop:long>>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    kind, scratch, before = found.schema, Scratch(spark, "contamination"), None
    for block in range(blocks):
        held = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES of text
        found, sent = _one_pass(found, kind, ItemAutomaton([normal_words(r.text) for r in held], window), [r.item for r in held])
        if block + 1 < blocks:
            # one automaton is alive at a time, on the driver and in the workers
            found = scratch.keep(found)
            sent.destroy()
            if before is not None:
                scratch.drop(before)
            before = found
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("row", "n_words", n_hit.alias("n_hit"), "spans", "items")


def cut(text: str | None, spans: list) -> str:
    """The text without the words of disjoint spans in order, and without what separates those of a span."""
    raw = (text or "").encode()
    words = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_LOWER))]
    out, at = [], 0
    for span in spans:
        out.append(raw[at : words[span["start"]][0]])
        at = words[span["stop"] - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW, longest: int | None = None, coverage: float = 0.05) -> DataFrame:
    """docs without the rows whose hit words are at least coverage of their words.

    With longest, spans of more words than that are cut from the texts that
    stay; all else, and every text without such a span, stays as it is.
    """
    found = contamination(spark, docs, items, window).where(~((F.col("n_hit") > 0) & (F.col("n_hit") >= F.lit(coverage) * F.col("n_words"))))
    if longest is None:
        return found.select("row.*")
    long = F.filter("spans", lambda s: s["stop"] - s["start"] > longest)
    text = F.when(F.size(long) > 0, F.udf(cut, StringType())("row.text", long)).otherwise(F.col("row.text"))
    return found.select(F.col("row").withField("text", text).alias("row")).select("row.*")
