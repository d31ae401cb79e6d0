"""SentencePiece encoding with source spans, and decoding, for byte-pair models.

1. A text is normalised from left to right: at each place the longest key of the
   model's compiled character map (a double-array trie) that begins there gives
   the output, else one character stands for itself. All places of a slice walk
   down the trie together. Each output byte keeps the source byte it came from.
2. The normalised text is cut wherever two neighbouring characters stand side by
   side in no piece of the vocabulary. No merge can cross such a cut, so every
   distinct fragment of a slice is encoded once.
3. All fragments are merged together, in each round the best pair of each
   (highest score, leftmost of equals). Long fragments go through a heap.
4. A character that ends up without a piece becomes its bytes (byte fallback) or
   the unknown piece. The length of every piece in the normalised text gives its
   place there, and the alignment its span in the source.

Decoding puts pieces and bytes together again, drops control pieces and the
space that stands before the first word.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .words import slices

SPACE, REPLACEMENT = "▁".encode(), "�".encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)  # kinds of pieces in a model file
_NONE = np.int32(2**31 - 1)  # rank of a pair that is no piece
#: Fragments of more characters are merged with a heap instead of in rounds.
LONG_FRAGMENT = 64
#: Text bytes, and ids, that are worked on at once.
SLICE_BYTES, SLICE_IDS = 1 << 19, 1 << 17


# --- the model file ----------------------------------------------------------


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, message[at : at + size]
            at += size


class CharacterMap:
    """The compiled character map of a model: longest keys by double-array trie, and what they become."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").astype(np.int64)
        self.outputs = blob[4 + size :]

    def longest(self, data: np.ndarray, places: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the length of the longest key that begins there and stops by its end (0: none), and its output's place."""
        length, value = np.zeros(len(places), dtype=np.int64), np.zeros(len(places), dtype=np.int64)
        if not len(self.units):
            return length, value

        def below(node: np.ndarray, unit: np.ndarray) -> np.ndarray:
            return node ^ ((unit >> 10) << ((unit & 512) >> 6))

        alive = np.arange(len(places))
        node = below(np.zeros(len(places), dtype=np.int64), np.full(len(places), self.units[0]))
        depth = 0
        while len(alive):
            inside = places[alive] + depth < ends[alive]
            alive, node = alive[inside], node[inside]
            label = data[places[alive] + depth].astype(np.int64)
            node = node ^ label
            unit = self.units[node]
            same = (unit & 0x800000FF) == label
            alive, node, unit = alive[same], node[same], unit[same]
            node = below(node, unit)
            depth += 1
            leaf = (unit >> 8) & 1 == 1
            length[alive[leaf]] = depth
            value[alive[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        return length, value

    def output(self, value: int) -> bytes:
        return self.outputs[value : self.outputs.index(b"\0", value)]


class PieceModel:
    """A byte-pair model as arrays. Other kinds of models, user-defined or unused pieces and a denormaliser are refused."""

    def __init__(self, blob: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(blob):
            if number == 1:
                pieces.append(dict(_fields(value)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
            elif number == 5 and dict(_fields(value)).get(2):
                raise ValueError("models with a denormaliser are not supported")
        if trainer.get(3, 1) != 2:
            raise ValueError("only byte-pair models are supported")
        self.kinds = np.array([p.get(3, NORMAL) for p in pieces])
        if np.isin(self.kinds, (USER, UNUSED)).any() or trainer.get(24):
            raise ValueError("models with user-defined or unused pieces, or spaces as suffixes, are not supported")
        self.prefix, self.squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.space = SPACE if normaliser.get(5, 1) else b" "
        self.map = CharacterMap(normaliser.get(2, b""))
        self.fallback = bool(trainer.get(35, 0))
        self.unknown = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        self.unknown_text = trainer.get(44, " ⁇ ".encode())
        names = [p.get(1, b"") for p in pieces]
        self.ids_of = {name: i for i, name in enumerate(names)}
        self.begin, self.end = self.ids_of.get(trainer.get(46, b"<s>")), self.ids_of.get(trainer.get(47, b"</s>"))
        self._merges(names, [struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0] for p in pieces])
        self._surfaces(names)

    def _merges(self, names: list[bytes], scores: list[float]) -> None:
        texts = {names[i].decode(): scores[i] for i in np.flatnonzero(self.kinds == NORMAL)}
        chars = sorted({c for t in texts for c in t})
        symbols = {s: n for n, s in enumerate([*chars, *(t for t in texts if len(t) > 1)])}
        self.n_symbols = len(symbols)
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        self.symbol_of[[ord(c) for c in chars]] = np.arange(len(chars))
        self.symbol_id = np.array([self.ids_of[s.encode()] if s in texts else -1 for s in symbols], dtype=np.int64)
        self.symbol_bytes = np.array([len(s.encode()) for s in symbols], dtype=np.int64)
        order = {s: n for n, s in enumerate(sorted(set(texts.values()), reverse=True))}
        merges = sorted(
            (symbols[t[:k]] * self.n_symbols + symbols[t[k:]], order[score], symbols[t])
            for t, score in texts.items() for k in range(1, len(t)) if t[:k] in symbols and t[k:] in symbols
        )
        self.keys, self.ranks, self.merged = (np.array(c, dtype=d) for c, d in zip(zip(*merges) if merges else ((), (), ()), (np.int64, np.int32, np.int32)))
        self.table = {k: (r, m) for k, r, m in merges}
        # which characters may stand side by side within a piece
        inner = sorted({c for t in texts if len(t) > 1 for c in t})
        self.inner_of = np.zeros(0x110000, dtype=np.int32)
        self.inner_of[[ord(c) for c in inner]] = np.arange(1, len(inner) + 1)
        self.joined = np.zeros((len(inner) + 1, len(inner) + 1), dtype=bool)
        for t in texts:
            at = self.inner_of[[ord(c) for c in t]]
            self.joined[at[:-1], at[1:]] = True
        self.joined[0], self.joined[:, 0] = False, False

    def _surfaces(self, names: list[bytes]) -> None:
        surfaces, self.byte_of = [], np.full(len(names), -1)
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.byte_of[i] = int(names[i][3:-1], 16)
                surfaces.append(bytes([self.byte_of[i]]))
            elif kind == CONTROL:
                surfaces.append(b"")
            elif kind == UNKNOWN:
                surfaces.append(self.unknown_text)
            else:
                surfaces.append(names[i].replace(SPACE, b" "))
        self.spaced = np.array([n.startswith(SPACE) for n in names]) & (self.kinds == NORMAL)
        self.surface_sizes = np.array([len(s) for s in surfaces], dtype=np.int64)
        self.surface_starts = np.cumsum(self.surface_sizes) - self.surface_sizes
        self.surface_bytes = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self.surfaces = surfaces
        byte_ids = np.full(256, self.unknown)
        byte_ids[self.byte_of[self.byte_of >= 0]] = np.flatnonzero(self.byte_of >= 0)
        self.byte_ids = byte_ids


@lru_cache(maxsize=2)
def compiled(blob: bytes) -> PieceModel:
    """The model of a file's bytes, compiled once in each worker."""
    return PieceModel(blob)


# --- normalising -------------------------------------------------------------


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] of them, then those of starts[1], ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters begin, and whether they are valid; an invalid byte is one by itself."""
    raw = data.tobytes()
    try:
        raw.decode()
    except UnicodeDecodeError:
        starts, valid, at = [], [], 0
        while at < len(raw):
            size = next((n for n in range(1, 5) if _is_character(raw[at : at + n])), 0)
            starts.append(at)
            valid.append(size > 0)
            at += max(size, 1)
        return np.array(starts, dtype=np.int64), np.array(valid, dtype=bool)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return starts, np.ones(len(starts), dtype=bool)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def normalise(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of several texts, source byte of each (within its text), where texts begin, and their source ends.

    data holds the texts one after the other, offsets where each begins (and one beyond).
    """
    n_texts, sizes = len(offsets) - 1, np.diff(offsets)
    places, valid = _characters(data)
    text = np.repeat(np.arange(n_texts), np.diff(np.searchsorted(places, offsets)))
    length, value = model.map.longest(data, places, offsets[text + 1])
    steps = np.diff(np.append(places, len(data)))
    # a key of several characters hides those within it
    hidden = np.zeros(len(places), dtype=bool)
    to = 0
    for k in np.flatnonzero(length > steps):
        if places[k] >= to:
            to = places[k] + length[k]
            hidden[k + 1 : np.searchsorted(places, to)] = True
    mapped = length > 0
    outputs = {v: model.map.output(v) for v in np.unique(value[mapped & ~hidden]).tolist()}
    pool = b"".join(outputs.values()) + REPLACEMENT
    begins = np.cumsum([0, *map(len, outputs.values())])
    index = np.searchsorted(np.fromiter(outputs, dtype=np.int64, count=len(outputs)), value[mapped])
    source, size = places.copy(), steps.copy()
    source[~valid], size[~valid] = len(data) + begins[-1], len(REPLACEMENT)
    in_pool = np.minimum(index, max(len(outputs) - 1, 0))
    source[mapped], size[mapped] = len(data) + begins[:-1][in_pool] if outputs else 0, np.diff(begins)[in_pool] if outputs else 0
    shown = ~hidden
    source, size, places, text = source[shown], size[shown], places[shown], text[shown]
    every = np.concatenate([data, np.frombuffer(pool, dtype=np.uint8)])
    out = every[_ranges(source, size)]
    origin, owner = np.repeat(places - offsets[text], size), np.repeat(text, size)
    blank = out == 0x20
    ends = sizes.copy()
    first = np.zeros(n_texts, dtype=np.int64)
    filled = sizes > 0
    if model.squeeze:
        # runs of spaces become one, and none stay at the ends
        before = np.append(True, blank[:-1] | (owner[1:] != owner[:-1])) if len(out) else blank
        last = np.full(n_texts, -1)
        np.maximum.at(last, owner[~blank], np.flatnonzero(~blank))
        keep = ~(blank & before) & (np.arange(len(out)) <= last[owner])
        cut = blank & ~before & (np.arange(len(out)) > last[owner])
        ends[owner[cut]] = origin[cut]
        not_space = ~((size == 1) & (every[np.minimum(source, len(every) - 1)] == 0x20))
        first = np.full(n_texts, np.iinfo(np.int64).max)
        np.minimum.at(first, text[not_space], (places - offsets[text])[not_space])
        filled = last >= 0
        out, origin, owner, blank = out[keep], origin[keep], owner[keep], blank[keep]
    # a space before each text, and all spaces spelt as the model spells them
    counts = np.bincount(owner, minlength=n_texts)
    if model.prefix:
        at = (np.cumsum(counts) - counts)[filled]
        out, blank = np.insert(out, at, 0x20), np.insert(blank, at, True)
        origin = np.insert(origin, at, first[filled])
        counts = counts + filled
    width = np.where(blank, len(model.space), 1)
    ends_of = np.cumsum(width)
    spelt = np.repeat(out, width)
    for k, byte in enumerate(model.space):
        spelt[ends_of[blank] - len(model.space) + k] = byte
    begins, origin = np.append(0, ends_of)[np.append(0, np.cumsum(counts))], np.repeat(origin, width)
    if model.squeeze:
        spelt, origin, begins = _stripped(model.space, spelt, origin, begins, ends)
    return spelt, origin, begins, ends


def _stripped(space: bytes, spelt: np.ndarray, origin: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without the space symbols that a text itself ends in; ends is changed in place."""
    size, keep = len(space), np.ones(len(spelt), dtype=bool)
    full = np.flatnonzero(np.diff(begins) >= size)
    closing = np.ones(len(full), dtype=bool)
    for k, byte in enumerate(space):
        closing &= spelt[begins[full + 1] - size + k] == byte
    for text in full[closing]:
        to = begins[text + 1]
        while to - begins[text] >= size and spelt[to - size : to].tobytes() == space:
            to -= size
        keep[to : begins[text + 1]] = False
        ends[text] = origin[to]
    return spelt[keep], origin[keep], np.append(0, np.cumsum(keep))[begins]


# --- merging -----------------------------------------------------------------


def _lookup(model: PieceModel, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and symbol of the merge of each pair of symbols; rank _NONE if it is no piece."""
    key = left.astype(np.int64) * model.n_symbols + right
    at = np.minimum(np.searchsorted(model.keys, key), max(len(model.keys) - 1, 0))
    if not len(model.keys):
        return np.full(len(left), _NONE), left
    known = (left >= 0) & (right >= 0) & (model.keys[at] == key)
    return np.where(known, model.ranks[at], _NONE), model.merged[at]


def _merged_in_rounds(model: PieceModel, symbols: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their byte lengths and how many each fragment has, after all merges; symbols of -1 merge with nothing."""
    group = np.arange(len(counts))
    done = []
    rank, to = np.full(len(symbols), _NONE), np.zeros(len(symbols), dtype=np.int32)
    inner = np.ones(len(symbols), dtype=bool)
    inner[np.cumsum(counts) - 1] = False
    at = np.flatnonzero(inner)
    rank[at], to[at] = _lookup(model, symbols[at], symbols[at + 1])
    while len(counts):
        starts = np.cumsum(counts) - counts
        best = np.minimum.reduceat(rank, starts)
        over = best == _NONE
        if over.any():
            gone = np.repeat(over, counts)
            done.append((np.repeat(group[over], counts[over]), symbols[gone], sizes[gone]))
            symbols, sizes, rank, to = symbols[~gone], sizes[~gone], rank[~gone], to[~gone]
            counts, group, best = counts[~over], group[~over], best[~over]
            if not len(counts):
                break
            starts = np.cumsum(counts) - counts
        hits = np.flatnonzero(rank == np.repeat(best, counts))
        pos = hits[np.searchsorted(hits, starts)]
        symbols[pos] = to[pos]
        sizes[pos] += sizes[pos + 1]
        kept = np.ones(len(symbols), dtype=bool)
        kept[pos + 1] = False
        symbols, sizes, rank, to = symbols[kept], sizes[kept], rank[kept], to[kept]
        pos -= np.arange(len(pos))
        counts = counts - 1
        starts = np.cumsum(counts) - counts
        last = starts + counts - 1
        rank[last] = _NONE
        ahead, behind = pos[pos < last], pos[pos > starts] - 1
        for where in (ahead, behind):
            rank[where], to[where] = _lookup(model, symbols[where], symbols[where + 1])
    groups, symbols, sizes = (np.concatenate(c) for c in zip(*done)) if done else (np.empty(0, int), symbols, sizes)
    order = np.argsort(groups, kind="stable")
    return symbols[order], sizes[order], groups[order]


def _merged_by_heap(model: PieceModel, symbols: list[int], sizes: list[int]) -> tuple[list[int], list[int]]:
    """The same for one fragment, in time that grows with n log n."""
    ahead, behind = [*range(1, len(symbols)), -1], [-1, *range(len(symbols) - 1)]
    alive, heap = [True] * len(symbols), []

    def offer(left: int, right: int) -> None:
        if left >= 0 and right >= 0 and symbols[left] >= 0 and symbols[right] >= 0:
            found = model.table.get(symbols[left] * model.n_symbols + symbols[right])
            if found:
                heapq.heappush(heap, (found[0], left, right, symbols[left], symbols[right], found[1]))

    for k in range(1, len(symbols)):
        offer(k - 1, k)
    while heap:
        _, left, right, was_left, was_right, merged = heapq.heappop(heap)
        if not (alive[left] and alive[right] and symbols[left] == was_left and symbols[right] == was_right and ahead[left] == right):
            continue
        symbols[left], alive[right] = merged, False
        sizes[left] += sizes[right]
        ahead[left] = ahead[right]
        if ahead[right] >= 0:
            behind[ahead[right]] = left
        offer(behind[left], left)
        offer(left, ahead[left])
    kept = [k for k in range(len(symbols)) if alive[k]]
    return [symbols[k] for k in kept], [sizes[k] for k in kept]


def _fragments(model: PieceModel, raw: bytes, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, byte lengths and fragment numbers of distinct fragments of counts characters each."""
    points = np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)
    symbols = model.symbol_of[points]
    sizes = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
    long = counts > LONG_FRAGMENT
    short = np.repeat(~long, counts)
    s, z, g = _merged_in_rounds(model, symbols[short], sizes[short], counts[~long])
    numbers, parts = np.flatnonzero(~long), [(s, z, np.flatnonzero(~long)[g] if len(g) else g)]
    starts = np.cumsum(counts) - counts
    for k in np.flatnonzero(long):
        at = slice(starts[k], starts[k] + counts[k])
        a, b = _merged_by_heap(model, symbols[at].tolist(), sizes[at].tolist())
        parts.append((np.array(a, dtype=np.int32), np.array(b, dtype=np.int64), np.full(len(a), k)))
    if len(parts) == 1 and len(numbers) == len(counts):
        return parts[0]
    s, z, g = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(g, kind="stable")
    return s[order], z[order], g[order]


def encode_slice(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, begin and end of each piece in its text's source bytes, and pieces of each text."""
    spelt, origin, begins, ends = normalise(model, data, offsets)
    n_texts = len(offsets) - 1
    if not len(spelt):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, np.zeros(n_texts, dtype=np.int64)
    raw = spelt.tobytes()
    places = np.append(np.flatnonzero((spelt & 0xC0) != 0x80), len(spelt))
    inner = model.inner_of[np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)]
    cut = np.append(True, ~model.joined[inner[:-1], inner[1:]])
    cut[np.searchsorted(places, begins[:-1][np.diff(begins) > 0])] = True
    cuts = np.append(np.flatnonzero(cut), len(inner))
    bounds = places[cuts]
    fragments = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(spelt)])
    coded = fragments.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    _, first = np.unique(which, return_index=True)
    counts = np.diff(cuts)[first]
    symbols, sizes, groups = _fragments(model, b"".join(coded.dictionary.to_pylist()), counts)
    per = np.bincount(groups, minlength=len(counts))
    at = _ranges((np.cumsum(per) - per)[which], per[which])
    symbols, sizes = symbols[at], sizes[at]
    stops = np.cumsum(sizes)
    starts = stops - sizes
    ids = np.where(symbols >= 0, model.symbol_id[symbols], -1)
    owner = np.repeat(np.arange(n_texts), np.diff(np.searchsorted(starts, begins)))
    # the place after a text's last byte is its end
    after = np.append(origin, 0)[np.minimum(stops, len(origin))]
    after = np.where(stops == begins[owner + 1], ends[owner], after)
    before = origin[starts]
    lost = ids < 0
    if lost.any():
        if model.fallback:
            many = np.where(lost, sizes, 1)
            at = np.repeat(np.arange(len(ids)), many)
            inside = _ranges(np.zeros(len(many), dtype=np.int64), many)
            final = inside == many[at] - 1
            ids = np.where(lost[at], model.byte_ids[spelt[np.minimum(starts[at] + inside, len(spelt) - 1)]], ids[at])
            before, after, owner = before[at], np.where(final, after[at], before[at]), owner[at]
        else:
            # neighbouring unknown characters are one unknown piece
            same = np.append(False, lost[1:] & lost[:-1] & (owner[1:] == owner[:-1]))
            head = np.flatnonzero(~same)
            ids = np.where(lost, model.unknown, ids)[head]
            before, owner, after = before[head], owner[head], after[np.append(head[1:], len(same)) - 1]
    return ids, before, after, np.bincount(owner, minlength=n_texts)


# --- decoding ----------------------------------------------------------------


def _decoded_slowly(model: PieceModel, ids: list[int]) -> str:
    out, run, opening = [], bytearray(), True

    def flush() -> None:
        at = 0
        while at < len(run):
            size = next((n for n in range(1, 5) if _is_character(bytes(run[at : at + n]))), 0)
            out.append(bytes(run[at : at + size]).decode() if size else "�")
            at += max(size, 1)
        run.clear()

    spaced = False
    for i in ids:
        if model.byte_of[i] >= 0:
            run.append(model.byte_of[i])
            continue
        flush()
        if spaced or any(out):
            opening = False
        text, spaced = model.surfaces[i].decode(), False
        if opening and model.spaced[i] and (model.prefix or model.squeeze):
            text, spaced = text[1:], not model.squeeze
        out.append(text)
    flush()
    return "".join(out)


def decode_many(model: PieceModel, lists: list[np.ndarray]) -> list[str]:
    """The texts of lists of ids."""
    counts = np.array([len(x) for x in lists], dtype=np.int64)
    ids = np.concatenate(lists).astype(np.int64) if counts.sum() else np.empty(0, dtype=np.int64)
    sizes, starts = model.surface_sizes[ids], model.surface_starts[ids].copy()
    sizes = sizes.copy()
    owner = np.repeat(np.arange(len(lists)), counts)
    control = model.kinds[ids] == CONTROL
    real = np.flatnonzero(~control)
    head = real[np.append(True, owner[real[1:]] != owner[real[:-1]])] if len(real) else real
    slow = np.zeros(len(lists), dtype=bool)
    if model.prefix or model.squeeze:
        strip = head[model.spaced[ids[head]]]
        sizes[strip] -= 1
        starts[strip] += 1
        if model.squeeze:
            slow[owner[strip[sizes[strip] == 0]]] = True
    # a control piece between bytes parts them
    if len(real):
        last = np.full(len(lists), -1)
        np.maximum.at(last, owner[real], real)
        opening = np.full(len(lists), len(ids))
        opening[owner[head]] = head
        within = np.flatnonzero(control)
        within = within[(within > opening[owner[within]]) & (within < last[owner[within]])]
        slow[owner[within]] = True
    whole = model.surface_bytes[_ranges(starts, sizes)].tobytes() if len(ids) else b""
    ends = np.cumsum(np.bincount(owner, weights=sizes, minlength=len(lists)).astype(np.int64)) if len(lists) else counts
    out, lo = [], 0
    for k, hi in enumerate(ends.tolist()):
        try:
            text = None if slow[k] else whole[lo:hi].decode()
        except UnicodeDecodeError:
            text = None
        out.append(_decoded_slowly(model, lists[k].tolist()) if text is None else text)
        lo = hi
    return out


# --- Spark -------------------------------------------------------------------


def read_model(path: str) -> bytes:
    """The bytes of a model file that the driver can open; they travel to the tasks, a few hundred kilobytes."""
    with open(path, "rb") as file:
        blob = file.read()
    compiled(blob)
    return blob


def encode(spark: SparkSession, docs: DataFrame, model: bytes, begin: bool = True, end: bool = True) -> DataFrame:
    """row (all columns of docs as a struct), ids, starts, ends: the pieces of each text.

    starts and ends are byte places in the UTF-8 text, so that a piece stands for
    text[start:end]; begin and end ids, and all bytes but the last of a character
    that has no piece, stand for nothing. docs needs text; columns of any other
    name are carried in row. A null text is read as empty, and an empty one has
    the begin and end id only. Equal texts have equal rows, and no rows give none.
    Work memory follows a slice of half a megabyte of text, or the one text that is
    longer.
    """
    sent = spark.sparkContext.broadcast(model)
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    place = docs.schema["row"].dataType.fieldNames().index("text")

    def run(batches):
        pieces = compiled(sent.value)
        head = [pieces.begin] if begin else []
        tail = [pieces.end] if end else []
        for batch in batches:
            texts = batch.column(0).flatten()[place].cast(pa.large_binary()).fill_null(b"")
            for lo, hi in slices(texts, SLICE_BYTES):
                part = texts.slice(lo, hi - lo)
                offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
                body = part.buffers()[2]
                data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
                offsets = offsets - offsets[0]
                ids, before, after, counts = encode_slice(pieces, data, offsets)
                stops = np.cumsum(counts)
                for extra, where, source in ((head, stops - counts, np.zeros(len(counts), dtype=np.int64)), (tail, stops + len(head) * np.arange(1, len(counts) + 1), np.diff(offsets))):
                    if extra:
                        ids, before, after = (np.insert(x, where, y) for x, y in ((ids, extra[0]), (before, source), (after, source)))
                        counts = counts + 1
                bounds = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (ids, before, after)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *lists], ["row", "ids", "starts", "ends"])

    schema = StructType([StructField("row", docs.schema["row"].dataType), *StructType.fromDDL("ids array<int>, starts array<int>, ends array<int>").fields])
    return docs.mapInArrow(run, schema)


def decode(spark: SparkSession, ids: Column, model: bytes) -> Column:
    """The text of a column of ids; null for null. Ids outside the vocabulary are an error."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(StringType())
    def run(lists: pd.Series) -> pd.Series:
        pieces, out, held, size = compiled(sent.value), [], [], 0
        for one in lists:
            held.append(np.empty(0, dtype=np.int64) if one is None else np.asarray(one))
            size += len(held[-1])
            if size > SLICE_IDS:
                out += decode_many(pieces, held)
                held, size = [], 0
        out += decode_many(pieces, held)
        return pd.Series([None if one is None else text for one, text in zip(lists, out)], dtype=object)

    return run(ids)


@F.pandas_udf(StringType())
def ids_sha256(lists: pd.Series) -> pd.Series:
    """Lower-case hex of the SHA-256 of the ids as little-endian unsigned 32-bit integers."""
    return pd.Series([hashlib.sha256(np.asarray(x).astype("<u4").tobytes()).hexdigest() for x in lists], dtype=object)
