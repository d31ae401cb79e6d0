"""Words of UTF-8 texts as numpy arrays: where they stand, and 64-bit hashes of them and of runs of them.

Both word definitions separate words by ASCII bytes only, so that bytes of
longer UTF-8 sequences are always word bytes and nothing has to be decoded.
A null text has no words. Work memory follows a slice of about a megabyte, or
the one text that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Spark's SQL pattern of the same bytes: space and \\t to \\r separate.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def _table(is_word) -> np.ndarray:
    return np.array([b >= 0x80 or bool(is_word(b)) for b in range(256)])


#: Words are runs of anything but space and \\t to \\r.
BY_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words are runs of ASCII letters, digits and everything beyond ASCII.
BY_LETTER = _table(lambda b: chr(b).isalnum())

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
#: The same with A-Z read as a-z.
_FOLDED = _BYTES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BLOCK = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least n of them."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 4096) if have is None else max(n, 2 * len(have))
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[int(base)] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of x spread over 64 bits (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    """Words of several texts: bytes, where words start and end, first word of each text (and one beyond)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, fold: bool) -> np.ndarray:
        """A 64-bit hash of each word; fold: A-Z count as a-z."""
        table = _FOLDED if fold else _BYTES
        out = np.empty(len(self.starts), dtype=np.uint64)
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(self.ends, self.starts[lo] + _BLOCK, "right")))
            at, to = int(self.starts[lo]), int(self.ends[hi - 1])
            sums = np.zeros(to - at + 1, dtype=np.uint64)
            np.cumsum(table[self.data[at:to]] * powers(_BASE, to - at), out=sums[1:])
            s, e = self.starts[lo:hi] - at, self.ends[lo:hi] - at
            out[lo:hi] = mixed((sums[e] - sums[s]) * powers(_INVERSE, to - at)[s] + (e - s).astype(np.uint64))
            lo = hi
        return out


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive entries (none if there are fewer)."""
    if len(hashes) < k:
        return np.empty(0, dtype=np.uint64)
    out = np.empty(len(hashes) - k + 1, dtype=np.uint64)
    for lo in range(0, len(out), _BLOCK):
        part = hashes[lo : lo + _BLOCK + k - 1]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * powers(_BASE, len(part)), out=sums[1:])
        out[lo : lo + _BLOCK] = mixed((sums[k:] - sums[:-k]) * powers(_INVERSE, len(part))[: len(part) - k + 1])
    return out


def split(texts: pa.Array, is_word: np.ndarray) -> Words:
    """The words of a slice of texts."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    word = np.zeros(len(data) + 2, dtype=bool)
    word[1:-1] = is_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def slices(texts: pa.Array, limit: int = _BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes together; a longer text is alone."""
    sizes = np.cumsum(pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        begun = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, begun + limit, "right")))
        yield lo, hi
        lo = hi


def sliced(batch: pa.RecordBatch, text: str, is_word: np.ndarray) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """The rows of a batch, slice by slice, with the words of their texts."""
    column = batch.column(batch.schema.get_field_index(text))
    for lo, hi in slices(column):
        yield batch.slice(lo, hi - lo), split(column.slice(lo, hi - lo), is_word)
