"""Language by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. Three
letters in a row become one vector: the first is rotated twice, the second
once, and the three are multiplied. A text's vector is the sum over its letter
triples, a language's prototype the sum over its texts. The prediction is the
prototype of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import mixed, slices

DIMENSION = 1024
UNKNOWN = "und"
_CHUNK = 4096
_SPACE = 32
_letters: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Lower-cased letter of each code point; everything else is a space."""
    if not _letters:
        table = np.full(0x110000, _SPACE, dtype=np.int64)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _letters.append(table)
    return _letters[0]


def triples(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct letter triples of a text, 21 bits for each letter, and their counts; a space is put around words."""
    codes = _fold()[np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)]
    codes = np.concatenate(([_SPACE], codes, [_SPACE]))
    codes = codes[np.concatenate(([True], (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)))]
    if len(codes) < 3:  # no letter
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


def _letter_vectors(codes: np.ndarray) -> np.ndarray:
    seeds = codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, DIMENSION // 64 + 1, dtype=np.uint64)
    bits = np.unpackbits(mixed(mixed(seeds)).view(np.uint8).reshape(len(codes), -1), axis=1)
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def _vectors(keys: np.ndarray) -> np.ndarray:
    mask = (1 << 21) - 1
    letters, at = np.unique(np.concatenate((keys >> 42, keys >> 21 & mask, keys & mask)), return_inverse=True)
    base = _letter_vectors(letters)
    first, second, third = at.reshape(3, -1)
    return np.roll(base, 2, axis=1)[first] * np.roll(base, 1, axis=1)[second] * base[third]


def bundles(texts: list[str | None]) -> np.ndarray:
    """The vector of each text; zeros if it has no letter."""
    found = [triples(t) for t in texts]
    out = np.zeros((len(texts), DIMENSION), dtype=np.float32)
    sizes = [len(k) for k, _ in found]
    if not sum(sizes):
        return out
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    rows, counts = np.repeat(np.arange(len(texts)), sizes), np.concatenate([n for _, n in found]).astype(np.float32)
    order = np.argsort(at, kind="stable")
    rows, counts, at = rows[order], counts[order], at[order]
    for lo in range(0, len(keys), _CHUNK):
        a, b = np.searchsorted(at, (lo, lo + _CHUNK))
        table = np.zeros((len(texts), min(_CHUNK, len(keys) - lo)), dtype=np.float32)
        table[rows[a:b], at[a:b] - lo] = counts[a:b]
        out += table @ _vectors(keys[lo : lo + _CHUNK]).astype(np.float32)
    return out


def _bundled(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for lo, hi in slices(column, 1 << 19):
        yield lo, bundles(column.slice(lo, hi - lo).to_pylist())


def prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """Language to unit vector, from every row of docs (text, lang) with a language; bounded by languages times DIMENSION."""

    def add(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for lo, vectors in _bundled(batch.column(0)):
                own = langs[lo : lo + len(vectors)]
                for lang in set(own):
                    sums[lang] = sums.get(lang, 0) + vectors[own == lang].sum(axis=0, dtype=np.float64)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(names, dtype=object), DIMENSION), pa.string()),
                pa.array(np.tile(np.arange(DIMENSION), len(names)), pa.int64()),
                # whole numbers, so that the order of adding does not matter
                pa.array(np.concatenate([sums[n] for n in names]).round().astype(np.int64) if names else [], pa.int64()),
            ],
            ["lang", "at", "value"],
        )

    learned = docs.where("lang IS NOT NULL").select("text", "lang").mapInArrow(add, "lang string, at long, value long")
    rows = learned.groupBy("lang", "at").agg(F.sum("value").cast("double").alias("value")).toPandas()
    out = {}
    for lang, part in rows.groupby("lang"):
        vector = part.sort_values("at")["value"].to_numpy()
        norm = np.linalg.norm(vector)
        if norm:
            out[lang] = vector / norm
    return out


def predict(spark: SparkSession, docs: DataFrame, learned: dict[str, np.ndarray]) -> DataFrame:
    """row (all columns of docs as a struct), doc_id, lang_pred, score (cosine, 0 to 1).

    Only the text is read. A null text or one without letters is "und" with
    score 0, and so is everything if no language was learned. Languages of
    equal cosine: the first by name. No rows give no rows.
    """
    names = sorted(learned)
    matrix = np.array([learned[n] for n in names], dtype=np.float32).reshape(len(names), DIMENSION)
    shared = spark.sparkContext.broadcast((names, matrix))

    @F.pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        known, table = shared.value
        langs: list[str] = []
        scores: list[float] = []
        for _, vectors in _bundled(pa.array(texts, pa.string())):
            norms = np.linalg.norm(vectors, axis=1)
            cosines = vectors @ table.T / np.maximum(norms, 1e-9)[:, None]
            for norm, row in zip(norms, cosines):
                best = int(row.argmax()) if len(known) and norm else -1
                langs.append(known[best] if best >= 0 else UNKNOWN)
                scores.append(min(1.0, max(0.0, float(row[best]))) if best >= 0 else 0.0)
        return pd.DataFrame({"lang": langs, "score": scores})

    found = docs.select(F.struct("*").alias("row"), predicted("text").alias("found"))
    return found.select("row", F.col("row.doc_id").alias("doc_id"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def held_out(doc_id="doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4; a row without id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """predict() for every row, with prototypes learned from the rows that are not held out; and held_out."""
    found = predict(spark, docs, prototypes(docs.where(~held_out())))
    return found.withColumn("held_out", held_out())
