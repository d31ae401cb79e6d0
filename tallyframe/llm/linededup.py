"""Lines that repeat across documents stay only in the document of the smallest id.

The distinct hashes of repeated lines are cut into shards by hash. Each shard
becomes a minimal perfect hash with three arrays at its indexes: fingerprint,
number of documents, smallest id. Documents send their line hashes to the
shards, which answer from the arrays; no line is joined with another line.

The hash of a shard has levels: a key sits at the first level where it has a
bit for itself, and its index is the number of bits before it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import mixed

SHARD_KEYS = 20_000
SHARD_PROBES = 200_000
#: A shard that gets 1/HOT of all probes or more is copied, so at most HOT shards are.
HOT = 1000
_NO_ID = (1 << 63) - 1  # a null doc_id counts as the largest


def _digests(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _line_rows(batches, least: int):
    """A row for each row and distinct key of at least that many code points: hash, fingerprint, line numbers."""
    for batch in batches:
        ids, texts, raw, lines = [], [], [], []
        for doc, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            found: dict[bytes, list[int]] = {}
            for number, line in enumerate((text or b"").split(b"\n")):
                key = line.strip().lower()  # of bytes: ASCII white space and letters only
                if len(key) >= 4 * least or len(key) >= least and len(key.decode("utf-8", "replace")) >= least:
                    found.setdefault(key, []).append(number)
            ids += [doc] * len(found)
            texts += [digest] * len(found)
            raw += map(_digests, found)
            lines += found.values()
        pairs = np.frombuffer(b"".join(raw), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(lines, pa.list_(pa.int32()))],
            ["id", "digest", "hash", "print", "lines"],
        )


def _level_slots(hashes: np.ndarray, prints: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(hashes ^ mixed(prints + np.uint64(level))) % np.uint64(size)).astype(np.int64)


def build_shard(hashes: np.ndarray, prints: np.ndarray) -> tuple[list[bytes], list[int], np.ndarray]:
    """Bits of each level, their sizes, and the index of each key; the keys (hash, print) must be distinct."""
    order, bits, sizes = np.empty(len(hashes), dtype=np.int64), [], []
    rest, before, level = np.arange(len(hashes)), 0, 0
    while len(rest):
        size = max(8, 2 * len(rest))
        slots = _level_slots(hashes[rest], prints[rest], level, size)
        alone = np.bincount(slots, minlength=size) == 1
        placed = alone[slots]
        order[rest[placed]] = before + np.cumsum(alone)[slots[placed]] - 1
        bits.append(np.packbits(alone).tobytes())
        sizes.append(size)
        before += int(alone.sum())
        rest, level = rest[~placed], level + 1
    return bits, sizes, order


def look_up(bits: list[bytes], sizes: list[int], hashes: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The index of each key; of a key that is not in the shard, any index or -1."""
    out, rest, before = np.full(len(hashes), -1, dtype=np.int64), np.arange(len(hashes)), 0
    for level, (packed, size) in enumerate(zip(bits, sizes)):
        alone = np.unpackbits(np.frombuffer(packed, dtype=np.uint8), count=size).astype(bool)
        slots = _level_slots(hashes[rest], prints[rest], level, size)
        placed = alone[slots]
        ranks = np.cumsum(alone)
        out[rest[placed]] = before + ranks[slots[placed]] - 1
        before += int(ranks[-1])
        rest = rest[~placed]
    return out


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    hashes, prints = pdf["hash"].to_numpy().view(np.uint64), pdf["print"].to_numpy().view(np.uint64)
    bits, sizes, order = build_shard(hashes, prints)
    back = np.argsort(order)
    return pd.DataFrame({
        "shard": [pdf["shard"].iloc[0]],
        "bits": [bits],
        "sizes": [sizes],
        "prints": [prints[back].tobytes()],
        "counts": [pdf["n"].to_numpy()[back].astype(np.int64).tobytes()],
        "owners": [pdf["owner"].to_numpy()[back].astype(np.int64).tobytes()],
    })


def _probe(probes: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    if probes.empty or arrays.empty:
        return probes.iloc[:0].reindex(columns=["id", "digest", "lines"])
    shard = arrays.iloc[0]
    hashes, prints = probes["hash"].to_numpy().view(np.uint64), probes["print"].to_numpy().view(np.uint64)
    at = look_up(list(shard["bits"]), list(shard["sizes"]), hashes, prints)
    known = (at >= 0) & (np.frombuffer(shard["prints"], dtype=np.uint64)[at] == prints)
    owner = np.frombuffer(shard["owners"], dtype=np.int64)[at]
    return probes.loc[known & (owner != probes["id"].to_numpy()), ["id", "digest", "lines"]]


def dedup_lines(spark: SparkSession, docs: DataFrame, least: int = 10) -> DataFrame:
    """row (all columns of docs as a struct), doc_id, text (what is kept), n_lines, n_dropped.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased. Keys of at least ``least`` code points that stand in two or
    more documents lose all their lines but those of the smallest doc_id. A
    null or empty text is one empty line. Rows of one doc_id are one document:
    all of them keep a line that is theirs. Null ids together count as one
    document with the largest id. No rows give no rows.
    """
    scratch = Scratch(spark, "lines")
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("digest"),
        F.coalesce("text", F.lit("")).alias("body"),
    )
    lines = scratch.keep(
        keyed.select("id", "digest", "body").mapInArrow(
            lambda batches: _line_rows(batches, least), "id long, digest long, hash long, print long, lines array<int>"
        )
    )
    repeated = scratch.keep(
        lines.groupBy("hash", "print").agg(F.count("*").alias("n"), F.min("id").alias("owner"), F.max("id").alias("last")).where("owner < last")
    )
    n_probes = lines.count()
    shards = max(1, math.ceil(repeated.count() / SHARD_KEYS), math.ceil(n_probes / SHARD_PROBES))
    shard = F.pmod(F.col("hash"), F.lit(shards)).alias("shard")
    loads = repeated.groupBy(shard).agg(F.sum("n").alias("n")).where(F.col("n") * HOT >= n_probes)
    copies = loads.select("shard", F.ceil(F.col("n") * HOT / max(1, n_probes)).cast("int").alias("copies"))  # HOT rows at most
    arrays = repeated.select(shard, "hash", "print", "n", "owner").groupBy("shard").applyInPandas(
        _build, "shard long, bits array<binary>, sizes array<long>, prints binary, counts binary, owners binary"
    )
    copied = arrays.join(F.broadcast(copies), "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    probes = (
        lines.select(shard, "id", "digest", "hash", "print", "lines")
        .join(F.broadcast(copies), "shard", "left")
        .withColumn("copy", F.pmod(F.xxhash64("id", "digest"), F.coalesce("copies", F.lit(1))).cast("int"))
        .drop("copies")
    )
    dropped = (
        probes.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInPandas(_probe, "id long, digest long, lines array<int>")
        .groupBy("id", "digest").agg(F.flatten(F.collect_set("lines")).alias("dropped"))  # of one text: its lines bound it
    )
    split = F.split("body", "\n", -1)
    kept = F.array_join(F.filter(split, lambda _, i: ~F.array_contains("dropped", i)), "\n")
    return keyed.join(dropped, ["id", "digest"], "left").select(
        "row",
        F.col("row.doc_id").alias("doc_id"),
        F.when(F.col("dropped").isNull(), F.col("body")).otherwise(kept).alias("text"),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
