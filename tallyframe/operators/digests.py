"""Comparing two large sets of rows by digests of their hash buckets.

A row belongs to a bucket by the first hex digits of a SHA-256: two digits at the
top, four at the leaves. A bucket's digest is the number of its rows and four sums of
60-bit pieces of their hashes. Digests are added up in each task, do not depend on
any order, and those of parts add up to that of the whole, so they can be stored and
kept up to date by appending what changed. Sets are compared from the top: equal
buckets are done, and rows are looked at, and moved, for leaves that differ only. At
most 256 top buckets and 65,536 leaves exist, however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP, LEAF = 2, 4
SUMS = [f"w{n}" for n in range(4)]
BUCKET = "bucket"


def bucket_sums(rows: DataFrame, digits: int, by: Column | str, hashes: Column | str | None = None) -> DataFrame:
    """(bucket, n, w0..w3): rows by the first digits of the SHA-256 ``by``, with sums over ``hashes`` (default: the same).

    The only rows that are shuffled are one for each task and bucket.
    """
    by = F.col(by) if isinstance(by, str) else by
    hashes = by if hashes is None else F.col(hashes) if isinstance(hashes, str) else hashes
    pieces = [F.conv(F.substring(hashes, 15 * n + 1, 15), 16, 10).cast("decimal(20,0)") for n in range(4)]
    return rows.groupBy(F.substring(by, 1, digits).alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(p).cast("decimal(38,0)").alias(w) for p, w in zip(pieces, SUMS)]
    )


def rolled_up(sums: DataFrame, digits: int) -> DataFrame:
    """Digests of shorter buckets, or of the same ones stored in several rows."""
    return sums.groupBy(F.substring(BUCKET, 1, digits).alias(BUCKET)).agg(F.sum("n").alias("n"), *[F.sum(w).cast("decimal(38,0)").alias(w) for w in SUMS])


def differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """(bucket, n, w0..w3): one less the other, for the buckets in which they differ; a missing bucket is empty."""
    names = ["n", *SUMS]
    pair = one.select(BUCKET, *names).join(other.select(BUCKET, *[F.col(c).alias(f"o_{c}") for c in names]), BUCKET, "full")
    zero = F.lit(0)
    less = pair.select(BUCKET, *[(F.coalesce(c, zero) - F.coalesce(f"o_{c}", zero)).cast("bigint" if c == "n" else "decimal(38,0)").alias(c) for c in names])
    return less.where(" OR ".join(f"{c} <> 0" for c in names))


def buckets(found: DataFrame) -> list[str]:
    """The names of buckets, 65,536 at most."""
    return sorted(r[0] for r in found.select(BUCKET).collect())


def rows_in(rows: DataFrame, names: list[str], by: Column | str) -> DataFrame:
    """The rows of the named buckets (all of one length)."""
    by = F.col(by) if isinstance(by, str) else by
    digits = len(names[0]) if names else 0
    if len(names) <= 256:
        return rows.where(F.substring(by, 1, digits).isin(names))
    wanted = rows.sparkSession.createDataFrame([(n,) for n in names], "__bucket string")
    return rows.join(F.broadcast(wanted), F.substring(by, 1, digits) == F.col("__bucket"), "left_semi")


def different_leaves(one: DataFrame, other: DataFrame, by: str, hashes: str | None = None) -> list[str]:
    """Leaf buckets in which two sets of rows differ; leaves are only looked at below top buckets that differ."""
    tops = buckets(differences(*[bucket_sums(rows, TOP, by, hashes) for rows in (one, other)]))
    if not tops:
        return []
    return buckets(differences(*[bucket_sums(rows_in(rows, tops, by), LEAF, by, hashes) for rows in (one, other)]))
