"""Marking rows by what is known about their key, safe under skew.

One key may hold a third of all rows, so neither a window partitioned by the
key nor a plain join on it is safe: both bring the whole group into one task.
The operators here aggregate per key first (combined before the shuffle), then
carry the answer back to the rows:

* heavy keys, those with more than 1 / HEAVY_KEYS of the counted rows: there are
  fewer than HEAVY_KEYS of them however large the table is, and they are
  broadcast;
* all other keys: shuffle join, no task sees more than 1 / HEAVY_KEYS of the rows
  for one key. Rows already settled by the broadcast, and rows with a NULL key,
  take a hash of the row as second join key, so that they do not meet in one
  task either.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1000


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., n) for every key without NULLs."""
    return rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def mark_rows(
    rows: DataFrame,
    keys: list[str],
    found: DataFrame,
    flag: str,
    *,
    spread: list[str] | None = None,
    heavy_keys: int = HEAVY_KEYS,
) -> DataFrame:
    """Add boolean ``flag``: true where the row's key is in ``found`` with ``hit`` true.

    ``found`` has the key columns, ``n`` (rows of that key in ``rows``) and
    ``hit``; keys that it lacks must have one row each at most. NULL keys never
    match. ``spread`` names the columns that tell rows of one key apart
    (default: all).
    """
    out = [*rows.columns, F.coalesce("__hit", F.lit(False)).alias(flag)]
    counted = found.agg(F.sum("n")).scalar()
    is_heavy = F.col("n") * F.lit(heavy_keys) > counted

    # The second join key is a hash on both sides. A constant on the light side would
    # be folded into a filter, and the rows would be partitioned by the key alone.
    # The partition id keeps equal rows of different tasks apart, and a rerun repeats it.
    of_key, of_row = F.xxhash64(*keys), F.xxhash64(*(spread or rows.columns), F.spark_partition_id())
    heavy = found.where(is_heavy).select(*keys, F.col("hit").alias("__heavy"))
    light = found.where(~is_heavy & F.col("hit")).select(
        *keys, of_key.alias("__spread"), F.lit(True).alias("__light")
    )
    settled = reduce(or_, [F.col(k).isNull() for k in keys], F.col("__heavy").isNotNull())
    return (
        rows.join(F.broadcast(heavy), keys, "left")
        .withColumn("__spread", F.when(settled, of_row).otherwise(of_key))
        .join(light, [*keys, "__spread"], "left")
        .withColumn("__hit", F.coalesce("__heavy", "__light"))
        .select(*out)
    )


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return key_counts(rows, keys).where("n > 1")


def mark_repeated(
    rows: DataFrame, keys: list[str], flag: str, *, heavy_keys: int = HEAVY_KEYS
) -> DataFrame:
    """Add boolean ``flag``: another row has the same key."""
    found = repeated_keys(rows, keys).withColumn("hit", F.lit(True))
    return mark_rows(rows, keys, found, flag, heavy_keys=heavy_keys)


def rows_without_match(
    rows: DataFrame, keys: list[str], parents: DataFrame, *, heavy_keys: int = HEAVY_KEYS
) -> DataFrame:
    """Rows whose key is absent from ``parents`` (or NULL).

    The lookup runs on the per-key counts, one row per key; only then does the
    answer go back to the rows.
    """
    known = parents.select(*keys).distinct().withColumn("__known", F.lit(True))
    found = (
        key_counts(rows, keys)
        .join(known, keys, "left")
        .select(*keys, "n", F.coalesce("__known", F.lit(False)).alias("hit"))
    )
    # A row is kept unless its key is known, so unmatched and NULL keys fall out alike.
    marked = mark_rows(rows, keys, found, "__matched", heavy_keys=heavy_keys)
    return marked.where(~F.col("__matched")).drop("__matched")
