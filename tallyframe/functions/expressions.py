"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.contract import Band, Rule


def row_fingerprint(columns: list[str]) -> Column:
    """Lower-case SHA-256 of the row as JSON.

    NULL fields are left out whatever the session setting is, so the
    fingerprint of a row never depends on who computes it.
    """
    as_json = F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})
    return F.sha2(as_json, 256)


def strict_bigint(column: str) -> Column:
    """BIGINT, or NULL for text that is not a whole number (no error)."""
    return F.col(column).try_cast("bigint")


def any_null(columns: tuple[str, ...]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def broken_rules(rules: tuple[Rule, ...]) -> Column:
    """Codes of all broken rules in rule order, joined by ``|``; '' when none is."""
    codes = [F.when(F.expr(r.fails_when), F.lit(r.code)) for r in rules]
    return F.concat_ws("|", *codes)


def banded(column: Column, bands: tuple[Band, ...]) -> Column:
    """Name of the first half-open band whose upper bound lies above the value."""
    *bounded, last = bands
    name = F.lit(last.name)
    for band in reversed(bounded):
        name = F.when(column < band.below, F.lit(band.name)).otherwise(name)
    return name


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator)


def digest_of(hashes: Column, copies: Column | None = None) -> Column:
    """Aggregate: SHA-256 of the number of rows and of order-free sums over their SHA-256 (64 hex digits).

    The eight 32-bit words of each hash are added up, so the sums combine before
    a shuffle, and neither the order of rows nor their split over files or
    tasks matters. ``copies`` says how often a row counts. One definition for
    every size; a NULL hash counts as zeros.
    """
    weight = F.lit(1) if copies is None else copies
    weight = weight.cast("decimal(18,0)")
    sums = [
        F.coalesce(F.conv(F.substring(hashes, 8 * n + 1, 8), 16, 10).cast("decimal(10,0)"), F.lit(0)) * weight
        for n in range(8)
    ]
    parts = [F.coalesce(F.sum(s.cast("decimal(28,0)")), F.lit(0)).cast("string") for s in [weight, *sums]]
    return F.sha2(F.concat_ws("|", *parts), 256)
