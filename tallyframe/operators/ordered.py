"""The previous row in time over tables too long for one ordered partition.

A window without a partition key, or with a hot one, sorts its rows in one task.
Here time is cut into ranges of about equally many rows; each range (of each entity)
is sorted alone, and the last row of a range is carried over to the next one that has
rows. Which range a row is in follows from its time only, so a rerun task agrees with
the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges are looked up in two steps of at most so many comparisons.
_STEP = 64
MOST_RANGES = _STEP * _STEP


def range_bounds(rows: DataFrame, order: str, ranges: int) -> list:
    """Lower bounds of the second range and all after it, from approximate quantiles of the order."""
    if ranges < 2:
        return []
    shares = [n / ranges for n in range(1, ranges)]
    found = rows.agg(F.percentile_approx(order, shares, 100 * ranges)).first()[0]
    return sorted(set(found or ()))


def range_of(order: Column, bounds: list) -> Column:
    """How many of the ascending bounds are not above the value; 0 for NULL."""
    if len(bounds) > MOST_RANGES:
        raise ValueError(f"There may be {MOST_RANGES} ranges at most")

    def passed(values: list, upto: Column = order) -> Column:
        return F.size(F.filter(F.array(*[F.lit(v) for v in values]), lambda b: b <= upto)) if values else F.lit(0)

    groups = [bounds[k : k + _STEP] for k in range(0, len(bounds), _STEP)]
    if len(groups) < 2:
        found = passed(bounds)
    else:
        # the group whose first bound is the last one passed, then the place within it
        coarse = passed([g[0] for g in groups])
        inner = F.get(F.array(*[F.array(*[F.lit(v) for v in g]) for g in groups]), coarse - 1)
        found = F.when(coarse == 0, 0).otherwise((coarse - 1) * _STEP + F.size(F.filter(inner, lambda b: b <= order)))
    return F.when(order.isNull(), 0).otherwise(found)


def previous(rows: DataFrame, order: str, columns: list[str], per: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """rows with previous_<column> for each of columns: its value in the row before, as LAG OVER (PARTITION BY per ORDER BY order).

    order is a number, a date or a timestamp, once for each entity; NULL comes first.
    ``ranges`` (default: the shuffle partitions) bounds the rows that a task sorts,
    to a share of all rows, whatever one entity holds. NULL is an entity of its own.
    Without ``per`` one row for each range goes through the driver.
    """
    spark = rows.sparkSession
    wanted = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("__range", range_of(F.col(order), range_bounds(rows, order, min(wanted, MOST_RANGES))))
    inside = Window.partitionBy("__range", *per).orderBy(order)
    kept = F.struct(*columns)
    # a window with a known first row, so that a NULL value is told apart from no row
    seen = ranged.withColumn("__before", F.lag(kept).over(inside)).withColumn("__first", F.row_number().over(inside) == 1)
    last = ranged.groupBy("__range", *per).agg(F.max_by(kept, F.struct(F.col(order).isNotNull(), order)).alias("__last"))
    if per:
        carried = last.withColumn("__carried", F.lag("__last").over(Window.partitionBy(*per).orderBy("__range"))).drop("__last")
        names = {c: f"__of_{n}" for n, c in enumerate(("__range", *per))}
        carried = carried.select(*[F.col(c).alias(n) for c, n in names.items()], "__carried")
    else:
        ends = sorted((r[0], r[1]) for r in last.select("__range", "__last").collect())
        shifted = [(at, before) for (at, _), (_, before) in zip(ends[1:], ends)]
        carried = F.broadcast(spark.createDataFrame(shifted, f"__of_0 int, __carried {last.schema['__last'].dataType.simpleString()}"))
        names = {"__range": "__of_0"}
    met = seen.join(carried, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()], "left")
    before = F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__before"))
    return met.select(*rows.columns, *[before.getField(c).alias(f"previous_{c}") for c in columns])
