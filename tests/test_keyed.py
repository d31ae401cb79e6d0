import pytest
from card_rows import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import keyed


def skewed(spark):
    """Half the rows share key 1, a fifth have no key, the rest are single or in pairs."""
    return spark.range(0, 2000).select(
        F.when(F.col("id") % 2 == 0, 1)
        .when(F.col("id") % 5 == 0, F.lit(None))
        .otherwise((F.col("id") / 3).cast("int") + 10).alias("k"),
        (F.col("id") % 7).alias("v"),
    )


def expected_flags(rows):
    values = [tuple(r) for r in rows.collect()]
    counts = {}
    for k, _ in values:
        counts[k] = counts.get(k, 0) + 1
    return sorted([(str(k), v, k is not None and counts[k] > 1) for k, v in values])


@pytest.mark.parametrize("heavy_keys", [1, 2, 50, 10**6])
def test_repeated_keys_are_marked_at_any_heavy_limit(spark, heavy_keys):
    rows = skewed(spark)
    marked = keyed.mark_repeated(rows, ["k"], "again", heavy_keys=heavy_keys)
    found = sorted((str(r.k), r.v, r.again) for r in marked.collect())
    assert found == expected_flags(rows)


@pytest.mark.parametrize("heavy_keys", [1, 5, 1000])
def test_the_broadcast_list_is_bounded(spark, heavy_keys):
    """However many keys repeat, fewer than heavy_keys of them are broadcast, and the marks are the same."""
    rows = spark.range(0, 3000).select((F.col("id") % 1500).cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    found = keyed.repeated_keys(rows, ["k"]).withColumn("hit", F.lit(True))
    total = found.agg(F.sum("n")).first()[0]
    assert found.where(F.col("n") * heavy_keys > total).count() < heavy_keys
    assert keyed.mark_rows(rows, ["k"], found, "again", heavy_keys=heavy_keys).where("NOT again").count() == 0


@pytest.mark.parametrize("heavy_keys", [1, 50, 10**6])
@pytest.mark.parametrize("parents", [[], [1], [1, 11, 12], [10**9]])
def test_rows_without_match_is_an_anti_join(spark, heavy_keys, parents):
    rows = skewed(spark)
    known = spark.createDataFrame([(p,) for p in parents] * 2, "k int")
    found = keyed.rows_without_match(rows, ["k"], known, heavy_keys=heavy_keys)
    expected = rows.join(known, "k", "left_anti")
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_two_part_keys(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a"), (2, None)], "k int, w string"
    )
    marked = keyed.mark_repeated(rows, ["k", "w"], "again", heavy_keys=1)
    assert rows_of(marked.where("again"), "k", "w") == [(1, "a"), (1, "a")]


def test_the_hot_key_does_not_meet_in_one_partition(spark):
    """The shuffle before the last join is by key and row hash, and spreads key 1."""
    rows = skewed(spark)
    found = keyed.repeated_keys(rows, ["k"]).withColumn("hit", F.lit(True))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        marked = keyed.mark_rows(rows, ["k"], found, "again", heavy_keys=3)
        plan = marked._jdf.queryExecution().executedPlan().toString()
        sizes = marked.where("k = 1 OR k IS NULL").groupBy(F.spark_partition_id()).count()
        largest = max(r["count"] for r in sizes.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert "__spread" in [ln for ln in plan.splitlines() if "Exchange hashpartitioning(k" in ln][0]
    assert largest < 900  # 1200 such rows over four partitions


@settings(max_examples=15, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(
    keys=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=40),
    parents=st.sets(st.integers(0, 6)),
    heavy_keys=st.integers(1, 8),
)
def test_any_keys(spark, keys, parents, heavy_keys):
    rows = spark.createDataFrame([(k,) for k in keys], "k int")
    marked = keyed.mark_repeated(rows, ["k"], "again", heavy_keys=heavy_keys)
    assert sorted((str(r.k), r.again) for r in marked.collect()) == sorted(
        (str(k), k is not None and keys.count(k) > 1) for k in keys
    )
    known = spark.createDataFrame([(p,) for p in parents], "k int")
    lost = keyed.rows_without_match(rows, ["k"], known, heavy_keys=heavy_keys)
    assert sorted(str(r.k) for r in lost.collect()) == sorted(
        str(k) for k in keys if k not in parents
    )
