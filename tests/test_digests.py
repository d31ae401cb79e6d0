"""Digest buckets, replays and reconciliation by them, and the previous row by ranges."""

import uuid
from collections import Counter
from datetime import date, timedelta

import pytest
from card_rows import card
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe import publish, reconcile_rows
from tallyframe.operators import digests, gate, ordered
from tallyframe.plans.publish import require_parameters
from tallyframe.sources import tables

SHA = "a" * 64


@pytest.fixture
def place(tmp_path):
    name = f"ns_{uuid.uuid4().hex}"
    return name, f"file://{tmp_path}/{name}"


def hashed(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").withColumn("h", F.sha2(F.col("id").cast("string"), 256))


def test_digests_add_up_and_ignore_order(spark):
    rows = hashed(spark, range(3000))
    whole = digests.bucket_sums(rows, digests.LEAF, "h")
    parts = digests.bucket_sums(rows.where("id % 3 = 0"), digests.LEAF, "h").unionAll(digests.bucket_sums(rows.where("id % 3 > 0").orderBy(F.desc("id")), digests.LEAF, "h"))
    assert digests.differences(whole, digests.rolled_up(parts, digests.LEAF)).collect() == []
    assert digests.differences(digests.bucket_sums(rows, digests.TOP, "h"), digests.rolled_up(parts, digests.TOP)).collect() == []
    assert whole.agg(F.sum("n")).first()[0] == 3000


def test_different_leaves_are_those_of_the_rows_that_differ(spark):
    one, other = hashed(spark, range(2000)), hashed(spark, [*range(1, 2000), 5000, 5000])
    odd = {r.h[:4] for r in hashed(spark, [0, 5000]).collect()}
    assert set(digests.different_leaves(one, other, "h")) == odd
    assert digests.different_leaves(one, one, "h") == []
    assert digests.different_leaves(one.limit(0), one.limit(0), "h") == []
    assert {r.id for r in digests.rows_in(other, sorted(odd), "h").collect()} >= {5000}
    # many buckets are joined, with the same answer
    every = sorted({r.h[:4] for r in one.collect()})
    assert len(every) > 256 and digests.rows_in(one, every, "h").count() == 2000


def test_a_replay_looks_no_row_up(spark, cards, place, monkeypatch):
    ns, root = place
    batch = cards(*[card(ID=str(n)) for n in range(1, 300)])
    publish(spark, batch, ns, SHA, root=root)

    def never(*_):
        raise AssertionError("a replay must end at the top buckets")

    monkeypatch.setattr(digests, "rows_in", never)
    publish(spark, batch, ns, SHA)
    assert spark.table(f"{ns}.bronze_records").count() == 299


def test_rows_that_bronze_lacks_are_found_whatever_the_digests_say(spark, cards, place):
    """Changed rows of a known source, and digests that a dead writer left too low."""
    ns, root = place
    publish(spark, cards(*[card(ID=str(n)) for n in range(1, 40)]), ns, SHA, root=root)
    wider = cards(*[card(ID=str(n)) for n in range(20, 70)])
    for _ in range(2):
        publish(spark, wider, ns, SHA)
        assert spark.table(f"{ns}.bronze_records").count() == spark.table(f"{ns}.bronze_records").select("record_hash").distinct().count() == 69
    stored = digests.rolled_up(spark.table(f"{ns}.{tables.DIGESTS}"), digests.LEAF)
    now = digests.bucket_sums(spark.table(f"{ns}.bronze_records"), digests.LEAF, "record_hash")
    assert digests.differences(stored, now).collect() == []
    # a writer that died after its rows and before their digests
    part = spark.table(f"{ns}.bronze_records").drop("source_sha256").limit(7)
    part.write.parquet(f"{root}/{tables.BRONZE}/source_sha256={'b' * 64}")
    publish(spark, cards(*[card(ID=str(n)) for n in range(1, 70)]), ns, "b" * 64)
    of_b = spark.table(f"{ns}.bronze_records").where(f"source_sha256 = '{'b' * 64}'")
    assert of_b.count() == of_b.select("record_hash").distinct().count() == 69
    kept = digests.rolled_up(spark.table(f"{ns}.{tables.DIGESTS}").where(f"source_sha256 = '{'b' * 64}'"), digests.LEAF)
    assert digests.differences(kept, digests.bucket_sums(of_b, digests.LEAF, "record_hash")).collect() == []


def test_a_new_session_keeps_the_buckets(spark, cards, place):
    ns, root = place
    publish(spark, cards(card(), card(ID="2")), ns, SHA, root=root)
    tables_before = tables.bucket_count(spark, ns)
    other = f"{ns}_again"
    tables.install(spark, other, root=root, buckets=7)
    assert tables.bucket_count(spark, other) == tables_before == 2
    assert spark.table(f"{other}.silver_accounts").count() == 2


def test_reconciled_rows_equal_a_full_comparison(spark):
    schema = "account_id long, month string, v double, w string"
    left = [(n % 50, f"m{n % 7}", n / 3, None if n % 9 else "x") for n in range(600)] + [(None, "m", None, None)] * 3 + [(7, "m0", 1.0, "y")] * 2
    right = [r for r in left if r[0] != 11] + [(11, "m1", 0.5, None), (None, "m", None, None), (99, "m0", 1.0, "")]
    found = reconcile_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema).select("w", "v", "month", "account_id"), ["account_id"])
    more = Counter(left)
    more.subtract(right)
    wanted = {(*r, "published" if n > 0 else "recomputed", abs(n)) for r, n in more.items() if n}
    assert {tuple(r) for r in found.collect()} == wanted and found.count() == len(wanted)
    same = spark.createDataFrame(left, schema)
    assert reconcile_rows(same, same.orderBy(F.desc("v")), ["account_id"]).collect() == []


@pytest.mark.parametrize("ranges", [1, 3, 16, 200])
def test_previous_equals_lag(spark, ranges):
    """A hot entity, entities in few ranges, NULL entities, times and values."""
    days = [date(2020, 1, 1) + timedelta(n) for n in range(300)]
    rows = [(1, d, float(n) if n % 5 else None) for n, d in enumerate(days)]
    rows += [(k, days[(k * 37) % 300], 1.0 * k) for k in range(2, 40)] + [(2, days[299], 9.0), (None, days[0], 1.0), (None, days[200], 2.0), (1, None, 3.0)]
    frame = spark.createDataFrame(rows, "who long, day date, v double").repartition(5)

    def both(found, expected):
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(*found.columns).collect()))

    window = Window.partitionBy("who").orderBy("day")
    both(ordered.previous(frame, "day", ["v", "day"], ("who",), ranges), frame.withColumn("previous_v", F.lag("v").over(window)).withColumn("previous_day", F.lag("day").over(window)))
    alone = frame.where("who = 1")
    both(ordered.previous(alone, "day", ["v"], ranges=ranges), alone.withColumn("previous_v", F.lag("v").over(window)))
    assert ordered.previous(frame.limit(0), "day", ["v"], ranges=ranges).collect() == []


def test_many_ranges_are_looked_up_in_two_steps(spark):
    frame = spark.range(5000).withColumn("t", F.col("id") * 2)
    bounds = list(range(100, 9000, 7))
    found = frame.select("t", ordered.range_of(F.col("t"), bounds).alias("r")).collect()
    assert all(r.r == sum(b <= r.t for b in bounds) for r in found[::97])
    with pytest.raises(ValueError, match="ranges at most"):
        ordered.range_of(F.col("t"), list(range(5000)))


def test_parameter_outcomes_agree_with_the_publication(spark):
    names = ["a", "a.b", "a.b.c", "1a", "", "é", "a-b", "_x.Y9", None, "a\n", "a."]
    hashes = [None, SHA, "A" * 64, "a" * 63, SHA + "\n", "g" * 64]
    numbers = [0.0, 1.0, -0.1, 1.1, float("nan"), float("inf"), -float("inf"), -0.0]
    rows = [(n, h, numbers[k % 8], numbers[(k // 8) % 8]) for k, (n, h) in enumerate((n, h) for n in names for h in hashes)]
    rows += [("a", SHA, t, r) for t in numbers for r in numbers]
    frame = spark.createDataFrame(rows, "namespace string, source_sha256 string, threshold_pp double, max_reject_rate double")
    for r in gate.parameter_outcomes(frame).collect():
        if r.namespace is None:
            assert "namespace" in r.outcome
            continue
        try:
            require_parameters(r.namespace, r.source_sha256, r.max_reject_rate, r.threshold_pp)
            wanted = gate.PASS
        except ValueError as problem:
            wanted = str(problem)
        assert r.outcome == wanted, r
