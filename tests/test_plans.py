"""The plans that matter at scale."""

import re
import uuid

import pytest
from card_rows import card
from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from tallyframe import publish
from tallyframe.operators import checks, digests, metrics, quality, reports
from tallyframe.plans.publish import integrity_report
from tallyframe.sources import tables

SF = "/root/testdata/sf0.001"


def plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    ns = f"ns_{uuid.uuid4().hex}"
    root = f"file://{tmp_path_factory.mktemp('plans')}/{ns}"
    schema = ", ".join(f"{c} string" for c in quality.CARD.columns)
    raw = spark.createDataFrame([card(ID=str(n)) for n in range(1, 20)], schema)
    for sha in ("a" * 64, "b" * 64):
        publish(spark, raw, ns, sha, root=root)
    return ns


@pytest.mark.parametrize("name", ["quarantine_rows", "gold_monthly", "run_counts"])
def test_deduplication_runs_once_for_rows_and_conflicts(spark, name):
    frame = QUERIES[name](spark, SF)
    final = plan(frame).split("== Initial Plan ==")[0]
    # Orders and customers are each scanned once although three branches need them.
    assert final.count("FileScan parquet") == 2
    assert "ReusedExchange" in final


def test_published_views_read_one_run_and_few_columns(spark, published):
    frame = spark.table(f"{published}.gold_segments")
    text = plan(frame)
    assert "Join" not in text
    formatted = frame._jdf.queryExecution().toString()
    assert "run_id" in re.search(r"PartitionFilters: \[([^\]]*)\]", formatted).group(1)
    columns = re.search(r"ReadSchema: struct<([^>]*)>", formatted).group(1)
    assert set(re.findall(r"(\w+):", columns)) == {
        "positive_bill_ntd", "delayed_2plus", "limit_band",
    }


def test_the_latest_month_prunes_the_other_months(spark, published):
    frame = reports.latest_month_concentration(
        spark.table(f"{published}.gold_segments"), spark.table(f"{published}.gold_monthly")
    )
    frame.collect()
    formatted = frame._jdf.queryExecution().toString()
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", formatted)
    assert any("month" in f and "run_id" in f for f in filters)


def test_the_list_that_marks_rows_broadcasts_a_bounded_list_only(spark):
    text = plan(QUERIES["conflict_flag"](spark, SF)).split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def exchanges(frame):
    return re.findall(r"Exchange (\S+?)\(([^)]*)\)", plan(frame).split("== Initial Plan ==")[0])


def test_joins_and_groups_by_account_move_no_row(spark, published):
    """The version tables are bucketed: what is left is one exchange of the sums, or none."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, accounts = (spark.table(f"{published}.{n}") for n in ("silver_repayments", "silver_accounts"))
        joined = exchanges(metrics.segments(facts, accounts, keys=("account_id",)))
        assert [k for _, k in joined if "account_id" in k] == [] and len(joined) == 1
        assert exchanges(checks.grain_violations(facts, ["account_id", "month"])) == []
        assert exchanges(facts.join(accounts, ["account_id"], "left_anti").select("account_id")) == []
        assert [k for _, k in exchanges(integrity_report(spark, published)) if "account_id" in k] == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tables.bucket_count(spark, published) == 2


def test_digests_shuffle_buckets_only(spark, published):
    bronze = spark.table(f"{published}.bronze_records")
    found = exchanges(digests.bucket_sums(bronze, digests.LEAF, "record_hash"))
    assert len(found) == 1 and "bucket" in plan(digests.bucket_sums(bronze, digests.LEAF, "record_hash"))
    assert "HashAggregate" in plan(digests.bucket_sums(bronze, digests.TOP, "record_hash"))


def test_the_previous_row_is_found_without_one_partition(spark):
    for name in ("monthly_ship_trend", "user_event_gaps"):
        text = plan(QUERIES[name](spark, SF)).split("== Initial Plan ==")[0]
        assert "SinglePartition" not in text and "Window" in text


def test_a_sample_is_cut_before_the_shuffle(spark, published):
    run = spark.table(f"{published}.pipeline_runs").first().run_id
    text = plan(reports.rejected_sample(spark.table(f"{published}.quarantine_records"), run, rows=3))
    assert text.count("WindowGroupLimit") >= 2 or "LocalTableScan" in text
