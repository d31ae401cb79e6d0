import pytest
from card_rows import card, rows_of
from pyspark.sql import functions as F

from tallyframe import (
    CARD,
    alerts,
    build_silver,
    grain_violations,
    monthly,
    monthly_from_wide,
    orphan_count,
    orphans,
    prepare,
    reconcile,
    segments,
)
from tallyframe.operators import reports
from tallyframe.operators.reshape import repayments

# Recorded delay rates of six months and the changes that follow from them.
RECORDED = [
    ("2005-04-01", 0.10263333333333333, None, "BASELINE"),
    ("2005-05-01", 0.09893333333333333, -0.3699999999999995, "WITHIN_THRESHOLD"),
    ("2005-06-01", 0.11693333333333333, 1.8000000000000003, "REVIEW"),
    ("2005-07-01", 0.1403, 2.3366666666666673, "REVIEW"),
    ("2005-08-01", 0.147, 0.6699999999999984, "WITHIN_THRESHOLD"),
    ("2005-09-01", 0.10433333333333333, -4.266666666666666, "WITHIN_THRESHOLD"),
]


def rates(spark, values):
    return spark.createDataFrame(values, "month string, delayed_account_rate double").selectExpr(
        "CAST(month AS DATE) AS month", "delayed_account_rate"
    )


# Statuses of three accounts from the latest slot back, and their bills and payments of the third slot.
STATUS = {"1": (0, 2, 2, 1, -1, 0), "2": (3, 3, 0, 0, 2, 0), "3": (-2, 2, 1, 0, 2, 0)}
BILL, PAID = {"1": 30, "2": 90, "3": -5}, {"1": 3, "2": 0, "3": 9}
MONTHS = [s.month for s in CARD.slots]


@pytest.fixture
def silver(cards):
    def fields(account):
        third = CARD.slots[2]
        given = {s.status: str(v) for s, v in zip(CARD.slots, STATUS[account])}
        limit = {} if account == "1" else {CARD.limit: "50000"}
        return given | limit | {CARD.id: account, third.bill: str(BILL[account]), third.payment: str(PAID[account])}

    _, accepted, _ = prepare(cards(*[card(**fields(a)) for a in STATUS]), "d" * 64)
    return accepted, *build_silver(accepted, "r")


def share_delayed(slot):
    late = [statuses[slot] >= 2 for statuses in STATUS.values()]
    return sum(late) / len(late)


def test_recorded_alerts_to_the_last_digit(spark):
    found = alerts(rates(spark, [(m, r) for m, r, _, _ in RECORDED]), 1.0).orderBy("month").collect()
    assert [(str(r.month), r.delayed_account_rate, r.change_percentage_points, r.alert_status)
            for r in found] == RECORDED
    assert {r.threshold_percentage_points for r in found} == {1.0}


def test_changes_are_in_percentage_points_of_the_row_before(silver):
    _, _, facts = silver
    found = {str(r.month): r for r in alerts(monthly(facts), 1.0).collect()}
    assert found.pop(MONTHS[-1]).alert_status == "BASELINE"
    for slot, month in enumerate(MONTHS[:-1]):
        change = 100.0 * (share_delayed(slot) - share_delayed(slot + 1))
        assert (found[month].change_percentage_points, found[month].alert_status == "REVIEW") == (change, change >= 1)
    assert [found[m].alert_status for m in MONTHS[:-1]].count("REVIEW") == 3


def test_the_threshold_comparison_is_exact(spark):
    found = alerts(rates(spark, [("2005-04-01", 0.10), ("2005-05-01", 0.11)]), 1.0)
    last = found.orderBy("month").collect()[1]
    assert last.change_percentage_points == 0.9999999999999996
    assert last.alert_status == "WITHIN_THRESHOLD"


def test_alerts_compare_with_the_previous_row_not_the_previous_month(spark):
    found = alerts(rates(spark, [("2005-04-01", 0.1), ("2005-09-01", 0.3)]), 1.0)
    assert found.orderBy("month").collect()[1].previous_rate == 0.1


def test_monthly_columns_and_values(silver):
    _, _, facts = silver
    frame = monthly(facts)
    assert frame.dtypes == [
        ("month", "date"), ("accounts", "bigint"), ("delayed_accounts", "bigint"),
        ("delayed_account_rate", "double"), ("positive_bill_ntd", "bigint"),
        ("delayed_bill_ntd", "bigint"), ("delayed_bill_share", "double"),
        ("payments_ntd", "bigint"), ("undocumented_status_accounts", "bigint"),
    ]
    third = frame.where(F.col("month") == MONTHS[2]).first()
    assert tuple(third)[1:] == (3, 1, 1 / 3, 120, 30, 0.25, 12, 1)
    first = frame.where(F.col("month") == MONTHS[-1]).first()
    assert first.delayed_bill_share is None and first.undocumented_status_accounts == 3


def test_segments_add_up_to_the_month(silver):
    accepted, dimension, facts = silver
    found = segments(facts, dimension)
    assert found.dtypes == [
        ("month", "date"), ("limit_band", "string"), ("accounts", "bigint"),
        ("positive_bill_ntd", "bigint"), ("delayed_accounts", "bigint"),
        ("delayed_account_rate", "double"),
    ]
    carried = segments(repayments(accepted, "r", with_band=True))
    assert rows_of(carried, "*") == rows_of(found, "*")
    rolled = found.groupBy("month").sum("accounts", "positive_bill_ntd", "delayed_accounts")
    expected = monthly(facts).select("month", "accounts", "positive_bill_ntd", "delayed_accounts")
    assert rows_of(rolled, "*") == rows_of(expected, "*")


def test_wide_recomputation_agrees_and_a_difference_shows_on_both_sides(silver, cards):
    accepted, _, facts = silver
    published = monthly(facts)
    assert reconcile(published, monthly_from_wide(accepted)).count() == 0
    other = monthly_from_wide(accepted.where("ID <> 3"))
    sides = reconcile(published, other).groupBy("only_in").count()
    assert rows_of(sides, "*") == [("published", 6), ("recomputed", 6)]
    assert monthly_from_wide(accepted.limit(0)).count() == 0


def test_grain_and_orphans(silver, spark):
    _, dimension, facts = silver
    keys = ["account_id", "run_id"]
    assert grain_violations(facts, ["account_id", "month"]).count() == 0
    assert grain_violations(facts.union(facts), ["account_id", "month"]).count() == 18
    assert orphans(facts, dimension, keys).count() == 0
    some = dimension.where("account_id <> 2")
    lost = orphans(facts, some, keys)
    assert lost.columns == facts.columns
    assert rows_of(lost.select("account_id").distinct(), "*") == [(2,)]
    assert orphan_count(facts, some, keys).first().orphans == lost.count() == 6
    nobody = facts.selectExpr("CAST(NULL AS BIGINT) AS account_id", "run_id")
    assert orphans(nobody, dimension, keys).count() == 18
    assert orphan_count(nobody, dimension, keys).first().orphans == 18


def test_reports(spark, silver):
    _, dimension, facts = silver
    months, bands = monthly(facts), segments(facts, dimension)
    trend = reports.monthly_trend(months).collect()
    assert [str(r.month) for r in trend] == [m for m, *_ in RECORDED]
    worst = reports.latest_month_concentration(bands, months).collect()
    assert [(r.limit_band, r.delayed_account_rate) for r in worst] == [
        ("below_100k", 0.5), ("100k_to_299k", 0.0),
    ]
    review = reports.review_alerts(alerts(months, 1.0)).collect()
    assert [str(r.month) for r in review] == [MONTHS[4], MONTHS[2], MONTHS[1]]


def test_latest_success_breaks_ties_by_run_id(spark):
    runs = spark.sql("""
        SELECT * FROM VALUES
          ('r1', TIMESTAMP '2026-01-01', 'SUCCESS'), ('r2', TIMESTAMP '2026-01-02', 'SUCCESS'),
          ('r3', TIMESTAMP '2026-01-02', 'SUCCESS'), ('r4', TIMESTAMP '2026-01-03', 'FAILED')
        AS runs(run_id, completed_at, status)""")
    assert [r.run_id for r in reports.latest_success(runs).collect()] == ["r3"]
    assert reports.latest_success(runs.where("status = 'FAILED'")).count() == 0
    assert [r.run_id for r in reports.recent_runs(runs, 3).collect()] == ["r4", "r3", "r2"]


def test_triage_counts_and_sample(cards):
    _, _, rejected = prepare(cards(card(AGE="1"), card(ID="2", AGE="1"), card(ID="3", SEX="9")),
                             "a" * 64)
    quarantine = rejected.withColumn("run_id", F.lit("r"))
    assert rows_of(reports.rejection_triage(quarantine), "rejection_reason", "rejected_rows") == [
        ("age_out_of_range", 2), ("invalid_sex_code", 1),
    ]
    assert reports.rejected_sample(quarantine, "r", CARD, 2).count() == 3
    one = reports.rejected_sample(quarantine, "r", CARD, 1)
    assert rows_of(one, "rejection_reason", "rank") == [("age_out_of_range", 1), ("invalid_sex_code", 1)]
    least = {r.rejection_reason: r.record_hash for r in quarantine.orderBy(F.desc("record_hash")).collect()}
    assert {r.rejection_reason: r.record_hash for r in one.collect()} == least
    assert rows_of(reports.rejected_sample(quarantine.repartition(7), "r", CARD, 1), "*") == rows_of(one, "*")
    assert reports.rejected_sample(quarantine, "other").count() == 0
