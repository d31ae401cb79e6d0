"""Results recorded for a real snapshot of 30,000 accounts, rebuilt from its counts and sums."""

from card_rows import rows_of
from pyspark.sql import functions as F

from catalogue.queries import QUERIES
from tallyframe import alerts, monthly, segments

SF = "/root/testdata/sf0.01"

# Month, accounts, delayed accounts, rate, positive bills, delayed bills, share,
# payments, accounts with undocumented status.
MONTHS = [
    ("2005-04-01", 30000, 3079, 0.10263333333333333, 1168268063, 152825201, 0.13081347153114806, 156465077, 21181),
    ("2005-05-01", 30000, 2968, 0.09893333333333333, 1210412763, 147132882, 0.12155595718879576, 143981629, 21493),
    ("2005-06-01", 30000, 3508, 0.11693333333333333, 1298989558, 165363715, 0.1273018046847148, 144782306, 20803),
    ("2005-07-01", 30000, 4209, 0.1403, 1411355065, 198947996, 0.1409623991394398, 156770445, 19849),
    ("2005-08-01", 30000, 4410, 0.147, 1476195541, 224680256, 0.1522022318586586, 177634905, 19512),
    ("2005-09-01", 30000, 3130, 0.10433333333333333, 1537381257, 197038144, 0.12816478872943615, 169907415, 17496),
]

# Month, band, accounts, positive bills, delayed accounts, rate.
SEGMENTS = [
    ("2005-04-01", "100k_to_299k", 13433, 613530434, 1098, 0.08173900096776594),
    ("2005-04-01", "300k_plus", 5117, 322093863, 145, 0.028336916161813563),
    ("2005-04-01", "below_100k", 11450, 232643766, 1836, 0.16034934497816594),
    ("2005-05-01", "100k_to_299k", 13433, 631041972, 1008, 0.07503908285565399),
    ("2005-05-01", "300k_plus", 5117, 337481139, 139, 0.02716435411373852),
    ("2005-05-01", "below_100k", 11450, 241889652, 1821, 0.15903930131004368),
    ("2005-06-01", "100k_to_299k", 13433, 670187041, 1184, 0.08814114494156182),
    ("2005-06-01", "300k_plus", 5117, 361471216, 178, 0.034786007426226305),
    ("2005-06-01", "below_100k", 11450, 267331301, 2146, 0.1874235807860262),
    ("2005-07-01", "100k_to_299k", 13433, 723281834, 1430, 0.10645425444800119),
    ("2005-07-01", "300k_plus", 5117, 385453535, 249, 0.04866132499511432),
    ("2005-07-01", "below_100k", 11450, 302619696, 2530, 0.22096069868995633),
    ("2005-08-01", "100k_to_299k", 13433, 759505140, 1498, 0.11151641479937467),
    ("2005-08-01", "300k_plus", 5117, 395410397, 256, 0.050029314051201874),
    ("2005-08-01", "below_100k", 11450, 321280004, 2656, 0.2319650655021834),
    ("2005-09-01", "100k_to_299k", 13433, 791193061, 1103, 0.08211121864066105),
    ("2005-09-01", "300k_plus", 5117, 414644291, 179, 0.03498143443423881),
    ("2005-09-01", "below_100k", 11450, 331543905, 1848, 0.16139737991266376),
]


def facts(counted):
    """As many facts as accounts were counted; the sums sit on single accounts."""
    nth, late = F.col("nth"), F.col("nth") <= F.col("delayed")
    return counted.select("*", F.explode(F.sequence(F.lit(1), "accounts")).alias("nth")).select(
        F.col("month").cast("date").alias("month"),
        "limit_band",
        late.alias("delayed_2plus"),
        (nth > F.col("accounts") - F.col("unknown")).alias("status_not_documented"),
        F.when(nth == 1, F.col("late_bill"))
        .when(nth == F.col("delayed") + 1, F.col("bill") - F.col("late_bill"))
        .otherwise(0).cast("long").alias("positive_bill_ntd"),
        F.when(nth == 1, F.col("paid")).otherwise(0).cast("long").alias("payment_ntd"),
    )


COUNTED = (
    "month string, limit_band string, accounts long, delayed long, bill long, late_bill long, "
    "paid long, unknown long"
)


def test_monthly_results_and_alerts_to_the_last_digit(spark):
    counted = spark.createDataFrame(
        [(m, "all", n, late, bill, late_bill, paid, unknown)
         for m, n, late, _, bill, late_bill, _, paid, unknown in MONTHS], COUNTED
    )
    months = monthly(facts(counted)).withColumn("month", F.col("month").cast("string"))
    assert rows_of(months, "*") == MONTHS
    flagged = alerts(months, 1.0).where("alert_status = 'REVIEW'")
    assert rows_of(flagged, "month") == [("2005-06-01",), ("2005-07-01",)]


def test_segment_results_to_the_last_digit(spark):
    counted = spark.createDataFrame(
        [(m, band, n, late, bill, 0, 0, 0) for m, band, n, bill, late, _ in SEGMENTS], COUNTED
    )
    found = segments(facts(counted)).withColumn("month", F.col("month").cast("string"))
    assert rows_of(found, "*") == SEGMENTS
    september = [s for s in SEGMENTS if s[0] == "2005-09-01"]
    assert sum(s[2] for s in september) == 30000 and sum(s[4] for s in september) == 3130


def test_the_derived_account_snapshot_has_the_expected_counts(spark):
    counts = QUERIES["run_counts"](spark, SF).first()
    assert tuple(counts) == (1561, 1531, 30, 299, 1232, 7392)
    reasons = dict(rows_of(QUERIES["rejection_reasons"](spark, SF), "rejection_reason", "rows_found"))
    assert reasons == {
        "": 1232, "conflicting_account_id": 58, "missing_or_noninteger": 37,
        "missing_or_noninteger|nonpositive_limit": 3, "negative_pay_3": 35,
        "nonpositive_limit": 161, "nonpositive_limit|conflicting_account_id": 4,
        "nonpositive_limit|negative_pay_3": 1,
    }
    found = QUERIES["gold_alerts"](spark, SF).where("alert_status = 'REVIEW'").collect()
    assert sorted(str(r.month) for r in found) == ["1999-01-01", "2000-01-01"]
