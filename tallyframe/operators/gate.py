"""Counts of a checked batch and the decision whether it may be published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.contract import CARD, Contract
from tallyframe.operators.quality import COPIES, REASON

# The messages callers match on.
NO_ROWS = "No usable input rows; publication blocked"
NOT_RECONCILED = "Input reconciliation failed"
TOO_MANY_REJECTS = "Quarantine rate exceeds threshold; publication blocked"
PASS = "PASS"


def batch_counts(checked: DataFrame, contract: Contract = CARD) -> DataFrame:
    """All counts of a batch in one row, from one pass over two narrow columns."""
    copies = F.coalesce(F.sum(COPIES), F.lit(0).cast("long"))
    accepted = F.count_if(F.col(REASON) == "")
    return checked.agg(
        copies.alias("raw_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        (copies - F.count(F.lit(1))).alias("exact_duplicates"),
        F.count_if(F.col(REASON) != "").alias("rejected_rows"),
        accepted.alias("accepted_accounts"),
        (accepted * len(contract.slots)).alias("monthly_rows"),
    )


def require_rate(rate: float) -> None:
    if not 0 <= rate <= 1:
        raise ValueError("max_reject_rate must lie between 0 and 1")


def gate_outcomes(counts: DataFrame, max_reject_rates: list[float]) -> DataFrame:
    """Counts of batches with the outcome under each limit: PASS, or why publication is blocked."""
    for rate in max_reject_rates:
        require_rate(rate)
    limits = F.explode(F.array(*[F.lit(float(r)) for r in max_reject_rates]))
    decided = F.col("accepted_accounts") + F.col("rejected_rows")
    outcome = (
        F.when(F.least("raw_rows", "accepted_accounts") == 0, NO_ROWS)
        .when(decided != F.col("unique_rows"), NOT_RECONCILED)
        .when(F.col("rejected_rows") / F.col("unique_rows") > F.col("max_reject_rate"), TOO_MANY_REJECTS)
        .otherwise(PASS)
    )
    return counts.select("*", limits.alias("max_reject_rate")).withColumn("outcome", outcome)


#: What a publication asks of its parameters, with the SQL of what breaks it. The messages.
PARAMETER_RULES = (
    ("The namespace must be a simple schema or catalog.schema name",
     r"namespace IS NULL OR NOT namespace RLIKE '^[A-Za-z_][A-Za-z0-9_]*([.][A-Za-z_][A-Za-z0-9_]*)?\\z'"),
    ("The source identity must be 64 lower-case hex digits",
     r"source_sha256 IS NOT NULL AND NOT source_sha256 RLIKE '^[0-9a-f]{64}\\z'"),
    ("The alert threshold must be finite and nonnegative",
     "threshold_pp IS NULL OR isnan(threshold_pp) OR threshold_pp < 0 OR threshold_pp = double('infinity')"),
    ("max_reject_rate must lie between 0 and 1",
     "max_reject_rate IS NULL OR isnan(max_reject_rate) OR max_reject_rate NOT BETWEEN 0 AND 1"),
)


def parameter_outcomes(parameters: DataFrame) -> DataFrame:
    """Rows of namespace, source_sha256, threshold_pp and max_reject_rate with the outcome: PASS, or the first refusal.

    The same answers as a publication gives before it touches anything, for any
    number of planned publications at once.
    """
    outcome = F.lit(PASS)
    for message, broken in reversed(PARAMETER_RULES):
        outcome = F.when(F.expr(broken), F.lit(message)).otherwise(outcome)
    return parameters.withColumn("outcome", outcome)
