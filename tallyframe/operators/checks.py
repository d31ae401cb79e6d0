"""Integrity checks over published or lazy frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.contract import CARD, Contract
from tallyframe.functions.expressions import guarded_ratio, row_fingerprint
from tallyframe.operators import digests, keyed


def grain_violations(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row (NULL is a key value here), with ``copies``."""
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(facts: DataFrame, parents: DataFrame, keys: list[str], **options) -> DataFrame:
    """Facts without a parent row."""
    return keyed.rows_without_match(facts, keys, parents, **options)


def orphan_count(facts: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Number of orphans, counted per key and never carried back to the rows."""
    counted = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(parents.select(*keys), keys, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("orphans")
    )


def monthly_from_wide(accepted: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Monthly metrics recomputed straight from the wide columns.

    A second path that shares no step with the long facts: one global
    aggregate over all slots, then one output row per slot.
    """
    unit = contract.unit
    zero = F.lit(0).cast("long")
    measures = []
    for n, slot in enumerate(contract.slots):
        late = F.col(slot.status) >= contract.delayed_from
        owed = F.when(F.col(slot.bill) > 0, F.col(slot.bill)).otherwise(zero)
        measures += [
            F.count(F.col(slot.status)).alias(f"accounts_{n}"),
            F.count_if(late).alias(f"late_{n}"),
            F.sum(owed).alias(f"owed_{n}"),
            F.sum(F.when(late, owed).otherwise(zero)).alias(f"late_owed_{n}"),
            F.sum(slot.payment).alias(f"paid_{n}"),
            F.count_if(F.col(slot.status).isin(*contract.undocumented)).alias(f"unknown_{n}"),
        ]
    rows = [
        F.struct(
            F.lit(slot.month).cast("date").alias("month"),
            F.col(f"accounts_{n}").alias("accounts"),
            F.col(f"late_{n}").alias("delayed_accounts"),
            guarded_ratio(F.col(f"late_{n}"), F.col(f"accounts_{n}")).alias("delayed_account_rate"),
            F.col(f"owed_{n}").alias(f"positive_bill_{unit}"),
            F.col(f"late_owed_{n}").alias(f"delayed_bill_{unit}"),
            guarded_ratio(F.col(f"late_owed_{n}"), F.col(f"owed_{n}")).alias("delayed_bill_share"),
            F.col(f"paid_{n}").alias(f"payments_{unit}"),
            F.col(f"unknown_{n}").alias("undocumented_status_accounts"),
        )
        for n, slot in enumerate(contract.slots)
    ]
    per_slot = accepted.agg(*measures).select(F.inline(F.array(*rows)))
    return per_slot.where("accounts > 0")


def reconcile(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows that only one side has, tagged with the side; empty when both agree.

    Doubles are compared exactly: both sides divide the same whole numbers.
    """
    recomputed = recomputed.select(*published.columns)
    return (
        published.exceptAll(recomputed).withColumn("only_in", F.lit("published"))
        .unionByName(recomputed.exceptAll(published).withColumn("only_in", F.lit("recomputed")))
    )


def reconcile_rows(published: DataFrame, recomputed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that one side has more often than the other, with ``only_in`` and by how many ``copies``.

    The rows behind a difference that ``reconcile`` shows in the metrics. Digests of
    buckets of keys are compared first, 256 and then 65,536 at most; rows leave their
    tasks for leaves that differ only, and nothing does if the sides agree. Columns
    are compared by name and exactly; NULL equals NULL.
    """
    columns = published.columns
    sides = []
    for rows in (published, recomputed):
        rows = rows.select(*columns)
        sides.append(rows.select("*", row_fingerprint(keys).alias("__key"), row_fingerprint(columns).alias("__row")))
    leaves = digests.different_leaves(*sides, "__key", "__row")
    found = [digests.rows_in(rows, leaves, "__key").select(*columns, F.lit(sign).alias("__side")) for rows, sign in zip(sides, (1, -1))]
    surplus = found[0].unionByName(found[1]).groupBy(*columns).agg(F.sum("__side").alias("__more")).where("__more <> 0")
    return surplus.select(
        *columns, F.when(F.col("__more") > 0, "published").otherwise("recomputed").alias("only_in"), F.abs("__more").alias("copies")
    )
