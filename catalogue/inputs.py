"""Raw snapshots derived from the customer and orders tables.

Both snapshots have one row per customer and six yearly slots, plus exact
copies, conflicting rows and damaged fields at fixed places, so that every
rule of the contracts finds rows to reject. Their work grows with the tables.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.contract import (
    CARD,
    CONFLICT,
    MALFORMED_RULE,
    MISSING_RULE,
    Band,
    Contract,
    Rule,
    Slot,
)

YEARS = (2000, 1999, 1998, 1997, 1996, 1995)


def _account_contract() -> Contract:
    status = tuple(f"status_{n}" for n in range(1, 7))
    bills = tuple(f"bill_{n}" for n in range(1, 7))
    payments = tuple(f"pay_{n}" for n in range(1, 7))
    columns = ("id", "limit_bal", "segment", *status, *bills, *payments)
    return Contract(
        name="account",
        columns=columns,
        text_columns=("segment",),
        id="id",
        limit="limit_bal",
        rules=(
            MISSING_RULE,
            MALFORMED_RULE,
            Rule("invalid_account_id", "id <= 0"),
            Rule("nonpositive_limit", "limit_bal <= 0"),
            Rule("conflicting_account_id", CONFLICT),
            *(Rule(f"invalid_{c}", f"{c} NOT BETWEEN -2 AND 9") for c in status),
            *(Rule(f"negative_{c}", f"{c} < 0") for c in payments),
        ),
        slots=tuple(
            Slot(f"{y}-01-01", s, b, p) for y, s, b, p in zip(YEARS, status, bills, payments)
        ),
        bands=(Band("low", 200_000), Band("mid", 600_000), Band("high", None)),
        unit="cents",
    )


ACCOUNT = _account_contract()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def slotted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its slot: the outer slots are open, and undated orders are in the last."""
    year = F.year("o_orderdate")
    slot = F.when(year >= YEARS[0], 1).when(year > YEARS[-1], YEARS[0] + 1 - year).otherwise(len(YEARS))
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", slot.alias("slot"), cents("o_totalprice").alias("c")
    )


def slot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the table and orders that reached a customer's slot: equal unless a customer is missing."""
    there = slotted_orders(spark, sf_dir).groupBy("slot").agg(F.count(F.lit(1)).alias("orders_in_table"))
    sums = [F.coalesce(F.sum(f"n_{n}"), F.lit(0)).alias(f"n_{n}") for n in range(1, len(YEARS) + 1)]
    read = customer_years(spark, sf_dir).agg(*sums).select(
        F.posexplode(F.array(*[f"n_{n}" for n in range(1, len(YEARS) + 1)])).alias("at", "orders_read")
    )
    read = read.select((F.col("at") + 1).alias("slot"), "orders_read")
    return there.join(read, "slot").select("slot", "orders_in_table", "orders_read")


def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with order count, signed bill and payment of each slot year.

    Orders combine per customer before the shuffle, so a customer with a third
    of all orders sends one row per task.
    """
    orders = slotted_orders(spark, sf_dir)
    signed = F.when(F.col("o_orderstatus") == "F", -F.col("c")).otherwise(F.col("c"))
    per_slot = []
    for n in range(1, len(YEARS) + 1):
        here = F.col("slot") == n
        per_slot += [
            F.count_if(here).alias(f"n_{n}"),
            F.sum(F.when(here, signed)).alias(f"bill_{n}"),
            F.sum(F.when(here & (F.col("o_orderstatus") == "P"), F.col("c"))).alias(f"pay_{n}"),
        ]
    yearly = orders.groupBy("o_custkey").agg(*per_slot)
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") + 1).alias("idn"),
        cents("c_acctbal").alias("balance"), "c_mktsegment",
    )
    return customers.join(yearly, customers.c_custkey == yearly.o_custkey, "left")


def _every(n: int):
    return F.col("idn") % n == 0


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(0)).cast("string")


def _status(n: int):
    orders = F.coalesce(F.col(f"n_{n}"), F.lit(0).cast("long"))
    code = F.when(orders == 0, -2).when(orders == 1, 0).otherwise(F.least(orders, F.lit(9)))
    return code.cast("string")


def _with_variants(rows: DataFrame, variants: dict[str, int]) -> DataFrame:
    """Repeat chosen rows under a variant name, in the same pass over the rows."""
    extra = [F.when(_every(n), F.lit(name)) for name, n in variants.items()]
    names = F.array_compact(F.array(F.lit("base"), *extra))
    return rows.withColumn("variant", F.explode(names))


def acct_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_variants(
        customer_years(spark, sf_dir), {"copy": 50, "limit": 97, "zero": 89}
    )
    idn = F.col("idn").cast("string")
    limit = F.when(_every(31), F.lit("-1")).otherwise(F.col("balance").cast("string"))
    variant = F.col("variant")
    out = {
        "id": F.when(variant == "zero", F.concat(F.lit("0"), idn)).otherwise(idn),
        "limit_bal": F.when(variant == "limit", F.concat(limit, F.lit("1"))).otherwise(limit),
        "segment": F.col("c_mktsegment"),
    }
    for n in range(1, 7):
        bill, pay = _text(F.col(f"bill_{n}")), _text(F.col(f"pay_{n}"))
        out[f"status_{n}"] = _status(n)
        out[f"bill_{n}"] = F.when(_every(37), F.lit("oops")).otherwise(bill) if n == 1 else bill
        out[f"pay_{n}"] = F.when(_every(41), F.lit("-5")).otherwise(pay) if n == 3 else pay
    return rows.select(*[out[c].alias(c) for c in ACCOUNT.columns])


def card_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same customers under the 25-column card contract."""
    rows = _with_variants(
        customer_years(spark, sf_dir), {"copy": 50, "limit": 97, "zero": 89, "none": 103}
    )
    number, idn, variant = F.col("idn"), F.col("idn").cast("string"), F.col("variant")
    limit = F.when(_every(47), F.lit("oops")).otherwise(F.col("balance").cast("string"))

    def usual(column, n: int, damaged: str | None):
        return F.when(_every(n), F.lit(damaged)).otherwise(column.cast("string"))

    age = F.when(_every(67), F.lit("17")).otherwise(usual(18 + number % 103, 71, "121"))
    out = {
        "ID": F.when(variant == "zero", F.concat(F.lit("0"), idn))
        .when(variant == "none", F.lit("0")).otherwise(idn),
        "LIMIT_BAL": F.when(variant == "limit", F.concat(limit, F.lit("1"))).otherwise(limit),
        "SEX": usual(1 + number % 2, 53, "3"),
        "EDUCATION": usual(number % 7, 59, "7"),
        "MARRIAGE": usual(number % 4, 61, "4"),
        "AGE": F.when(~_every(43), age),
        "default_next_month": usual(number % 2, 73, "2"),
    }
    for n, slot in enumerate(CARD.slots, start=1):
        bill, pay = _text(F.col(f"bill_{n}")), _text(F.col(f"pay_{n}"))
        out[slot.status] = usual(_status(n), 79, "10") if n == 1 else _status(n)
        out[slot.bill] = usual(bill, 101, "1.5") if n == 6 else bill
        out[slot.payment] = usual(pay, 83, "-5") if n == 3 else pay
    return rows.select(*[out[c].alias(c) for c in CARD.columns])


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a log of runs: finished orders succeeded, all others failed."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("run_id"),
        F.col("o_orderdate").alias("completed_at"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
    )


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder of the cluster.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{purpose}_{uuid.uuid4().hex}"
