"""Accepted wide rows to the account dimension and long period facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.contract import CARD, Contract
from tallyframe.functions.expressions import banded


def accounts(accepted: DataFrame, run_id: str, contract: Contract = CARD) -> DataFrame:
    """One row per account: id, limit, limit band. Nothing else leaves the raw layer."""
    limit = F.col(contract.limit)
    return accepted.select(
        F.col(contract.id).alias("account_id"),
        limit.alias(contract.money("credit_limit")),
        banded(limit, contract.bands).alias("limit_band"),
        F.lit(run_id).alias("run_id"),
    )


def unfold(accepted: DataFrame, contract: Contract = CARD) -> DataFrame:
    """One narrow row per account and slot, made in place without a shuffle."""
    slots = [
        F.struct(
            F.lit(s.month).cast("date").alias("month"),
            F.col(s.status).alias("repayment_status"),
            F.col(s.bill).alias(contract.money("bill")),
            F.col(s.payment).alias(contract.money("payment")),
        )
        for s in contract.slots
    ]
    return accepted.select(
        F.col(contract.id).alias("account_id"),
        F.col(contract.limit).alias("limit"),
        F.inline(F.array(*slots)),
    )


def facts(
    unfolded: DataFrame, run_id: str, contract: Contract = CARD, *, with_band: bool = False
) -> DataFrame:
    """Add what follows from the unfolded columns.

    ``with_band`` also carries the account's limit band, so that segment
    metrics over the stored facts need no join with the dimension.
    """
    bill, status = F.col(contract.money("bill")), F.col("repayment_status")
    band = [banded(F.col("limit"), contract.bands).alias("limit_band")] if with_band else []
    return unfolded.select(
        "account_id",
        "month",
        status,
        bill,
        contract.money("payment"),
        F.greatest(bill, F.lit(0).cast("long")).alias(contract.money("positive_bill")),
        (status >= contract.delayed_from).alias("delayed_2plus"),
        status.isin(*contract.undocumented).alias("status_not_documented"),
        F.lit(run_id).alias("run_id"),
        *band,
    )


def repayments(
    accepted: DataFrame, run_id: str, contract: Contract = CARD, *, with_band: bool = False
) -> DataFrame:
    """The period facts of accepted rows."""
    return facts(unfold(accepted, contract), run_id, contract, with_band=with_band)


def build_silver(
    accepted: DataFrame, run_id: str, contract: Contract = CARD
) -> tuple[DataFrame, DataFrame]:
    """(account dimension, period facts) of one run."""
    return accounts(accepted, run_id, contract), repayments(accepted, run_id, contract)
