"""From raw text rows to accepted, typed rows and quarantined rows with reasons."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.contract import CARD, CONFLICT, MALFORMED, MISSING, Contract
from tallyframe.functions.expressions import any_null, broken_rules, digest_of, row_fingerprint, strict_bigint
from tallyframe.operators import keyed

HASH = "record_hash"
COPIES = "copies"
REASON = "rejection_reason"


def require_columns(columns: list[str], contract: Contract) -> None:
    """The column set must equal the contract exactly, in any order, by exact case."""
    given = [c for c in columns if c != MALFORMED]
    if set(given) != set(contract.columns) or len(given) != len(contract.columns):
        raise ValueError("Unexpected input schema: columns differ from the contract")


def as_text(raw: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Contract columns as text, in contract order, and the malformed text or NULL."""
    require_columns(raw.columns, contract)
    text = [F.col(c).cast("string").alias(c) for c in contract.columns]
    malformed = F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(None)
    return raw.select(*text, malformed.cast("string").alias(MALFORMED))


def dedupe(rows: DataFrame) -> DataFrame:
    """One row per distinct row, with the number of ``copies`` it had.

    Copies collapse before the shuffle, so a row repeated a billion times
    travels once per task; the raw row count is ``sum(copies)`` and needs no
    second scan and no accumulator.
    """
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COPIES))


def stamp(rows: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Add the row fingerprint. Equal rows have equal ones, so it can follow the
    deduplication: it does not travel, and plans that do not use it skip it."""
    return rows.withColumn(HASH, row_fingerprint([*contract.columns, MALFORMED]))


def unique_rows(raw: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Distinct raw rows as text with copies and fingerprint."""
    return stamp(dedupe(as_text(raw, contract)), contract)


def snapshot_digest(unique: DataFrame) -> DataFrame:
    """The identity of a snapshot, one row: a digest of its distinct rows and their copies.

    Order, file layout and column order do not matter, a changed, added or
    repeated row does. It needs the deduplicated rows only, not the source.
    """
    return unique.agg(digest_of(F.col(HASH), F.col(COPIES)).alias("digest"))


def type_rows(unique: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Typed columns at the top, the text they came from in the struct ``raw``."""
    typed = [
        F.col(c) if c in contract.text_columns else strict_bigint(c).alias(c)
        for c in contract.columns
    ]
    rows = unique.select(HASH, COPIES, MALFORMED, F.struct(*contract.columns).alias("raw"), *typed)
    return rows.withColumn(MISSING, any_null(contract.integers))


def conflicting_ids(typed: DataFrame, contract: Contract = CARD) -> DataFrame:
    """(id, n, hit): ids held by more than one distinct row once they are numbers."""
    # Two things let Spark run the deduplication shuffle once for this branch and for
    # the rows: the id is returned as an aggregate, so no NULL filter sinks below the
    # deduplication, and the copies are part of the condition (n rows have at least n
    # copies), so the same columns are needed.
    return (
        typed.groupBy(F.col(contract.id).alias("__id"))
        .agg(
            F.max(contract.id).alias(contract.id),
            F.count(F.lit(1)).alias("n"),
            F.sum(COPIES).alias("__copies"),
        )
        .where(F.col(contract.id).isNotNull() & (F.col("n") > 1) & (F.col("__copies") > 1))
        .select(contract.id, "n", F.lit(True).alias("hit"))
    )


def flag_conflicts(
    typed: DataFrame,
    contract: Contract = CARD,
    conflicts: DataFrame | None = None,
    *,
    heavy_keys: int = keyed.HEAVY_KEYS,
) -> DataFrame:
    """Flag every row of a conflicting id; a NULL id conflicts with nothing."""
    if conflicts is None:
        conflicts = conflicting_ids(typed, contract)
    # Rows are spread by columns that the rules need anyway, so no other is kept for it,
    # and by the copies, which the list of conflicting ids counts on being there.
    return keyed.mark_rows(
        typed, [contract.id], conflicts, CONFLICT,
        spread=[COPIES, contract.limit, *(s.status for s in contract.slots)],
        heavy_keys=heavy_keys,
    )


def apply_rules(flagged: DataFrame, contract: Contract = CARD) -> DataFrame:
    """Add the reason text; '' marks an accepted row."""
    return flagged.withColumn(REASON, broken_rules(contract.rules)).drop(CONFLICT, MISSING)


def check_rows(
    raw: DataFrame, contract: Contract = CARD, *, heavy_keys: int = keyed.HEAVY_KEYS
) -> DataFrame:
    """All quality steps as one lazy plan."""
    typed = type_rows(unique_rows(raw, contract), contract)
    return apply_rules(flag_conflicts(typed, contract, heavy_keys=heavy_keys), contract)


def bronze_rows(
    unique: DataFrame, source_sha256: str, ingested_at, contract: Contract = CARD
) -> DataFrame:
    """Distinct raw rows with their lineage and the number of copies the source had."""
    return unique.select(
        *contract.columns,
        HASH,
        MALFORMED,
        COPIES,
        F.lit(source_sha256).alias("source_sha256"),
        F.lit(ingested_at).alias("ingested_at"),
    )


def decided_rows(checked: DataFrame, contract: Contract = CARD) -> DataFrame:
    """What the later steps need of a checked batch, and no more.

    Accepted rows keep the typed columns that silver is made of, rejected rows
    their raw text; ``accepted`` tells them apart.
    """
    used = {contract.id, contract.limit}.union(*((s.status, s.bill, s.payment) for s in contract.slots))
    rejected = F.col(REASON) != ""
    return checked.select(
        COPIES,
        REASON,
        *[c for c in contract.columns if c in used],
        *[F.when(rejected, F.col(c)).alias(c) for c in (HASH, "raw", MALFORMED)],
        (~rejected).alias("accepted"),
    )


def accepted_rows(checked: DataFrame, contract: Contract = CARD) -> DataFrame:
    return checked.where(F.col(REASON) == "").select(HASH, *contract.columns)


def quarantined_rows(checked: DataFrame, source_sha256: str, ingested_at) -> DataFrame:
    """Rejected rows as they arrived, with every reason. No join back is needed."""
    return checked.where(F.col(REASON) != "").select(
        HASH,
        "raw.*",
        MALFORMED,
        F.lit(source_sha256).alias("source_sha256"),
        F.lit(ingested_at).alias("ingested_at"),
        REASON,
    )


def prepare(
    raw: DataFrame,
    source_sha256: str,
    contract: Contract = CARD,
    ingested_at: datetime | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lazy (bronze, accepted, quarantine) frames of one snapshot."""
    ingested_at = ingested_at or datetime.now(timezone.utc)
    bronze = bronze_rows(unique_rows(raw, contract), source_sha256, ingested_at, contract)
    checked = check_rows(raw, contract)
    return (
        bronze,
        accepted_rows(checked, contract),
        quarantined_rows(checked, source_sha256, ingested_at),
    )
