"""Reading a raw CSV snapshot as text, and refusing one that is not the pinned one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.contract import CARD, MALFORMED, Contract


def read_snapshot(spark: SparkSession, path: str, contract: Contract = CARD) -> DataFrame:
    """Every column as text, in contract order; nothing is inferred.

    The snapshot is every file below ``path``. The schema is bound in the order
    of the file's own header, and every file must have that header. The text of
    rows with too many or too few fields is kept in a column of its own, so
    that a long row is rejected instead of silently cut.
    """

    def reader():
        return spark.read.option("header", True).option("recursiveFileLookup", True)

    header = reader().option("inferSchema", False).csv(path).columns
    if sorted(header) != sorted(contract.columns):
        raise ValueError("Input schema mismatch: the header is not the contract's column set")
    schema = ", ".join(f"`{c}` STRING" for c in [*header, MALFORMED])
    bound = reader().option("enforceSchema", False).option("columnNameOfCorruptRecord", MALFORMED)
    return bound.schema(schema).csv(path).select(*contract.columns, MALFORMED)


def require_digest(actual: str, expected: str) -> str:
    """Refuse a snapshot whose bytes are not the pinned ones."""
    if actual != expected:
        raise ValueError("Source checksum differs from the pinned snapshot")
    return actual
