"""The tables of a namespace: layout, appends, audit rows and reader views.

Every table is partitioned by what readers and replays select on, so the
"current publication" filter prunes whole runs and a replay looks at one
source only.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.contract import CARD, MALFORMED, Contract
from tallyframe.operators import digests, metrics
from tallyframe.operators.quality import HASH
from tallyframe.operators.reports import NEWEST_SUCCESS

BRONZE = "bronze_records"
QUARANTINE = "quarantine_records"
ACCOUNTS = "account_versions"
REPAYMENTS = "repayment_versions"
RUNS = "pipeline_runs"
DIGESTS = "bronze_digests"


def _layout(contract: Contract) -> dict[str, tuple[str, tuple[str, ...]]]:
    raw = ", ".join(f"`{c}` STRING" for c in contract.columns)
    lineage = "source_sha256 STRING, ingested_at TIMESTAMP"
    return {
        BRONZE: (
            f"{raw}, record_hash STRING, {MALFORMED} STRING, copies BIGINT, {lineage}",
            ("source_sha256",),
        ),
        QUARANTINE: (
            f"record_hash STRING, {raw}, {MALFORMED} STRING, {lineage}, "
            "rejection_reason STRING, run_id STRING",
            ("run_id",),
        ),
        ACCOUNTS: (
            f"account_id BIGINT, {contract.money('credit_limit')} BIGINT, limit_band STRING, "
            "run_id STRING",
            ("run_id",),
        ),
        REPAYMENTS: (
            "account_id BIGINT, month DATE, repayment_status BIGINT, "
            f"{contract.money('bill')} BIGINT, {contract.money('payment')} BIGINT, "
            f"{contract.money('positive_bill')} BIGINT, delayed_2plus BOOLEAN, "
            "status_not_documented BOOLEAN, run_id STRING, limit_band STRING",
            ("run_id", "month"),
        ),
        # What bronze holds of each source by leaf bucket; rows of one bucket add up.
        DIGESTS: (
            f"{digests.BUCKET} STRING, n BIGINT, {', '.join(f'{w} DECIMAL(38,0)' for w in digests.SUMS)}, source_sha256 STRING",
            ("source_sha256",),
        ),
        # The columns of the audit table, but for the threshold.
        RUNS: (
            "run_id STRING, completed_at TIMESTAMP, status STRING, source_sha256 STRING, "
            "raw_rows BIGINT, exact_duplicates BIGINT, rejected_rows BIGINT, "
            "accepted_accounts BIGINT, monthly_rows BIGINT, message STRING, threshold_pp DOUBLE",
            (),
        ),
    }


def newest_success(runs: str, field: str = "") -> str:
    """Text of a scalar subquery: the run that readers see as a struct, or one field of it."""
    return f"(SELECT run{'.' + field if field else ''} FROM (SELECT {NEWEST_SUCCESS} AS run FROM {runs}))"


def _views(namespace: str, contract: Contract) -> dict[str, str]:
    def newest(field: str) -> str:
        return newest_success(f"{namespace}.{RUNS}", field)

    def current(table: str) -> str:
        return f"{namespace}.{table} WHERE run_id = {newest('run_id')}"

    u = contract.money
    return {
        "silver_accounts":
            f"SELECT account_id, {u('credit_limit')}, limit_band, run_id FROM {current(ACCOUNTS)}",
        "silver_repayments":
            f"SELECT account_id, month, repayment_status, {u('bill')}, {u('payment')}, "
            f"{u('positive_bill')}, delayed_2plus, status_not_documented, run_id "
            f"FROM {current(REPAYMENTS)}",
        "gold_monthly": metrics.monthly_text(f"{namespace}.silver_repayments", contract),
        # The stored facts carry their band: same result as joining the dimension, no shuffle.
        "gold_segments": metrics.segment_text(f"(SELECT * FROM {current(REPAYMENTS)})", contract),
        "gold_alerts": metrics.alert_text(f"{namespace}.gold_monthly", newest("threshold_pp")),
    }


#: Tables whose files are split by account, into the same buckets, so that joins and
#: groups by account read them without a shuffle.
BUCKETED = (ACCOUNTS, REPAYMENTS)
#: Spark refuses tables of more.
MOST_BUCKETS = 100_000


def bucket_count(spark: SparkSession, namespace: str, root: str | None = None, wanted: int | None = None) -> int:
    """Buckets of the version tables, fixed when they are created; 0 for tables that were created without.

    A root remembers the number for sessions to come. ``wanted`` (default: the
    session's shuffle partitions) counts for new tables only.
    """
    name = f"{namespace}.{ACCOUNTS}"
    if spark.catalog.tableExists(name):
        found = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").select("data_type").first()
        return int(found[0]) if found else 0
    wanted = min(wanted or int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    if not root:
        return wanted
    layout = f"{root}/layout"

    def exists(folder: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    if not exists(f"{layout}/_SUCCESS"):
        before = 0 if exists(f"{root}/{ACCOUNTS}") else wanted
        spark.range(0, 1, 1, 1).select(F.lit(before).alias("buckets")).write.mode("overwrite").parquet(layout)
    return spark.read.parquet(layout).first().buckets


def install(
    spark: SparkSession, namespace: str, contract: Contract = CARD, root: str | None = None, buckets: int | None = None
) -> None:
    """Create the schema and the empty tables where absent, and define the reader views anew.

    With ``root`` the tables live under that shared folder and a new session
    finds what earlier ones wrote there. The schema's own location stays empty,
    so dropping the schema loses no data. Without ``root`` they live in the
    session's warehouse, which only a local session may use.
    """
    if not root and not is_local(spark):
        raise ValueError("Off a local session the tables need a root that all executors share")
    place = f" LOCATION '{root}/schema'" if root else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}{place}")
    parts = bucket_count(spark, namespace, root, buckets)
    for table, (columns, partitions) in _layout(contract).items():
        name = f"{namespace}.{table}"
        if spark.catalog.tableExists(name):
            continue
        split = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        where = f" LOCATION '{root}/{table}'" if root else ""
        if root:
            _make_folder(spark, columns, partitions, f"{root}/{table}")
        spread = f" CLUSTERED BY (account_id) INTO {parts} BUCKETS" if parts and table in BUCKETED else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{split}{spread}{where}")
        if root and partitions:
            spark.catalog.recoverPartitions(name)
    for view, text in _views(namespace, contract).items():
        spark.sql(f"CREATE OR REPLACE VIEW {namespace}.{view} AS {text}")


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def _make_folder(spark: SparkSession, columns: str, partitions: tuple[str, ...], path: str):
    """An empty append: the folder must exist before a table or its partitions are looked up."""
    fields = StructType.fromDDL(columns).fields
    empty = spark.range(0, 0, 1, 1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )
    writer = empty.write.mode("append")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def append(rows: DataFrame, table: str) -> None:
    """Append by position of the table's own columns."""
    spark = rows.sparkSession
    rows.select(*spark.table(table).columns).write.mode("append").insertInto(table)


def store_bronze(spark: SparkSession, namespace: str, source: str, rows: DataFrame) -> None:
    """Append the distinct rows of a source that bronze lacks; a new source lacks all."""
    target = f"{namespace}.{BRONZE}"
    # A writer that died while its files were being moved into place may have left a part
    # of this source behind that the catalog does not know of yet.
    spark.catalog.recoverPartitions(target)
    if spark.table(target).where(F.col("source_sha256") == source).isEmpty():
        append(rows, target)
        append_digests(spark, namespace, source, rows)
    else:
        append_missing(spark, namespace, source, rows)


def append_digests(spark: SparkSession, namespace: str, source: str, rows: DataFrame) -> None:
    """Add the bucket digests of rows that bronze has got of a source."""
    sums = digests.bucket_sums(rows, digests.LEAF, HASH)
    append(sums.withColumn("source_sha256", F.lit(source)), f"{namespace}.{DIGESTS}")


def append_missing(spark: SparkSession, namespace: str, source: str, rows: DataFrame) -> None:
    """Append the rows of a source that bronze lacks; a replay appends nothing, and moves no row and no key.

    Digests of buckets are compared first, with those stored when bronze was
    written. Rows are looked up in bronze for the leaves that differ only, by their
    hash. What bronze then holds of those leaves is counted anew, so that digests
    which a dead writer left behind too low are put right.
    """
    bronze = f"{namespace}.{BRONZE}"

    def of_source(table: str) -> DataFrame:
        return spark.table(f"{namespace}.{table}").where(F.col("source_sha256") == source)

    tops = digests.buckets(digests.differences(digests.bucket_sums(rows, digests.TOP, HASH), digests.rolled_up(of_source(DIGESTS), digests.TOP)))
    if not tops:
        return
    known = digests.rolled_up(digests.rows_in(of_source(DIGESTS), tops, digests.BUCKET), digests.LEAF)
    leaves = digests.buckets(digests.differences(digests.bucket_sums(digests.rows_in(rows, tops, HASH), digests.LEAF, HASH), known))
    there = digests.rows_in(of_source(BRONZE), leaves, HASH).select(HASH)
    append(digests.rows_in(rows, leaves, HASH).join(there, HASH, "left_anti"), bronze)
    now = digests.bucket_sums(digests.rows_in(of_source(BRONZE), leaves, HASH), digests.LEAF, HASH)
    stored = digests.rolled_up(digests.rows_in(of_source(DIGESTS), leaves, digests.BUCKET), digests.LEAF)
    append(digests.differences(now, stored).withColumn("source_sha256", F.lit(source)), f"{namespace}.{DIGESTS}")


def record_run(
    spark: SparkSession,
    namespace: str,
    run_id: str,
    status: str,
    source_sha256: str,
    counts: dict[str, int],
    message: str,
    threshold_pp: float,
) -> None:
    """One audit row; a SUCCESS row is what makes the run visible to readers."""
    values = {
        "run_id": run_id,
        "completed_at": datetime.now(timezone.utc),
        "status": status,
        "source_sha256": source_sha256,
        **counts,
        "message": message,
        "threshold_pp": float(threshold_pp),
    }
    row = spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    append(row, f"{namespace}.{RUNS}")
