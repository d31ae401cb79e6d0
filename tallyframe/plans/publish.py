"""Publishing one full snapshot.

The source is read once: its distinct rows are staged, and from there on all
steps read columnar data. The rules run once, on the staged rows, and what the
later steps need of them is staged at the size of their files, so that all
that follows is map-only. Lost executors cost a rerun of their tasks; a lost
driver leaves only partitions that no view shows, because the SUCCESS audit
row comes last, and its stages, from which another run can go on. One writer at
a time.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.contract import CARD, MALFORMED, Contract
from tallyframe.operators import gate, quality, reshape
from tallyframe.plans.sizing import SHUFFLE, settings_for, sized_for, source_bytes
from tallyframe.sources import tables
from tallyframe.sources.pins import source_pin
from tallyframe.sources.snapshot import read_snapshot, require_digest
from tallyframe.sources.stages import Stage, drop_dead, lost_runs

# What an audit row counts.
COUNTED = ("raw_rows", "exact_duplicates", "rejected_rows", "accepted_accounts", "monthly_rows")


def require_parameters(
    namespace: str, source_sha256: str | None, max_reject_rate: float, threshold_pp: float
) -> None:
    """Refuse bad parameters before anything is created or read."""
    parts = namespace.split(".")
    if len(parts) > 2 or not all(p.isascii() and p.isidentifier() for p in parts):
        raise ValueError("The namespace must be a simple schema or catalog.schema name")
    if source_sha256 is not None and not re.fullmatch(r"[0-9a-f]{64}", source_sha256):
        raise ValueError("The source identity must be 64 lower-case hex digits")
    if not math.isfinite(threshold_pp) or threshold_pp < 0:
        raise ValueError("The alert threshold must be finite and nonnegative")
    gate.require_rate(max_reject_rate)


def publication_work(spark: SparkSession, namespace: str, contract: Contract, source_sha256: str | None = None) -> str:
    """What a lost run's stages must be about to be of use: the contract, the source's name, and the buckets."""
    return "|".join([contract.name, *contract.columns, source_sha256 or "-", str(tables.bucket_count(spark, namespace))])


@dataclass
class _Run:
    """One publication: where it writes, what it has counted, and its audit row at the end."""

    spark: SparkSession
    namespace: str
    contract: Contract
    threshold_pp: float
    place: str
    source: str | None
    resumed: str | None = None
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTED, 0))

    def __enter__(self):
        drop_dead(self.spark, self.place, self.spark.table(self.table(tables.RUNS)), but=self.resumed)
        work = publication_work(self.spark, self.namespace, self.contract, self.source)
        self.stage = Stage(self.spark, self.place, self.id, work, self.resumed)
        self.stage.begin()
        return self

    def __exit__(self, kind, problem, _):
        try:
            if isinstance(problem, Exception):
                self.record("FAILED", str(problem))
        finally:
            self.stage.drop()

    def table(self, name: str) -> str:
        return f"{self.namespace}.{name}"

    def record(self, status: str, message: str) -> None:
        tables.record_run(
            self.spark, self.namespace, self.id, status, self.source, self.counts, message, self.threshold_pp
        )

    def store_raw(self, unique: DataFrame) -> None:
        """Append the distinct rows that bronze lacks of this source; a new source lacks all."""
        rows = quality.bronze_rows(unique, self.source, self.started, self.contract)
        tables.store_bronze(self.spark, self.namespace, self.source, rows)

    def check(self, unique: DataFrame) -> DataFrame:
        """Run the rules once and stage what the later steps need, at the size of their files."""
        flagged = quality.flag_conflicts(quality.type_rows(unique, self.contract), self.contract)
        decided = quality.decided_rows(quality.apply_rules(flagged, self.contract), self.contract)
        parts = tables.bucket_count(self.spark, self.namespace)
        if not parts:
            return self.stage.keep(decided.hint("rebalance"), "checked", "accepted")
        # Accepted ids are unique, and a task gets those of one bucket of the version tables. Rejected
        # rows may all have one id, so they go by their hash.
        place = F.when(F.col("accepted"), F.col(self.contract.id)).otherwise(F.xxhash64(quality.HASH))
        return self.stage.keep(decided.repartition(parts, place), "checked", "accepted")

    def store_rejects(self, checked: DataFrame) -> None:
        rejected = checked.where("NOT accepted").select(quality.HASH, "raw", MALFORMED, quality.REASON)
        rows = quality.quarantined_rows(rejected, self.source, self.started).withColumn("run_id", F.lit(self.id))
        tables.append(rows, self.table(tables.QUARANTINE))

    def pass_gate(self, checked: DataFrame, max_reject_rate: float) -> int:
        """Count the batch and raise unless it may be published; returns the facts to expect."""
        seen = gate.gate_outcomes(gate.batch_counts(checked, self.contract), [max_reject_rate]).first()
        self.counts.update({name: seen[name] for name in COUNTED[:-1]})
        if seen.outcome != gate.PASS:
            raise ValueError(seen.outcome)
        return seen.monthly_rows

    def store_versions(self, accepted: DataFrame, expected: int) -> None:
        limits = accepted.select(self.contract.id, self.contract.limit)
        tables.append(reshape.accounts(limits, self.id, self.contract), self.table(tables.ACCOUNTS))
        facts = reshape.facts(reshape.unfold(accepted, self.contract), self.id, self.contract, with_band=True)
        tables.append(facts, self.table(tables.REPAYMENTS))
        stored = self.spark.table(self.table(tables.REPAYMENTS)).where(F.col("run_id") == self.id).count()
        if stored != expected:
            raise ValueError("Account-month reconciliation failed")
        self.counts["monthly_rows"] = stored


#: Steps whose results a run stages, in order.
STEPS = ("unique", "checked")


def _place(spark: SparkSession, namespace: str, root: str | None) -> str:
    return f"{root or spark.conf.get('spark.sql.warehouse.dir') + '/' + namespace}/stages"


def resumable(spark: SparkSession, namespace: str, root: str | None = None) -> dict[str, list[str]]:
    """Lost runs, none of which has an audit row, with the steps that ``publish(..., resume=run)`` would not repeat.

    A run that another driver is still working on is listed as well.
    """
    return lost_runs(spark, _place(spark, namespace, root), spark.table(f"{namespace}.{tables.RUNS}"), STEPS)


def publish(
    spark: SparkSession,
    raw: DataFrame,
    namespace: str,
    source_sha256: str | None = None,
    max_reject_rate: float = 0.01,
    threshold_pp: float = 1.0,
    contract: Contract = CARD,
    root: str | None = None,
    size: int = 0,
    resume: str | None = None,
) -> dict:
    """Check, store and publish one snapshot; returns the run record.

    ``resume`` names a run whose driver was lost (``resumable`` lists them): what
    it has staged is taken over, and the source is not read, nor a rule run, again.

    ``source_sha256`` names the source; without it the snapshot's own digest
    does. ``size`` is what is known of the source's bytes. Raw rows and rejects
    are stored before the gate, so that a refused batch can be looked into;
    versions are stored after it and the audit row last.
    """
    require_parameters(namespace, source_sha256, max_reject_rate, threshold_pp)
    partitions = max(settings_for(size)[0], int(spark.conf.get(SHUFFLE)))
    tables.install(spark, namespace, contract, root, partitions)
    place = _place(spark, namespace, root)
    with sized_for(spark, size), _Run(spark, namespace, contract, threshold_pp, place, source_sha256, resume) as run:
        unique = run.stage.keep(quality.unique_rows(raw, contract), "unique")
        run.source = run.source or quality.snapshot_digest(unique).first().digest
        run.store_raw(unique)
        checked = run.check(unique)
        run.store_rejects(checked)
        expected = run.pass_gate(checked, max_reject_rate)
        run.store_versions(checked.where("accepted"), expected)
        run.record("SUCCESS", "Full snapshot published")
        return {"run_id": run.id, "status": "SUCCESS", **run.counts}


def publish_file(
    spark: SparkSession,
    path: str,
    namespace: str,
    expected_sha256: str | None = None,
    contract: Contract = CARD,
    **options,
) -> dict:
    """Publish a CSV snapshot under its own identity.

    ``expected_sha256`` pins the bytes of a file, or of all files of a folder (see
    ``source_pin``): other bytes are refused before anything is read.
    """
    if expected_sha256 is not None:
        require_digest(source_pin(spark, path), expected_sha256)
    raw = read_snapshot(spark, path, contract)
    return publish(spark, raw, namespace, contract=contract, size=source_bytes(spark, path), **options)


def integrity_report(spark: SparkSession, namespace: str) -> DataFrame:
    """Observed against expected counts of the current publication, one row per check."""
    ns = namespace

    def newest(field: str) -> str:
        return tables.newest_success(f"{ns}.{tables.RUNS}", field)

    def one(check: str, observed: str, expected: str) -> str:
        return (
            f"SELECT '{check}' AS check_name, ({observed}) AS observed, "
            f"coalesce({expected}, 0L) AS expected"
        )

    checks = [
        one("current_accounts", f"SELECT count(*) FROM {ns}.silver_accounts",
            newest("accepted_accounts")),
        one("current_account_months", f"SELECT count(*) FROM {ns}.silver_repayments",
            newest("monthly_rows")),
        one("bronze_rows_of_source",
            f"SELECT count(*) FROM {ns}.{tables.BRONZE} "
            f"WHERE source_sha256 = {newest('source_sha256')}",
            f"{newest('raw_rows')} - {newest('exact_duplicates')}"),
        one("rejected_rows_of_run",
            f"SELECT count(*) FROM {ns}.{tables.QUARANTINE} "
            f"WHERE run_id = {newest('run_id')}",
            newest("rejected_rows")),
        one("repeated_account_months",
            f"SELECT count(*) FROM (SELECT 1 FROM {ns}.silver_repayments "
            "GROUP BY account_id, month HAVING count(*) > 1)", "0L"),
        # both views show one run, so that the account is the key, and the tables' buckets serve it
        one("facts_without_account",
            "SELECT coalesce(sum(n), 0L) FROM (SELECT account_id, count(*) AS n "
            f"FROM {ns}.silver_repayments GROUP BY account_id) "
            f"LEFT ANTI JOIN {ns}.silver_accounts USING (account_id)", "0L"),
    ]
    report = spark.sql(" UNION ALL ".join(checks))
    return report.withColumn("passed", F.col("observed") == F.col("expected"))
