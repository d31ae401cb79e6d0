"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.inputs import (
    ACCOUNT,
    acct_raw,
    card_raw,
    cents,
    run_log,
    scratch_folder,
    slot_coverage,
    table,
)
from tallyframe.contract import CARD, MISSING, Contract, Rule
from tallyframe.functions.expressions import broken_rules, digest_of, guarded_ratio
from tallyframe.operators import checks, gate, keyed, metrics, ordered, quality, reports, reshape
from tallyframe.plans.publish import COUNTED, integrity_report, publication_work, publish, resumable
from tallyframe.sources import pins, tables
from tallyframe.sources.export import write_csv, write_json
from tallyframe.sources.snapshot import read_snapshot, require_digest
from tallyframe.sources.stages import Stage

RUN = "run-1"
# The lineage of rows that no publication has named; no query returns it.
UNNAMED = hashlib.sha256(b"unnamed").hexdigest()
# The derived snapshots are damaged on purpose, about a fifth of their rows.
REJECT_RATE = 0.5


# --- shared steps ----------------------------------------------------------


def _unique(spark, sf_dir):
    return quality.unique_rows(acct_raw(spark, sf_dir), ACCOUNT)


def _checked(spark, sf_dir):
    return quality.check_rows(acct_raw(spark, sf_dir), ACCOUNT)


def _accepted(spark, sf_dir):
    return quality.accepted_rows(_checked(spark, sf_dir), ACCOUNT)


def _facts(spark, sf_dir):
    return reshape.repayments(_accepted(spark, sf_dir), RUN, ACCOUNT)


def _monthly(spark, sf_dir):
    return metrics.monthly(_facts(spark, sf_dir), ACCOUNT)


def _card(spark, sf_dir):
    return quality.check_rows(card_raw(spark, sf_dir), CARD)


def _card_silver(spark, sf_dir):
    return reshape.build_silver(quality.accepted_rows(_card(spark, sf_dir), CARD), RUN, CARD)


# --- publication -----------------------------------------------------------


def _publish(
    spark, sf_dir, contract: Contract, namespace: str | None = None, spoil: bool = False
) -> str:
    """Publish the derived snapshot into a namespace of its own in the shared folder."""
    raw = (card_raw if contract is CARD else acct_raw)(spark, sf_dir)
    if spoil:
        raw = raw.withColumn(contract.slots[0].status, F.lit("99"))
    root = None
    if namespace is None:
        root = scratch_folder(spark, contract.name)
        namespace = root.rsplit("/", 1)[1]
    else:
        root = _roots[namespace]
    _roots[namespace] = root
    try:
        # the identity comes from the rows, so it covers every table they are made of
        publish(spark, raw, namespace, None, REJECT_RATE, 1.0, contract, root)
    except ValueError:
        if not spoil:
            raise
    return namespace


_roots: dict[str, str] = {}
_published: dict[tuple[str, str, str], str] = {}


def _publication(spark: SparkSession, sf_dir: str, contract: Contract = ACCOUNT) -> str:
    """One publication per session for all queries that only read it."""
    key = (spark.sparkContext.applicationId, sf_dir, contract.name)
    namespace = _published.get(key)
    if namespace is None or not spark.catalog.databaseExists(namespace):
        namespace = _published[key] = _publish(spark, sf_dir, contract)
    return namespace


def _count(name: str, text: str) -> str:
    return f"(SELECT count(*) FROM {text}) AS {name}"


def publish_replay(spark, sf_dir):
    ns = _publish(spark, sf_dir, ACCOUNT)
    _publish(spark, sf_dir, ACCOUNT, ns)
    return spark.sql("SELECT " + ", ".join([
        _count("bronze_rows", f"{ns}.bronze_records"),
        _count("current_accounts", f"{ns}.silver_accounts"),
        _count("current_facts", f"{ns}.silver_repayments"),
        _count("stored_accounts", f"{ns}.account_versions"),
        _count("quarantined", f"{ns}.quarantine_records"),
        _count("success_runs", f"{ns}.pipeline_runs WHERE status = 'SUCCESS'"),
    ]))


def publish_failure(spark, sf_dir):
    ns = _publish(spark, sf_dir, ACCOUNT)
    _publish(spark, sf_dir, ACCOUNT, ns, spoil=True)
    return spark.sql("SELECT " + ", ".join([
        _count("bronze_rows", f"{ns}.bronze_records"),
        _count("current_accounts", f"{ns}.silver_accounts"),
        _count("current_facts", f"{ns}.silver_repayments"),
        _count("quarantined", f"{ns}.quarantine_records"),
        _count("success_runs", f"{ns}.pipeline_runs WHERE status = 'SUCCESS'"),
        _count("failed_runs", f"{ns}.pipeline_runs WHERE status = 'FAILED'"),
    ]))


def run_audit_counts(spark, sf_dir):
    ns = _publish(spark, sf_dir, ACCOUNT)
    _publish(spark, sf_dir, ACCOUNT, ns, spoil=True)
    return spark.table(f"{ns}.pipeline_runs").select(
        "status", "raw_rows", "exact_duplicates", "rejected_rows", "accepted_accounts",
        "monthly_rows", "message",
    )


def bronze_replay(spark, sf_dir):
    """Append the same batch twice and count the stored rows after each time."""
    root = scratch_folder(spark, "bronze")
    ns = root.rsplit("/", 1)[1]
    tables.install(spark, ns, ACCOUNT, root)
    source = quality.snapshot_digest(_unique(spark, sf_dir)).first().digest
    stored = f"{ns}.{tables.BRONZE}"
    seen = []
    for n in (1, 2):
        batch = quality.bronze_rows(
            _unique(spark, sf_dir), source, F.current_timestamp(), ACCOUNT
        )
        tables.store_bronze(spark, ns, source, batch)
        seen.append(F.struct(
            F.lit(n).alias("replays"),
            F.lit(spark.table(stored).count()).cast("long").alias("bronze_rows"),
        ))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*seen)))


def run_status(spark, sf_dir):
    """The status report of a refused and a published run, without what differs from run to run."""
    ns = _publish(spark, sf_dir, ACCOUNT)
    _publish(spark, sf_dir, ACCOUNT, ns, spoil=True)
    newest_first = reports.run_status(spark.table(f"{ns}.pipeline_runs"))
    return newest_first.select(
        F.col("completed_at").isNotNull().alias("is_dated"), F.length("run_id").alias("id_length"),
        "status", "raw_rows", "exact_duplicates", "rejected_rows", "accepted_accounts", "monthly_rows", "message",
    )


def run_record(spark, sf_dir):
    """What publish() returns to its caller, for a run and its replay."""
    root = scratch_folder(spark, "record")
    ns = root.rsplit("/", 1)[1]
    found = []
    for n in (1, 2):
        run = publish(spark, acct_raw(spark, sf_dir), ns, None, REJECT_RATE, 1.0, ACCOUNT, root)
        stored = spark.table(f"{ns}.pipeline_runs").where(F.col("run_id") == run["run_id"]).count()
        found.append((n, stored, run["status"], *[run[c] for c in COUNTED]))
    return spark.createDataFrame(found, "run int, audit_rows long, status string, " + ", ".join(f"{c} long" for c in COUNTED))


def publish_resumed(spark, sf_dir):
    """A publication that goes on from what a lost one had staged, and without a look at the source."""
    root = scratch_folder(spark, "resumed")
    ns = root.rsplit("/", 1)[1]
    raw = acct_raw(spark, sf_dir)
    tables.install(spark, ns, ACCOUNT, root)
    # what a driver leaves behind that is lost after its first step
    lost = Stage(spark, f"{root}/stages", "lost", publication_work(spark, ns, ACCOUNT))
    lost.begin()
    lost.keep(quality.unique_rows(raw, ACCOUNT), "unique")
    found = ",".join(f"{run}:{'+'.join(steps)}" for run, steps in resumable(spark, ns, root).items())
    run = publish(spark, raw.limit(0), ns, None, REJECT_RATE, 1.0, ACCOUNT, root, resume="lost")
    left = len(resumable(spark, ns, root))
    return spark.createDataFrame([(found, left, run["status"], *[run[c] for c in COUNTED])], "lost_runs string, left_over int, status string, " + ", ".join(f"{c} long" for c in COUNTED))


def refused_headers(spark, sf_dir):
    """Which headers a snapshot may have, and how many rows are then read."""
    raw = acct_raw(spark, sf_dir)
    first, second = ACCOUNT.columns[:2]
    tries = {
        "same": raw,
        "other_order": raw.select(*reversed(ACCOUNT.columns)),
        "column_missing": raw.drop(second),
        "column_more": raw.withColumn("surplus", F.lit("1")),
        "other_case": raw.withColumnRenamed(first, first.upper()),
        "other_name": raw.withColumnRenamed(second, "balance"),
    }
    out = []
    for tried, rows in tries.items():
        folder = scratch_folder(spark, "header")
        rows.write.option("header", True).csv(folder)
        try:
            out.append((tried, "accepted", read_snapshot(spark, folder, ACCOUNT).count()))
        except ValueError:
            out.append((tried, "refused", 0))
    return spark.createDataFrame(out, "tried string, outcome string, rows_read long")


def guard_outcomes(spark, sf_dir):
    """A planned publication for each customer, and whether its parameters would be accepted."""
    key, name = F.col("c_custkey"), F.lower("c_mktsegment")
    plans = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 5 == 0, F.col("c_name")).when(key % 5 == 1, F.concat(name, F.lit("."), name)).when(key % 35 == 2, F.concat(key, name)).otherwise(name).alias("namespace"),
        F.when(key % 3 == 0, F.sha2("c_name", 256)).when(key % 21 == 1, F.upper(F.sha2("c_name", 256))).when(key % 33 == 2, F.left(F.sha2("c_name", 256), F.lit(63))).alias("source_sha256"),
        (F.col("c_acctbal") / 100).alias("threshold_pp"),
        F.when(key % 2 == 0, F.col("c_acctbal") / 5000).otherwise(F.lit(0.01)).alias("max_reject_rate"),
    )
    return gate.parameter_outcomes(plans).select("c_custkey", "outcome")


def integrity_damaged(spark, sf_dir):
    """The integrity report of a namespace with a fact of each month stored twice and a lost account file."""
    ns = _publish(spark, sf_dir, ACCOUNT)
    facts = spark.table(f"{ns}.{tables.REPAYMENTS}")
    again = facts.where(F.col("account_id") == facts.agg(F.min("account_id")).scalar())
    # read whole before its own table is written
    kept = spark.createDataFrame(again.collect(), again.schema)
    tables.append(kept, f"{ns}.{tables.REPAYMENTS}")
    stranger = kept.limit(1).withColumn("account_id", F.lit(-1).cast("long"))
    tables.append(stranger, f"{ns}.{tables.REPAYMENTS}")
    return integrity_report(spark, ns)


def snapshot_csv(spark, sf_dir):
    """Write the snapshot as CSV parts with a header and read it back as text."""
    folder = scratch_folder(spark, "csv")
    acct_raw(spark, sf_dir).write.option("header", True).csv(folder)
    return read_snapshot(spark, folder, ACCOUNT).select(*ACCOUNT.columns)


def malformed_rows(spark, sf_dir):
    """Reasons of a CSV snapshot whose columns stand in another order, with long and short rows."""
    folder = scratch_folder(spark, "malformed")
    turned = list(reversed(ACCOUNT.columns))
    number = F.col("id").try_cast("bigint")
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in turned])
    long = F.concat(line, F.lit(",surplus"))
    short = F.concat_ws(",", *turned[:3])
    lines = acct_raw(spark, sf_dir).select(
        F.when(number % 11 == 0, long).when(number % 13 == 0, short).otherwise(line).alias("value")
    )
    # Every part begins with the header, also one that no line falls in: which parts there are does
    # not depend on how the lines are read. Equal lines of different tasks fall in different parts.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = lines.withColumn("part", F.pmod(F.xxhash64("value", F.spark_partition_id()), F.lit(parts)))
    header = spark.range(0, parts, 1, 1).select(F.lit(",".join(turned)).alias("value"), F.col("id").alias("part"))
    every = lines.withColumn("rank", F.lit(1)).unionByName(header.withColumn("rank", F.lit(0)))
    every.repartition("part").sortWithinPartitions("part", "rank").select("value", "part").write.partitionBy("part").text(folder)
    checked = quality.check_rows(read_snapshot(spark, folder, ACCOUNT), ACCOUNT)
    return checked.groupBy(quality.REASON).agg(F.count(F.lit(1)).alias("rows_found"))


def export_round_trip(spark, sf_dir):
    """The monthly metrics, written as CSV and as JSON and read again."""
    folder = scratch_folder(spark, "export")
    monthly = _monthly(spark, sf_dir)
    write_csv(monthly, f"{folder}/csv")
    write_json(monthly, f"{folder}/json")
    back = [
        spark.read.schema(monthly.schema).option("header", True).csv(f"{folder}/csv"),
        spark.read.schema(monthly.schema).json(f"{folder}/json"),
    ]
    return back[0].withColumn("kind", F.lit("csv")).unionByName(back[1].withColumn("kind", F.lit("json")))


def snapshot_digests(spark, sf_dir):
    """The identities of both derived snapshots."""
    found = [
        quality.snapshot_digest(quality.unique_rows(raw(spark, sf_dir), contract)).select(F.lit(contract.name).alias("snapshot"), "digest")
        for raw, contract in ((acct_raw, ACCOUNT), (card_raw, CARD))
    ]
    return found[0].unionByName(found[1])


def text_digests(spark, sf_dir):
    """One order-free digest of all texts of a language."""
    return table(spark, sf_dir, "documents").groupBy("lang").agg(digest_of(F.sha2("text", 256)).alias("digest"))


def pinned_snapshot(spark, sf_dir):
    """Whether digests pin the accounts: their own, that of the rows in another order, that of changed rows."""
    raw = acct_raw(spark, sf_dir)
    pin = quality.snapshot_digest(quality.unique_rows(raw, ACCOUNT)).first().digest
    tries = {
        "same": raw,
        "other_order": raw.orderBy(F.desc("id")),
        "one_repeated": raw.unionAll(raw.orderBy("id", "limit_bal").limit(1)),
    }
    out = []
    for name, rows in tries.items():
        try:
            require_digest(quality.snapshot_digest(quality.unique_rows(rows, ACCOUNT)).first().digest, pin)
            out.append((name, "accepted"))
        except ValueError:
            out.append((name, "refused"))
    return spark.createDataFrame(out, "tried string, outcome string")


def _account_lines(spark, sf_dir):
    """The accounts as CSV lines, in a folder for each segment and last digit of the id."""
    text = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in ACCOUNT.columns])
    return acct_raw(spark, sf_dir).select("segment", F.substring("id", -1, 1).alias("digit"), text.alias("value"))


def _written(spark, lines, purpose: str) -> str:
    """Text files of sorted lines, one in each folder."""
    folder = scratch_folder(spark, purpose)
    lines.repartition("segment", "digit").sortWithinPartitions("segment", "digit", "value").write.partitionBy("segment", "digit").text(folder)
    return folder


def file_hashes(spark, sf_dir):
    """SHA-256 of the bytes of each file of the accounts, hashed side by side."""
    found = pins.file_hashes(spark, _written(spark, _account_lines(spark, sf_dir), "hashed"))
    place = "segment=([^/]*)/digit=([^/]*)/"
    return found.select(F.regexp_extract("path", place, 1).alias("segment"), F.regexp_extract("path", place, 2).alias("digit"), "length", "sha256")


def pinned_bytes(spark, sf_dir):
    """What pins of bytes accept: the same files, and files of which the first line of one is missing."""
    lines = _account_lines(spark, sf_dir)
    least = lines.agg(F.min(F.struct("segment", "digit", "value")).alias("m")).select("m.*").first()
    cut = lines.where(~((F.col("segment") == least.segment) & (F.col("digit") == least.digit) & (F.col("value") == least.value)))
    folder = _written(spark, lines, "pinned")
    pin = pins.source_pin(spark, folder)
    out = []
    for tried, place in (("same", folder), ("line_missing", _written(spark, cut, "cut"))):
        found = pins.manifest(pins.file_hashes(spark, place)).first()
        try:
            outcome = "accepted" if require_digest(pins.source_pin(spark, place), pin) else ""
        except ValueError:
            outcome = "refused"
        out.append((tried, outcome, found.files, found.bytes))
    return spark.createDataFrame(out, "tried string, outcome string, files long, bytes long")


def reconcile_accounts(spark, sf_dir):
    """Accounts and months in which the published facts differ from a source that nobody checked."""
    typed = quality.type_rows(_unique(spark, sf_dir), ACCOUNT).dropna(subset=list(ACCOUNT.integers))
    published = spark.table(f"{_publication(spark, sf_dir)}.silver_repayments").drop("run_id")
    return checks.reconcile_rows(published, reshape.repayments(typed, RUN, ACCOUNT).drop("run_id"), ["account_id"])


def reconcile_accounts_clean(spark, sf_dir):
    """The same against the checked source: nothing differs, and no row is moved."""
    published = spark.table(f"{_publication(spark, sf_dir)}.silver_repayments").drop("run_id")
    return checks.reconcile_rows(published, _facts(spark, sf_dir).drop("run_id"), ["account_id"])


# --- rules, ratios and trends over the tables themselves --------------------

CUSTOMER_RULES = (
    Rule("nation_out_of_range", "c_nationkey NOT BETWEEN 0 AND 22"),
    Rule("unknown_segment",
         "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"),
    Rule("nonpositive_balance", "c_acctbal <= 0"),
)


def rule_domains(spark, sf_dir):
    reasons = broken_rules(CUSTOMER_RULES).alias("rejection_reason")
    return table(spark, sf_dir, "customer").groupBy(reasons).agg(
        F.count(F.lit(1)).alias("customers")
    )


def conflict_flag(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return keyed.mark_repeated(lines, ["l_orderkey", "l_linenumber"], "in_conflict")


def segment_alerts(spark, sf_dir):
    rates = (
        table(spark, sf_dir, "orders")
        .groupBy(F.trunc("o_orderdate", "year").alias("month"), "o_orderpriority")
        .agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("delayed_account_rate"))
    )
    return metrics.alerts(rates, 0.5, per=("o_orderpriority",))


def monthly_ship_trend(spark, sf_dir):
    months = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.trunc("l_shipdate", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("line_items"),
             F.sum(cents("l_extendedprice")).alias("price_cents"))
    )
    # three looks at the months: their quantiles, the last of each range, all of them
    kept = scratch_folder(spark, "months")
    months.write.parquet(kept)
    trend = ordered.previous(spark.read.schema(months.schema).parquet(kept), "month", ["price_cents"], ranges=8)
    return trend.withColumnRenamed("previous_price_cents", "previous_cents").withColumn("change_cents", F.col("price_cents") - F.col("previous_cents"))


def user_event_gaps(spark, sf_dir):
    """Each user's events of a day with those of the user's day before that had some."""
    days = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    return ordered.previous(days, "day", ["day", "events"], ("user_id",), 16)


def ratio_null_guard(spark, sf_dir):
    owed = F.when(F.col("o_orderstatus") == "F", F.lit(0).cast("long")).otherwise(
        cents("o_totalprice")
    )
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", owed).otherwise(F.lit(0).cast("long"))
    sums = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.sum(owed).alias("owed_cents"), F.sum(urgent).alias("urgent_cents")
    )
    return sums.withColumn(
        "urgent_share", guarded_ratio(F.col("urgent_cents"), F.col("owed_cents"))
    )


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id")


def ri_orphans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return checks.orphans(docs, _labelled(spark, sf_dir), ["doc_id"])


def ri_orphan_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return checks.orphan_count(docs, _labelled(spark, sf_dir), ["doc_id"])


def grain_violations_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day")
    )
    return checks.grain_violations(events, ["user_id", "event_type", "day"])


def reconcile_monthly(spark, sf_dir):
    published = spark.table(f"{_publication(spark, sf_dir)}.gold_monthly")
    return checks.reconcile(published, checks.monthly_from_wide(_accepted(spark, sf_dir), ACCOUNT))


def reconcile_drift(spark, sf_dir):
    """The published metrics against a source that nobody checked: they must differ."""
    typed = quality.type_rows(_unique(spark, sf_dir), ACCOUNT)
    published = spark.table(f"{_publication(spark, sf_dir)}.gold_monthly")
    return checks.reconcile(
        published, checks.monthly_from_wide(typed.dropna(subset=list(ACCOUNT.integers)), ACCOUNT)
    )


def _view(name: str, report: Callable[[DataFrame], DataFrame], contract: Contract = ACCOUNT):
    return lambda s, d: report(s.table(f"{_publication(s, d, contract)}.{name}"))


def segments_latest_month(spark, sf_dir):
    ns = _publication(spark, sf_dir)
    return reports.latest_month_concentration(
        spark.table(f"{ns}.gold_segments"), spark.table(f"{ns}.gold_monthly"), ACCOUNT
    )


def rejected_sample(spark, sf_dir):
    """Three rejected accounts of each reason of the published run, the same ones every time."""
    ns = _publication(spark, sf_dir)
    run = reports.latest_success(spark.table(f"{ns}.pipeline_runs")).first().run_id
    return reports.rejected_sample(spark.table(f"{ns}.quarantine_records"), run, ACCOUNT, 3)


def published_segments_joined(spark, sf_dir):
    """Segments of the published facts by the accounts' own bands; the tables' buckets spare the join a shuffle."""
    ns = _publication(spark, sf_dir)
    return metrics.segments(spark.table(f"{ns}.silver_repayments"), spark.table(f"{ns}.silver_accounts"), ACCOUNT, ("account_id",))


def _run_counts(spark, sf_dir):
    return gate.batch_counts(_checked(spark, sf_dir), ACCOUNT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "slot_coverage": slot_coverage,
    "acct_raw_rows": acct_raw,
    "bronze_hash": lambda s, d: _unique(s, d).select("id", quality.HASH),
    "exact_dedup": lambda s, d: _unique(s, d).select(*ACCOUNT.columns, quality.COPIES),
    "conflict_keys": lambda s, d: keyed.repeated_keys(
        table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    ),
    "conflict_flag": conflict_flag,
    "reject_missing": lambda s, d: quality.type_rows(_unique(s, d), ACCOUNT)
    .where(MISSING)
    .groupBy("segment")
    .agg(F.count(F.lit(1)).alias("rejected_rows")),
    "rule_domains": rule_domains,
    "rejection_reasons": lambda s, d: _checked(s, d)
    .groupBy(quality.REASON)
    .agg(F.count(F.lit(1)).alias("rows_found")),
    "quarantine_rows": lambda s, d: quality.quarantined_rows(
        _checked(s, d), UNNAMED, F.current_timestamp()
    ).select(*ACCOUNT.columns, quality.REASON),
    "accepted_typed": lambda s, d: _accepted(s, d).select(*ACCOUNT.columns),
    "run_counts": _run_counts,
    "gate_decision": lambda s, d: gate.gate_outcomes(
        _run_counts(s, d), [0.0, 0.01, 0.25, 1.0]
    ).drop("exact_duplicates", "monthly_rows"),
    "silver_accounts": lambda s, d: reshape.accounts(_accepted(s, d), RUN, ACCOUNT),
    "limit_bands": lambda s, d: reshape.accounts(_accepted(s, d), RUN, ACCOUNT)
    .groupBy("limit_band")
    .agg(F.count(F.lit(1)).alias("accounts")),
    "silver_repayments": _facts,
    "gold_monthly": _monthly,
    "gold_segments": lambda s, d: metrics.segments(
        reshape.repayments(_accepted(s, d), RUN, ACCOUNT, with_band=True), None, ACCOUNT
    ),
    "gold_segments_joined": lambda s, d: metrics.segments(
        *reversed(reshape.build_silver(_accepted(s, d), RUN, ACCOUNT)), ACCOUNT
    ),
    "gold_alerts": lambda s, d: metrics.alerts(_monthly(s, d), 1.0),
    "segment_alerts": segment_alerts,
    "monthly_ship_trend": monthly_ship_trend,
    "user_event_gaps": user_event_gaps,
    "run_record": run_record,
    "publish_resumed": publish_resumed,
    "refused_headers": refused_headers,
    "guard_outcomes": guard_outcomes,
    "rejected_sample": rejected_sample,
    "published_segments_joined": published_segments_joined,
    "ratio_null_guard": ratio_null_guard,
    "bronze_replay": bronze_replay,
    "latest_success": lambda s, d: reports.latest_success(run_log(s, d)).select(
        "run_id", F.col("completed_at").cast("date").alias("completed_on")
    ),
    "recent_runs": lambda s, d: reports.recent_runs(run_log(s, d)).select(
        "run_id", F.col("completed_at").cast("date").alias("completed_on"), "status"
    ),
    "publish_replay": publish_replay,
    "publish_failure": publish_failure,
    "run_audit_counts": run_audit_counts,
    "segments_latest_month": segments_latest_month,
    "report_monthly": _view("gold_monthly", lambda v: reports.monthly_trend(v, ACCOUNT)),
    "review_alerts": _view("gold_alerts", reports.review_alerts),
    "rejection_triage": _view(
        "quarantine_records", lambda v: reports.rejection_triage(v).drop("run_id")
    ),
    "published_bronze": _view(
        "bronze_records", lambda v: v.select(*ACCOUNT.columns, "record_hash", "copies")
    ),
    "published_accounts": _view("silver_accounts", lambda v: v.drop("run_id")),
    "published_repayments": _view("silver_repayments", lambda v: v.drop("run_id")),
    "published_segments": _view("gold_segments", lambda v: v),
    "published_alerts": _view("gold_alerts", lambda v: v),
    "grain_violations": _view(
        "silver_repayments", lambda v: checks.grain_violations(v, ["account_id", "month"])
    ),
    "grain_violations_events": grain_violations_events,
    "ri_orphans": ri_orphans,
    "ri_orphan_count": ri_orphan_count,
    "monthly_from_wide": lambda s, d: checks.monthly_from_wide(_accepted(s, d), ACCOUNT),
    "reconcile_monthly": reconcile_monthly,
    "reconcile_drift": reconcile_drift,
    "integrity_report": lambda s, d: integrity_report(s, _publication(s, d)),
    "integrity_damaged": integrity_damaged,
    "run_status": run_status,
    "snapshot_csv": snapshot_csv,
    "malformed_rows": malformed_rows,
    "export_round_trip": export_round_trip,
    "snapshot_digests": snapshot_digests,
    "text_digests": text_digests,
    "pinned_snapshot": pinned_snapshot,
    "file_hashes": file_hashes,
    "pinned_bytes": pinned_bytes,
    "reconcile_accounts": reconcile_accounts,
    "reconcile_accounts_clean": reconcile_accounts_clean,
    "card_rejection_reasons": lambda s, d: _card(s, d)
    .groupBy(quality.REASON)
    .agg(F.count(F.lit(1)).alias("rows_found")),
    "card_quarantine_rows": lambda s, d: quality.quarantined_rows(
        _card(s, d), UNNAMED, F.current_timestamp()
    ).select(*CARD.columns, quality.REASON),
    "card_accounts": lambda s, d: _card_silver(s, d)[0],
    "card_repayments": lambda s, d: _card_silver(s, d)[1],
    "card_monthly": lambda s, d: metrics.monthly(_card_silver(s, d)[1]),
    "card_segments": lambda s, d: metrics.segments(
        reshape.repayments(quality.accepted_rows(_card(s, d), CARD), RUN, CARD, with_band=True), None, CARD
    ),
    "card_segments_joined": lambda s, d: metrics.segments(*reversed(_card_silver(s, d))),
    "card_alerts": lambda s, d: metrics.alerts(metrics.monthly(_card_silver(s, d)[1])),
    "card_published_trend": _view("gold_monthly", reports.monthly_trend, CARD),
}
