import os
import pathlib
import time
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from card_rows import card
from pyspark.sql import functions as F

from tallyframe import CARD, integrity_report, publish, publish_file, read_snapshot, source_pin
from tallyframe.operators import gate
from tallyframe.operators.quality import snapshot_digest, unique_rows
from tallyframe.plans import publish as plan
from tallyframe.sources import tables
from tallyframe.sources.stages import Stage, drop_dead

SHA = "a" * 64


@pytest.fixture
def place(tmp_path):
    """A namespace and its folder."""
    name = f"ns_{uuid.uuid4().hex}"
    return name, f"file://{tmp_path}/{name}"


@pytest.fixture
def batch(cards):
    return cards(
        card(), card(), card(ID="2", PAY_0="2", BILL_AMT1="50"), card(ID="3", AGE="1"),
        card(ID="4"), card(ID="04"),
    )


def staged(root):
    folder = pathlib.Path(root.removeprefix("file://")) / "stages"
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def counts(spark, ns):
    names = (
        "bronze_records", "quarantine_records", "account_versions", "repayment_versions",
        "silver_accounts", "silver_repayments",
    )
    return tuple(spark.table(f"{ns}.{n}").count() for n in names)


def test_publish_and_replay(spark, place, batch):
    ns, root = place
    first = publish(spark, batch, ns, SHA, max_reject_rate=0.9, root=root)
    assert {k: v for k, v in first.items() if k != "run_id"} == {
        "status": "SUCCESS", "raw_rows": 6, "exact_duplicates": 1, "rejected_rows": 3,
        "accepted_accounts": 2, "monthly_rows": 12,
    }
    assert counts(spark, ns) == (5, 3, 2, 12, 2, 12)
    ingested = spark.table(f"{ns}.bronze_records").select("ingested_at").distinct().collect()
    assert len(ingested) == 1

    second = publish(spark, batch, ns, SHA, max_reject_rate=0.9)
    assert counts(spark, ns) == (5, 6, 4, 24, 2, 12)
    assert spark.table(f"{ns}.silver_accounts").first().run_id == second["run_id"]
    assert spark.table(f"{ns}.bronze_records").select("ingested_at").distinct().collect() == ingested
    assert [r.asDict() for r in integrity_report(spark, ns).where("NOT passed").collect()] == []

    audit = spark.table(f"{ns}.pipeline_runs")
    assert audit.columns[:10] == [
        "run_id", "completed_at", "status", "source_sha256", "raw_rows", "exact_duplicates",
        "rejected_rows", "accepted_accounts", "monthly_rows", "message",
    ]
    age = datetime.now(timezone.utc) - audit.first().completed_at.astimezone(timezone.utc)
    assert timedelta(0) <= age < timedelta(minutes=10)
    assert staged(root) == []


def test_changed_rows_under_a_known_source_are_appended_and_judged_alone(spark, place, cards):
    ns, root = place
    publish(spark, cards(card(), card(ID="2")), ns, SHA, root=root)
    run = publish(spark, cards(card(), card(ID="3")), ns, SHA)
    assert (run["raw_rows"], run["accepted_accounts"]) == (2, 2)
    assert spark.table(f"{ns}.bronze_records").count() == 3
    accounts = spark.table(f"{ns}.silver_accounts").select("account_id").collect()
    assert sorted(r.account_id for r in accounts) == [1, 3]


def test_readers_keep_what_a_refused_batch_would_have_replaced(spark, place, batch):
    ns, root = place
    shown = publish(spark, batch, ns, SHA, max_reject_rate=0.9, root=root)["run_id"]
    before = counts(spark, ns)
    # every row of the new batch breaks one rule, and the batch goes by its own digest
    too_young = batch.withColumn("AGE", F.lit("17"))
    with pytest.raises(ValueError, match=gate.NO_ROWS):
        publish(spark, too_young, ns)
    log = {r.status: r for r in spark.table(f"{ns}.pipeline_runs").collect()}
    assert set(log) == {"SUCCESS", "FAILED"} and log["SUCCESS"].run_id == shown
    assert log["FAILED"].source_sha256 == snapshot_digest(unique_rows(too_young)).first().digest
    assert (log["FAILED"].raw_rows, log["FAILED"].rejected_rows, log["FAILED"].accepted_accounts) == (6, 5, 0)
    runs = {r.run_id for v in ("silver_accounts", "silver_repayments") for r in spark.table(f"{ns}.{v}").select("run_id").distinct().collect()}
    assert runs == {shown}
    # raw rows and rejects of the refused batch are there for triage, versions are not
    assert counts(spark, ns) == (before[0] + 5, before[1] + 5, *before[2:])


def test_the_reject_rate_gate(spark, place, batch):
    ns, root = place
    with pytest.raises(ValueError, match="Quarantine rate exceeds"):
        publish(spark, batch, ns, SHA, max_reject_rate=0.59, root=root)
    assert publish(spark, batch, ns, SHA, max_reject_rate=0.6)["status"] == "SUCCESS"


def test_views_exist_and_are_empty_before_the_first_success(spark, place, batch):
    ns, root = place
    with pytest.raises(ValueError):
        publish(spark, batch, ns, SHA, root=root)
    for view in ("silver_accounts", "silver_repayments", "gold_monthly", "gold_segments",
                 "gold_alerts"):
        assert spark.table(f"{ns}.{view}").count() == 0


@pytest.mark.parametrize("broken", [
    tables.BRONZE, tables.QUARANTINE, tables.ACCOUNTS, tables.REPAYMENTS,
])
@pytest.mark.parametrize("death", [RuntimeError, KeyboardInterrupt])
def test_a_break_at_any_step_stays_invisible(spark, place, batch, monkeypatch, broken, death):
    ns, root = place
    good = publish(spark, batch, ns, SHA, max_reject_rate=0.9, root=root)
    seen = counts(spark, ns)[4:]
    whole = tables.append

    def breaking(rows, table):
        whole(rows, table)
        if table.endswith(broken):
            raise death("lost")

    monkeypatch.setattr(tables, "append", breaking)
    with pytest.raises(death):
        publish(spark, batch.where("ID <> '2'"), ns, "b" * 64, 0.9)
    monkeypatch.undo()
    assert counts(spark, ns)[4:] == seen
    assert spark.table(f"{ns}.silver_repayments").first().run_id == good["run_id"]
    failures = spark.table(f"{ns}.pipeline_runs").where("status = 'FAILED'").count()
    assert failures == (1 if death is RuntimeError else 0)
    # The same source can simply be published again.
    again = publish(spark, batch.where("ID <> '2'"), ns, "b" * 64, 0.9)
    assert spark.table(f"{ns}.silver_accounts").count() == again["accepted_accounts"] == 1
    assert spark.table(f"{ns}.bronze_records").where(f"source_sha256 = '{'b' * 64}'").count() == 4


def test_a_part_left_by_a_dead_writer_is_completed(spark, place, batch):
    ns, root = place
    publish(spark, batch, ns, SHA, 0.9, root=root)
    part = spark.table(f"{ns}.bronze_records").drop("source_sha256").limit(2)
    part.write.parquet(f"{root}/{tables.BRONZE}/source_sha256={'b' * 64}")
    publish(spark, batch, ns, "b" * 64, 0.9)
    hashes = spark.table(f"{ns}.bronze_records").where(f"source_sha256 = '{'b' * 64}'")
    assert hashes.count() == hashes.select("record_hash").distinct().count() == 5


def test_an_empty_batch_is_refused(spark, place, batch):
    ns, root = place
    with pytest.raises(ValueError, match="No usable input"):
        publish(spark, batch.limit(0), ns, SHA, 1.0, root=root)
    assert spark.table(f"{ns}.pipeline_runs").first().raw_rows == 0


def test_facts_that_do_not_add_up_block_publication(spark, place, batch, monkeypatch):
    ns, root = place
    whole = tables.append

    def losing(rows, table):
        whole(rows.where("month > '2005-04-01'") if table.endswith(tables.REPAYMENTS) else rows,
              table)

    monkeypatch.setattr(tables, "append", losing)
    with pytest.raises(ValueError, match="Account-month reconciliation failed"):
        publish(spark, batch, ns, SHA, 0.9, root=root)
    monkeypatch.undo()
    assert spark.table(f"{ns}.silver_repayments").count() == 0


def test_each_run_is_judged_by_its_own_threshold(spark, place, cards):
    ns, root = place
    rows = [card(ID=str(n)) for n in range(1, 50)] + [card(ID="50", PAY_0="2")]
    publish(spark, cards(*rows), ns, SHA, threshold_pp=1.0, root=root)
    alerts = spark.table(f"{ns}.gold_alerts").where("month = '2005-09-01'")
    assert alerts.first().alert_status == "REVIEW"
    with pytest.raises(ValueError):
        publish(spark, cards(card(AGE="1")), ns, "e" * 64, threshold_pp=50.0)
    assert alerts.first().threshold_percentage_points == 1.0
    publish(spark, cards(*rows), ns, SHA, threshold_pp=2.5)
    latest = spark.table(f"{ns}.gold_alerts").where("month = '2005-09-01'").first()
    assert latest.threshold_percentage_points == 2.5
    assert latest.alert_status == "WITHIN_THRESHOLD"
    assert dict(spark.table(f"{ns}.gold_alerts").dtypes)["threshold_percentage_points"] == "double"


def test_a_new_catalog_finds_earlier_runs_by_folder(spark, place, batch):
    ns, root = place
    publish(spark, batch, ns, SHA, 0.9, root=root)
    before = counts(spark, ns)
    spark.sql(f"DROP SCHEMA {ns} CASCADE")
    tables.install(spark, ns, CARD, root)
    assert counts(spark, ns) == before


@pytest.mark.parametrize("change, message", [
    ({"namespace": "a b"}, "namespace"),
    ({"namespace": "a.b.c"}, "namespace"),
    ({"source_sha256": "A" * 64}, "hex"),
    ({"source_sha256": "a" * 63}, "hex"),
    ({"threshold_pp": -0.1}, "threshold"),
    ({"threshold_pp": float("nan")}, "threshold"),
    ({"threshold_pp": float("inf")}, "threshold"),
    ({"max_reject_rate": 1.5}, "max_reject_rate"),
])
def test_bad_parameters_are_refused_before_anything_exists(spark, place, batch, change, message):
    ns, root = place
    given = {"namespace": ns, "source_sha256": SHA, "root": root} | change
    with pytest.raises(ValueError, match=message):
        publish(spark, batch, **given)
    assert not spark.catalog.databaseExists(ns)


def test_publish_from_a_pinned_file(spark, place, tmp_path):
    ns, root = place
    path = tmp_path / "snapshot.csv"
    path.write_text("\n".join([",".join(CARD.columns), ",".join(card()), ",".join(card(ID="2"))]))
    pin = source_pin(spark, str(path))
    with pytest.raises(ValueError, match="checksum"):
        publish_file(spark, str(path), ns, "0" * 64, root=root)
    assert not spark.catalog.databaseExists(ns)
    run = publish_file(spark, str(path), ns, pin, root=root)
    assert run["accepted_accounts"] == 2
    # without a name the source is known by its rows
    again = publish(spark, read_snapshot(spark, str(path)).orderBy("ID"), ns, root=root)
    known = {r.run_id: r.source_sha256 for r in spark.table(f"{ns}.pipeline_runs").collect()}
    assert known[run["run_id"]] == known[again["run_id"]] and spark.table(f"{ns}.bronze_records").count() == 2


def test_catalog_qualified_and_managed_namespace(spark, batch):
    ns = f"spark_catalog.ns_{uuid.uuid4().hex}"
    assert spark.sql("SELECT current_catalog()").first()[0] == "spark_catalog"
    publish(spark, batch, ns, SHA, 0.9)
    spark.catalog.setCurrentDatabase(ns.split(".")[1])
    try:
        assert spark.sql("SELECT count(*) FROM gold_monthly").first()[0] == 6
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_stages_are_dropped_when_a_step_fails(spark, place, batch, monkeypatch):
    ns, root = place
    monkeypatch.setattr(plan._Run, "check", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        publish(spark, batch, ns, SHA, root=root)
    assert staged(root) == []


def test_only_stages_of_runs_that_are_over_are_dropped(spark, place, batch):
    ns, root = place
    done = publish(spark, batch, ns, SHA, 0.9, root=root)["run_id"]
    spark.range(3).write.saveAsTable(f"{ns}.stage_customers")  # a user's table
    folder = pathlib.Path(root.removeprefix("file://")) / "stages"
    for run in (done, "writing", "silent"):
        (folder / run / "unique").mkdir(parents=True)
    long_ago = time.time() - 8 * 86400
    os.utime(folder / "silent", (long_ago, long_ago))
    publish(spark, batch, ns, SHA, 0.9, root=root)
    assert staged(root) == ["writing"]
    assert spark.table(f"{ns}.stage_customers").count() == 3
    assert counts(spark, ns)[4:] == (2, 12)
    assert drop_dead(spark, f"{root}/stages", spark.table(f"{ns}.pipeline_runs"), days=0.0) == ["writing"]
    assert drop_dead(spark, f"{root}/nowhere", spark.table(f"{ns}.pipeline_runs")) == []


def test_an_older_definition_of_a_view_is_replaced(spark, place, batch):
    ns, root = place
    tables.install(spark, ns, CARD, root)
    spark.sql(f"CREATE OR REPLACE VIEW {ns}.gold_monthly AS SELECT 'old' AS definition")
    publish(spark, batch, ns, SHA, 0.9, root=root)
    assert "delayed_account_rate" in spark.table(f"{ns}.gold_monthly").columns
    assert spark.table(f"{ns}.gold_alerts").count() == 6


def test_the_integrity_report_names_what_is_damaged(spark, place, batch):
    ns, root = place
    publish(spark, batch, ns, SHA, 0.9, root=root)
    facts = spark.table(f"{ns}.{tables.REPAYMENTS}").limit(1).collect()
    schema = spark.table(f"{ns}.{tables.REPAYMENTS}").schema
    tables.append(spark.createDataFrame(facts, schema), f"{ns}.{tables.REPAYMENTS}")
    stranger = spark.createDataFrame(facts, schema).withColumn("account_id", F.lit(-5).cast("long"))
    tables.append(stranger, f"{ns}.{tables.REPAYMENTS}")
    broken = {r.check_name: (r.observed, r.expected) for r in integrity_report(spark, ns).where("NOT passed").collect()}
    assert broken == {
        "current_account_months": (14, 12), "repeated_account_months": (1, 0), "facts_without_account": (1, 0),
    }


def test_a_message_is_stored_whole(spark, place, batch, monkeypatch):
    ns, root = place
    monkeypatch.setattr(plan._Run, "check", lambda *a: (_ for _ in ()).throw(RuntimeError("m" * 5000)))
    with pytest.raises(RuntimeError):
        publish(spark, batch, ns, SHA, root=root)
    assert spark.table(f"{ns}.pipeline_runs").first().message == "m" * 5000


class Killed(BaseException):
    """The driver is gone: nothing is tidied up."""


@pytest.mark.parametrize("step", ["nothing", "unique", tables.BRONZE, "checked", tables.QUARANTINE, tables.ACCOUNTS, tables.REPAYMENTS])
def test_a_run_goes_on_where_a_lost_one_was(spark, place, batch, monkeypatch, step):
    ns, root = place
    tables.install(spark, ns, root=root)
    keep, append, drop = Stage.keep, tables.append, Stage.drop

    def keeping(self, rows, name, *more):
        if step == "nothing":
            raise Killed
        kept = keep(self, rows, name, *more)
        if name == step:
            raise Killed
        return kept

    def appending(rows, table):
        append(rows, table)
        if table.endswith(step):
            raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(Stage, "keep", keeping)
        patch.setattr(tables, "append", appending)
        patch.setattr(Stage, "drop", lambda self: None)
        with pytest.raises(Killed):
            publish(spark, batch, ns, SHA, max_reject_rate=0.9, root=root)
    done = {"nothing": [], "unique": ["unique"], tables.BRONZE: ["unique"]}.get(step, ["unique", "checked"])
    found = plan.resumable(spark, ns, root)
    assert list(found.values()) == [done]
    assert drop is Stage.drop and counts(spark, ns)[4:] == (0, 0)

    def counting(self, rows, name, *more):
        written.append(name) if name not in done else None
        return keep(self, rows, name, *more)

    written = []
    monkeypatch.setattr(Stage, "keep", counting)
    # another source under the name is not looked at where the rows are staged
    raw = batch if "unique" not in done else batch.limit(0)
    run = publish(spark, raw, ns, SHA, max_reject_rate=0.9, root=root, resume=next(iter(found)))
    assert written == [s for s in plan.STEPS if s not in done]
    assert {k: v for k, v in run.items() if k != "run_id"} == {
        "status": "SUCCESS", "raw_rows": 6, "exact_duplicates": 1, "rejected_rows": 3, "accepted_accounts": 2, "monthly_rows": 12,
    }
    assert spark.table(f"{ns}.bronze_records").count() == 5 and counts(spark, ns)[4:] == (2, 12)
    assert staged(root) == [] and plan.resumable(spark, ns, root) == {}


def test_only_the_same_work_is_taken_over(spark, place, batch):
    ns, root = place
    tables.install(spark, ns, root=root)
    lost = Stage(spark, f"{root}/stages", "lost", plan.publication_work(spark, ns, CARD, "b" * 64))
    lost.begin()
    for run in ("lost", "never"):
        with pytest.raises(ValueError, match="another source"):
            publish(spark, batch, ns, SHA, max_reject_rate=0.9, root=root, resume=run)
    assert list(plan.resumable(spark, ns, root)) == ["lost"]
