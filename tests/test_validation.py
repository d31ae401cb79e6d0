import json
import uuid

from card_rows import card

from tallyframe import CARD
from tallyframe.__main__ import main


def snapshot(folder):
    path = folder / "snapshot.csv"
    rows = [card(ID=str(n), PAY_0=str(n % 4), BILL_AMT1=str(n)) for n in range(1, 200)]
    rows += [rows[0], card(ID="200", AGE="7")]
    path.write_text("\n".join(map(",".join, [CARD.columns, *rows])) + "\n")
    return str(path)


def test_validate_then_report_from_the_command_line(spark, tmp_path, capsys):
    ns, evidence = f"ns_{uuid.uuid4().hex}", tmp_path / "evidence"
    root = f"file://{tmp_path}/{ns}"
    main(["validate", ns, snapshot(tmp_path), "--root", root, "--evidence", str(evidence)])
    run = json.loads(capsys.readouterr().out)
    assert run["first_run"]["accepted_accounts"] == 199
    assert run["first_run"]["exact_duplicates"] == run["first_run"]["rejected_rows"] == 1
    assert set(run["checks"].values()) == {True}
    written = spark.read.option("header", True).csv(str(evidence / "gold_segments"))
    assert written.count() == 6 and written.columns[:2] == ["month", "limit_band"]
    assert spark.read.json(str(evidence / "pipeline_runs")).count() == 3

    main(["report", ns])
    out = capsys.readouterr().out
    assert "REVIEW" in out and "age_out_of_range" in out


def test_publish_from_the_command_line(spark, tmp_path, capsys):
    ns = f"ns_{uuid.uuid4().hex}"
    main(["publish", ns, snapshot(tmp_path), "--root", f"file://{tmp_path}/{ns}",
          "--max-reject-rate", "0.5"])
    assert json.loads(capsys.readouterr().out)["status"] == "SUCCESS"
