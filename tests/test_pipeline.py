"""The monthly run from snapshot to page, and the commands."""

import json
import re
from datetime import date, datetime

import pytest

from docketry import pipeline
from docketry.publish import page
from docketry.sources import snapshots

CONTRACT = {"key": "incident_id", "columns": {"incident_id": {"required": True}, "date_reported": {"type": "date", "required": True}, "offense_code": {"required": True}}, "row_rules": [{"name": "jurisdiction_unresolved", "severity": "WARN"}], "batch_gates": {"max_error_rate": 0.05, "require_reconciled_count": True, "max_staleness_days": 60}}


def write_pull(spark, root, fetched, extra=(), lost=0):
    data = [(f"{y}{m:02d}{d:02d}", datetime(y, m, d), "220" if d % 2 else "13A", "Unfounded" if d == 28 else "Open", "DUNMRE" if d == 5 else "DUNMERE") for y in (2024, 2025) for m in range(1, 13) for d in range(1, 1 + [31, 28 + (y == 2024), 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1])]
    df = spark.createDataFrame(data + list(extra), "`Case Number` string, `Report Date` timestamp, Code string, Status string, City string")
    n = df.count()
    snapshots.write_snapshot(df, f"{root}/raw", fetched[:10], {"fetched_at": fetched, "server_count": n + lost, "rows_fetched": n, "schema_fingerprint": "x"})


def test_run_publishes_accepts_and_compares(spark, tmp_path):
    gaz = spark.createDataFrame([("DUNMERE", None, ["00232"])], "canonical string, alias string, zips array<string>")
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, str(tmp_path), CONTRACT, gaz)
    write_pull(spark, tmp_path, "2026-02-01T10:00:00", [("dup", datetime(2025, 3, 3), "220", "Open", "FAR"), ("dup", datetime(2025, 3, 3), "220", "Open", "FAR")])
    passed, report = pipeline.run(spark, str(tmp_path), CONTRACT, gaz)
    said = json.loads(report)
    assert passed and said["diff"] is None and said["jurisdiction_methods"] == {"exact": 707, "fuzzy": 24, "unresolved": 2}
    assert [(e["rule"], e["rows"]) for e in said["exceptions"]] == [("duplicate_key", 2), ("jurisdiction_unresolved", 2)]
    html = (tmp_path / "output" / "index.html").read_text()
    figures = json.loads(re.search(r'id="figures">(.*?)</script>', html)[1])
    assert len(figures["months"]) == 24 and html.count("<svg") == 2 and figures["changes"]["violent"]["last_12"] == 179 - 12
    assert snapshots.read_snapshot(spark, snapshots.latest_snapshot(spark, tmp_path / "accepted"))[0].count() == 733
    write_pull(spark, tmp_path, "2026-02-02T10:00:00", [("late", datetime(2025, 3, 3), "220", "Open", "DUNMERE")])
    passed, report = pipeline.run(spark, str(tmp_path), CONTRACT, gaz)
    assert passed and {k: json.loads(report)["diff"][k] for k in ("added", "removed", "restated")} == {"added": 1, "removed": 1, "restated": 0}
    write_pull(spark, tmp_path, "2026-02-03T10:00:00", lost=1)
    before = html_before = (tmp_path / "output" / "index.html").read_text()
    assert not pipeline.run(spark, str(tmp_path), CONTRACT, gaz)[0] and before == html_before == (tmp_path / "output" / "index.html").read_text()


def test_audit_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Case,Report Date,Code\nA,2026-08-01,220\nB,2026-09-01,220\nB,2026-08-02,\n")
    exceptions, verdicts, log = pipeline.audit_file(spark, str(tmp_path / "x.csv"), CONTRACT, date(2026, 9, 16), "2026-08")
    assert sorted((r["gate"], r["status"]) for r in verdicts.collect()) == [("error_rate", "FAIL"), ("file_deadline", "WARN"), ("period_coverage", "WARN")]
    assert exceptions.count() == 3 and log.mapping.usable()


def test_a_page_escapes_and_stands_without_months(spark):
    none = spark.createDataFrame([], "month date, violent int, settled boolean")
    gates = spark.createDataFrame([("g", "FAIL", "<b>&")], "gate string, status string, detail string")
    html = page.render("<t>", none, {"violent": spark.createDataFrame([], "last_12 int, pct_change double")}, gates, gates.limit(0))
    assert "<b>&" not in html.split("<script")[0] and "&lt;b&gt;&amp;" in html and "<svg" not in html
