"""Gates, report, accepted snapshots, pulls and the evaluation of linkage."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docketry import lineage
from docketry.operators import contract, evaluation, gates, jurisdiction, linkage, monthly, restatement
from docketry.sources import cells, layer, people, snapshots

ROWS = "incident_id string, date_reported timestamp, offense_code string, clearance_status string, city string"
CONTRACT = {
    "key": "incident_id", "columns": {"incident_id": {"required": True}, "date_reported": {"type": "date", "required": True, "min": "2000-01-01", "not_future": True}, "offense_code": {"required": True, "regex": r"^(\d{2}[A-Z]|\d{3})$", "regex_severity": "WARN"}},
    "batch_gates": {"max_error_rate": 0.02, "require_reconciled_count": True, "max_staleness_days": 10, "expected_fingerprint": "abc"}, "deadlines": {"month_settle_days": 30}, "volume": {"trailing_months": 3, "robust_z_warn": 3.5},
}
AS_OF = date(2026, 9, 18)


def month_rows(spark, sizes, tail=()):
    """A row a day or more for months from January 2026 on; ``sizes`` are rows per day."""
    data = [(f"{m:02d}{d:02d}{k}", datetime(2026, m, d), "220", "Open", "ELM") for m, n in enumerate(sizes, 1) for d in range(1, (date(2026, m % 12 + 1, 1) - date(2026, m, 1)).days + 1) for k in range(n)]
    return spark.createDataFrame(data + list(tail), ROWS)


def status(frame):
    return sorted((r["gate"], r["status"]) for r in frame.collect())


def test_a_good_batch_passes(spark, tmp_path):
    df = month_rows(spark, [3, 3, 3, 3])
    manifest = {"server_count": df.count(), "rows_fetched": df.count(), "fetched_at": "2026-05-03T12:00:00", "schema_fingerprint": "abc"}
    exceptions, found = gates.audit(df, CONTRACT, date(2026, 6, 30), manifest)
    assert status(found) == [("daily_gaps", "PASS"), ("error_rate", "PASS"), ("freshness", "PASS"), ("reconciled_count", "PASS"), ("restatements", "SKIP"), ("schema_fingerprint", "PASS"), ("volume_anomaly", "PASS")]
    assert gates.passed(found).first()["passed"] and exceptions.count() == 0
    assert snapshots.accept(df, found, tmp_path, manifest)
    kept, said = snapshots.read_snapshot(spark, f"{tmp_path}/accepted")
    assert kept.columns == ["incident_id", "date_reported", "offense_code", "clearance_status"] and kept.count() == df.count() and said == manifest


def test_each_gate_can_fail(spark, tmp_path):
    bad = [("x", None, "220", None, None), ("y", datetime(2026, 6, 3), "9", None, None), ("y", datetime(2026, 6, 3), "220", None, None)]
    df = month_rows(spark, [3, 3, 3, 9], bad)
    manifest = {"server_count": 5, "rows_fetched": 4, "fetched_at": "2026-09-18T12:00:00", "schema_fingerprint": "new"}
    diff = restatement.diff_snapshots(month_rows(spark, [3, 3, 2]), df)
    exceptions, found = gates.audit(df.drop("clearance_status"), CONTRACT | {"batch_gates": CONTRACT["batch_gates"] | {"max_error_rate": 0.001}, "volume": {"trailing_months": 3, "robust_z_warn": 1.5}}, AS_OF, manifest, diff, {"2026-06": "known"})
    got = status(found)
    for gate in (("daily_gaps", "FAIL"), ("error_rate", "FAIL"), ("freshness", "FAIL"), ("reconciled_count", "FAIL"), ("restatements", "WARN"), ("schema_fingerprint", "WARN"), ("volume_anomaly", "WARN"), ("volume_anomaly", "REVIEWED")):
        assert gate in got
    assert not gates.passed(found).first()["passed"] and not snapshots.accept(df, found, tmp_path, manifest) and snapshots.latest_snapshot(spark, tmp_path) is None
    said = json.loads(gates.report("2026-09-18", AS_OF, exceptions, found, df.count(), diff, spark.createDataFrame([("exact", 3)], "method string, rows long")))
    assert said["passed"] is False and said["diff"]["added"] > 0 and said["jurisdiction_methods"] == {"exact": 3}
    assert [(e["severity"], e["rule"], e["rows"]) for e in said["exceptions"]] == [("ERROR", "duplicate_key", 2), ("ERROR", "required_null", 1), ("WARN", "format", 1)]
    assert any(a.startswith("::error title=Gate FAIL%3A error_rate::") for a in gates.annotations(found))


def test_missing_columns_and_empty_batches(spark):
    df = month_rows(spark, [1])
    _, found = gates.audit(df.drop("offense_code"), CONTRACT, AS_OF)
    assert ("required_columns", "FAIL") in status(found)
    _, found = gates.audit(df.limit(0), CONTRACT, AS_OF, {"server_count": 0, "rows_fetched": 0, "fetched_at": "2026-09-18", "schema_fingerprint": "abc"})
    assert ("freshness", "FAIL") in status(found) and ("error_rate", "PASS") in status(found)
    assert gates.passed(found.limit(0)).first()["passed"]


def test_file_gates(spark, rows):
    files = spark.createDataFrame([("a", "2026-08", datetime(2026, 9, 15)), ("b", "2026-08", datetime(2026, 9, 16))], "file_id string, period string, received timestamp")
    assert rows(gates.file_deadline(files), "status") == [("PASS",), ("WARN",)]
    dated = spark.createDataFrame([("a", "2026-08", datetime(2026, 8, 31)), ("b", "2026-08", datetime(2026, 9, 1)), ("c", "2026-08", None)], "file_id string, period string, date_reported timestamp")
    assert rows(gates.period_coverage(dated), "status") == [("PASS",), ("WARN",), ("WARN",)]


def test_contract_anchors_and_repeated_null_keys(spark, rows):
    df = spark.createDataFrame([("a", "X"), ("a", "Y"), (None, "Y$"), (None, "Z")], "k string, v string")
    said = {"key": "k", "columns": {"v": {"regex": r"^X$|Y\$"}}}
    assert rows(contract.validate(df, said, AS_OF), "record_key", "rule", "value") == [("<null>", "format", "Z"), ("a", "duplicate_key", "a"), ("a", "duplicate_key", "a"), ("a", "format", "Y")]


def test_pull_writes_a_reconciled_snapshot(spark, tmp_path):
    got = layer.pull(spark, "mem", tmp_path, "2020-01-01", "2026-09-18T12:00:00", "tests.fake_layer:fetch", 3)
    assert got.server_count == got.rows_fetched == 25 and got.reconciled and got.max_date_reported.startswith("2023-11-14")
    at = snapshots.latest_snapshot(spark, tmp_path)
    assert at.endswith("/2026-09-18")
    df, manifest = snapshots.read_snapshot(spark, at)
    assert df.count() == 25 and dict(df.dtypes)["DATE_REPORTED"] == "timestamp" and manifest["rows_fetched"] == 25
    with pytest.raises(ValueError, match="absent"):
        snapshots.load_mapped(spark, at)


def test_document_head(spark):
    first = "Summary\nReporting Agency: Dunmere Wardens \nReporting Period: Sept. 2026\n"
    read = lambda t: tuple(spark.createDataFrame([(t,)], "t string").select(cells.document_head(F.col("t")).alias("h")).first()["h"])
    assert read(first.replace("Sept", "Sep")) == ("Dunmere Wardens", "2026-09") and read("Department: X\nMonth: 9/2026") == ("X", "2026-09") and read("Month: March 2025") == (None, "2025-03") and read("none") == (None, None)
    with pytest.raises(Exception, match="unrecognised period"):
        read("Period: Thermidor 2026")


def test_resolved_column_and_series_from_a_month(spark, rows):
    gaz = spark.createDataFrame([("DUNMERE", "DUN", ["00232"]), ("ARDLEY", None, ["00288"])], "canonical string, alias string, zips array<string>")
    df = spark.createDataFrame([("1", "Dun"), ("2", "DUNMRE"), ("3", None), ("4", "elsewhere"), ("5", "Dun")], "id string, city string")
    out, crosswalk = jurisdiction.resolve_column(df, gaz)
    assert rows(out, "id", "jurisdiction") == [("1", "DUNMERE"), ("2", "DUNMERE"), ("3", None), ("4", None), ("5", "DUNMERE")]
    assert [(r["raw"], r["method"], r["rows"]) for r in crosswalk.collect()] == [("Dun", "exact", 2), ("", "unresolved", 1), ("DUNMRE", "fuzzy", 1), ("elsewhere", "unresolved", 1)]
    series = spark.createDataFrame([(date(2026, m, 1), m) for m in (3, 1, 2)], "month date, n int")
    assert [r["n"] for r in monthly.from_month(series, date(2026, 2, 1)).collect()] == [2, 3]


def test_linkage_floor(spark):
    dev = evaluation.evaluate(*people.labelled_sources(spark, 300, seed=7))
    test = evaluation.evaluate(*people.labelled_sources(spark, 600, seed=2026), fixed_threshold=0.65)
    got, base, block = (f.first() for f in (test.quality, test.baseline, test.blocking))
    assert got["f1"] >= 0.97 and got["precision"] >= 0.99 and block["pair_completeness"] >= 0.99 and got["f1"] > base["f1"] + 0.3
    assert 0.4 <= dev.threshold <= 0.9 and block["reduction_ratio"] > 0.9
    # one assignment serves every threshold
    for t in (0.5, 0.8):
        own = linkage.quality(linkage.one_to_one(test.scored, t), test.truth).first()
        assert tuple(test.swept.where(F.col("threshold") == t).select("tp", "fp", "fn", "f1").first()) == (own["tp"], own["fp"], own["fn"], own["f1"])
    kinds = {r["corruption"]: (r["true_pairs"], r["recall"]) for r in test.by_corruption.collect()}
    assert sum(n for n, _ in kinds.values()) == test.truth.count() and kinds["none"][1] > 0.99 and "multiple" in kinds
    assert evaluation.false_positives(test.links, test.truth, test.scored).count() == got["fp"] and evaluation.false_negatives(test.links, test.truth, test.scored).count() == got["fn"]
    assert json.loads(evaluation.summary(dev, test))["test"]["at_threshold"]["f1"] == got["f1"]


def test_threshold_choice(spark):
    swept = spark.createDataFrame([(0.4, 0.99, 1.0), (0.6, 0.996, 0.99), (0.7, 0.999, 0.986), (0.8, 1.0, 0.9)], "threshold double, precision double, recall double")
    assert evaluation.conservative_threshold(swept) == 0.7 and evaluation.conservative_threshold(swept, min_precision=1.1) == 0.8


def test_links_need_no_pair_that_cannot_reach_the_threshold(spark, rows):
    a, b = people.labelled_sources(spark, 250, seed=3)
    pa, pb = lineage.cut(linkage.prepare(a)), lineage.cut(linkage.prepare(b))
    every = lineage.cut(linkage.score_pairs(pa, pb, linkage.candidate_pairs(pa, pb)))
    few = lineage.cut(linkage.reachable_pairs(pa, pb, 0.65))
    above = lambda df: rows(df.where("score >= 0.65"), "rec_id_a", "rec_id_b", "score")
    assert above(linkage.score_pairs(pa, pb, few)) == above(every) and few.count() == few.distinct().count() < 0.6 * every.count()


def test_ties_take_no_round_for_each_link(spark, rows, monkeypatch):
    calls = []
    monkeypatch.setattr(linkage, "cut", lambda df: calls.append(1) or lineage.cut(df))
    tied = [(f"A{i:02d}", f"B{j:02d}", 0.8, i == j) for i in range(12) for j in range(12)] + [("A00", "B11", 0.9, None)]
    got = linkage.one_to_one(spark.createDataFrame(tied, "rec_id_a string, rec_id_b string, score double, same boolean"), 0.65)
    taken, want = set(), []
    for a, b, score, _ in sorted(tied, key=lambda x: (-x[2], x[0], x[1])):
        if not {a, b} & taken:
            taken |= {a, b}
            want.append((a, b, score))
    assert rows(got, "rec_id_a", "rec_id_b", "score") == sorted(want) and got.where("same").count() == 0 and len(calls) <= 5
