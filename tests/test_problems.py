"""The general problems' operators on small fixtures, against brute force and defined corner cases."""

import json
import math
import random
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from docketry.operators import drift, instants, proximity, snapshots

FILE = "file_id string, agency string, period string, received_at timestamp_ntz, row_no int, payload string"


def files(spark, *rows):
    return spark.createDataFrame([(f"{a}_{p}", a, p, datetime(2026, 1, 1 + d), n, t if isinstance(t, str) or t is None else json.dumps(t)) for a, p, d, n, t in rows], FILE)


def test_drift_names_each_change(spark, rows):
    df = files(
        spark,
        ("x", "2026-01", 0, 1, {"Case #": "1", "Code": "13A", "LAT": 35.1, "Weapon": None}),
        ("x", "2026-03", 0, 1, {"CASE_NO": 1, "Code": 13, "LAT": 35.2, "Premise": "Shop"}),
        ("y", "2026-03", 0, 1, {"only": 1}),
    )
    assert rows(drift.drift(df)) == sorted([
        ("x_2026-03", "renamed", "Case #", "CASE_NO"), ("x_2026-03", "retyped", "Case #", "CASE_NO"), ("x_2026-03", "retyped", "Code", "Code"),
        ("x_2026-03", "removed", "Weapon", ""), ("x_2026-03", "added", "", "Premise"),
    ])


def test_drift_infers_renames_of_unregistered_keys(spark, rows):
    rnd = random.Random(7)
    value = lambda: {"kind": rnd.choice(["Shop", "House", "Street"]), "cost": rnd.randint(100, 99999), "flag": rnd.random() < 0.1}
    old = [("x", "2026-01", 0, n, {"qqKind": v["kind"], "zCost": v["cost"], "noted": v["flag"]}) for n in range(200) for v in [value()]]
    new = [("x", "2026-02", 0, n, {"sort of place": v["kind"], "amt": str(v["cost"]), "colour": "deep blue %d" % n}) for n in range(200) for v in [value()]]
    assert rows(drift.drift(files(spark, *old, *new))) == sorted([
        ("x_2026-02", "renamed", "qqKind", "sort of place"), ("x_2026-02", "renamed", "zCost", "amt"), ("x_2026-02", "retyped", "zCost", "amt"),
        ("x_2026-02", "removed", "noted", ""), ("x_2026-02", "added", "", "colour"),
    ])


def test_value_likeness_reads_texts_to_their_end(spark):
    head = "12-34-56 " * 5  # 45 characters
    payloads = [("F1", {"x": f"{head}north {i}"}) for i in range(3)] + [("F2", {"y": f"{head}{i}/{i} (77)"}) for i in range(3)]
    df = spark.createDataFrame([(f, json.dumps(p)) for f, p in payloads], "file_id string, payload string")
    wanted = spark.createDataFrame([("F1", "x", "F2", "y")], "a_file string, a string, b_file string, b string")
    assert [r["likeness"] for r in drift.value_likeness(df, wanted).collect() if r["likeness"] > 0.1] == []


def test_drift_takes_the_last_delivery_and_survives_bad_payloads(spark, rows):
    df = files(spark, ("x", "2026-01", 0, 1, {"a": 1}), ("x", "2026-02", 0, 1, {"b": 1}), ("x", "2026-02", 3, 1, {"a": 1}), ("x", "2026-02", 3, 2, "no json"), ("x", "2026-02", 3, 3, None), ("x", "2026-02", 3, 4, "[1]"))
    assert rows(drift.drift(df)) == []
    assert drift.drift(df.limit(0)).count() == 0


def test_ingest_rescues_promotes_and_replays(spark):
    df = files(spark, ("x", "2026-01", 0, 1, {"Town": {"name": "ELM", "county": "C"}, "lat": "35.5", "Longitude": "west", "weapon": "Hands", "x1": [1, 2]}), ("x", "2026-01", 0, 2, "broken"), ("x", "2026-01", 0, 3, "{}"))
    out = {r["row_no"]: r for r in drift.promote(drift.replay(drift.ingest(df)), {"weapon": "string"}).collect()}
    assert (out[1]["city"], out[1]["lat"], out[1]["lon"], out[1]["weapon"]) == ("ELM", 35.5, None, "Hands")
    assert json.loads(out[1]["_rescued"]) == {"Town": {"name": "ELM", "county": "C"}, "Longitude": "west", "x1": [1, 2]}
    assert json.loads(out[2]["_rescued"]) == {drift.MALFORMED: "broken"} and out[3]["_rescued"] is None


def test_latest_delivery_keeps_one_copy(spark, rows):
    df = files(spark, ("x", "2026-01", 0, 1, {"a": 1}), ("x", "2026-01", 5, 1, {"a": 2}), ("x", "2026-01", 5, 1, {"a": 2}))
    assert rows(drift.latest_delivery(df), "payload") == [('{"a": 2}',)]


SNAP = "snapshot string, incident_id string, offense_code string, clearance_status string, key string, field string"


def test_snapshot_changes(spark, rows):
    df = spark.createDataFrame([
        ("1", "a", "23F", "Open", "z", None), ("1", "a", " 23f ", "OPEN", "z", None), ("1", "b", "290", None, "", ""), ("1", "c", "1", "x", "", ""), ("1", None, "1", "x", "", ""),
        ("2", "a", "23F", "Closed", "", ""), ("2", "b", "290", "  ", "", ""), ("2", "d", None, None, "", ""), (None, "e", "1", "1", "", ""),
        ("3", "a", "13A", "open", "", ""), ("3", "b", "290", "", "", ""), ("3", "c", "1", "x", "", ""),
    ], SNAP)
    assert rows(snapshots.snapshot_changes(df)) == sorted([
        ("2", "a", "changed", "clearance_status"), ("2", "c", "removed", ""), ("2", "d", "added", ""),
        ("3", "a", "changed", "clearance_status"), ("3", "a", "changed", "offense_code"), ("3", "c", "added", ""), ("3", "d", "removed", ""),
    ])
    assert rows(snapshots.snapshot_changes(df.where("snapshot = '1'"))) == [] == rows(snapshots.snapshot_changes(df.limit(0)))


def test_near_sites_equals_brute_force(spark, rows):
    rnd = random.Random(3)
    sites = [(i, rnd.uniform(35.0, 35.02), rnd.uniform(-80.9, -80.88), "n", "k") for i in range(40)] + [(99, None, -80.9, "", ""), (98, 89.9999, 10.0, "", "")]
    points = [(str(i), rnd.uniform(34.99, 35.03), rnd.uniform(-80.91, -80.87)) for i in range(600)] + [("null", None, None), ("nan", math.nan, 1.0), ("far", 500.0, 1.0)]
    s = spark.createDataFrame(sites, "site_id long, lat double, lon double, level string, r string")
    p = spark.createDataFrame(points + points[:5], "record_key string, lat double, lon double")
    want = {(k, i) for k, a, o in points[:600] for i, b, c, *_ in sites[:40] if proximity._metres(a, o, b, c) <= 250}
    for cells in (None, proximity.coverage_bound(s, 250.0)):
        assert set(rows(proximity.near_sites(p, s, 250.0, cells=cells))) == want
    assert proximity.coverage(s, 250.0).count() <= proximity.coverage_bound(s, 250.0)
    assert proximity.near_sites(p.limit(0), s).count() == 0 == proximity.near_sites(p, s.limit(0)).count()


def test_in_regions_equals_the_ray_rule(spark, rows):
    rnd = random.Random(4)
    corner = lambda a, o: {"lat": a, "lon": o}
    star = [corner(35.01 + r * math.sin(t), -80.89 + r * math.cos(t)) for k in range(10) for t, r in [(k * math.pi / 5, 0.009 if k % 2 else 0.004)]]
    hole = [corner(35.009, -80.891), corner(35.011, -80.891), corner(35.011, -80.889), corner(35.009, -80.889)]
    shapes = [(1, [star]), (2, [star, hole]), (3, [[corner(35.0, -80.9), corner(35.02, -80.9)]]), (4, None), (None, [star]), (5, [[corner(35.0001, -80.8999), corner(35.0001, -80.8998), corner(35.0002, -80.8998)]])]
    regions = spark.createDataFrame(shapes, "region_id long, rings array<array<struct<lat:double,lon:double>>>")
    points = [(str(i), rnd.uniform(35.0, 35.02), rnd.uniform(-80.9, -80.88)) for i in range(800)] + [("in", 35.00012, -80.89985), ("null", None, None)]
    p = spark.createDataFrame(points + points[:3], "record_key string, lat double, lon double")
    want = {(k, i) for k, a, o in points if a for i, rings in shapes if i and rings and proximity._holds(proximity._edges(rings), a, o)}
    for cells in (None, 10):
        assert set(rows(proximity.in_regions(p, regions, cells=cells))) == want
    assert {i for _, i in want} == {1, 2, 5} and proximity.in_regions(p.limit(0), regions).count() == 0 == proximity.in_regions(p, regions.limit(0)).count()


@pytest.mark.parametrize("text, want", [("35.129954 N", 35.129954), ("80.725263 W", -80.725263), (" -80.920689° ", -80.920689), ("35.1°n", 35.1), ("-80.7 W", -80.7), ("12", 12.0), ("north", None), ("", None), ("35.1.2 N", None), (None, None)])
def test_degrees(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(drift.read_degrees(F.col("t")).alias("x")).first()["x"] == want


def test_replay_reads_coordinates(spark):
    df = files(spark, ("x", "2026-01", 0, 1, {"LAT": "35.5 N", "x": " -80.5°", "Weapon": "none"}), ("x", "2026-01", 0, 2, {"lat": "bad", "lon": [1]}), ("x", "2026-01", 0, 3, {"lat": True}))
    out = {r["row_no"]: r for r in drift.replay(drift.ingest(df)).collect()}
    assert (out[1]["lat"], out[1]["lon"], json.loads(out[1]["_rescued"])) == (35.5, -80.5, {"Weapon": "none"})
    assert (out[2]["lat"], out[2]["lon"], json.loads(out[2]["_rescued"])) == (None, None, {"lat": "bad", "lon": [1]})
    only = {r["row_no"]: r["_rescued"] for r in drift.ingest(df, targets={"lat": "double"}, keep=("row_no",), only=("lat",)).collect()}
    assert json.loads(only[1]) == {"LAT": "35.5 N"} and json.loads(only[2]) == {"lat": "bad"}


def epoch(*parts, zone="America/New_York", fold=0):
    return int(datetime(*parts, tzinfo=ZoneInfo(zone), fold=fold).timestamp())


@pytest.mark.parametrize("text, want", [
    ("2023-01-02 00:12:42", epoch(2023, 1, 2, 0, 12, 42)), (" 2023-01-02T01:03:55Z ", epoch(2023, 1, 2, 1, 3, 55, zone="UTC")), ("2023-01-02", epoch(2023, 1, 2)),
    ("01/02/2023 1:16 AM", epoch(2023, 1, 2, 1, 16)), ("2023-01-02T02:17:45-06:00", epoch(2023, 1, 2, 8, 17, 45, zone="UTC")), ("1672692929761", 1672692929), ("1672765597", 1672765597),
    ("07/02/2023 4:43 PM EST", epoch(2023, 7, 2, 21, 43, zone="UTC")), ("2023-01-02T02:45:18.321548+00:00", epoch(2023, 1, 2, 2, 45, 18, zone="UTC")), ("Sun, 01 Jan 2023 22:01:39 -0500", epoch(2023, 1, 2, 3, 1, 39, zone="UTC")),
    ("20230102T073810-0500", epoch(2023, 1, 2, 12, 38, 10, zone="UTC")), ("20230202", epoch(2023, 2, 2)), ("Jan 04, 2023", epoch(2023, 1, 4)), ("1/10/23 03:23", epoch(2023, 1, 10, 3, 23)),
    ("12-Jan-2023", epoch(2023, 1, 12)), ("12 January 2023 00:44 UTC", epoch(2023, 1, 12, 0, 44, zone="UTC")), ("January 10, 2023 at 12:38 a.m.", epoch(2023, 1, 10, 0, 38)),
    ("11/05/2023 1:30 AM", epoch(2023, 11, 5, 5, 30, zone="UTC")), ("2023-03-12 02:30:00", epoch(2023, 3, 12, 7, 30, zone="UTC")), ("2024-02-29", epoch(2024, 2, 29)),
    ("2023-02-29", None), ("13/45/2023", None), ("00/00/0000", None), ("25/12/2023", None), ("TBD", None), ("1e9?", None), ("", None), ("x" * 5000, None), ("2023-01-02 25:00", None), (None, None),
])
def test_instants(spark, text, want):
    df = spark.createDataFrame([("s", "k", "f", text)], "source string, record_key string, field string, value string")
    got = instants.normalise_instants(df, fixed_month_first=F.lit(True)).collect()
    assert len(got) == 1 and got[0]["epoch_s"] == want


def test_sources_settle_their_own_order(spark):
    data = [("d", "13.05.2026"), ("d", "04.05.2026"), ("m", "05/13/2026"), ("m", "04/05/2026"), ("open", "04/05/2026"), ("told", "04/05/2026")]
    df = spark.createDataFrame([(s, str(i), "f", v) for i, (s, v) in enumerate(data)], "source string, record_key string, field string, value string")
    more = spark.createDataFrame([("told", "30/01/2026")], "source string, value string")
    got = {r["record_key"]: r for r in instants.normalise_instants(df, evidence=more).collect()}
    local = lambda k: datetime.fromtimestamp(got[k]["epoch_s"], timezone.utc).astimezone(ZoneInfo("America/New_York")).strftime("%m-%d")
    assert [local(str(i)) for i in range(6)] == ["05-13", "05-04", "05-13", "04-05", "04-05", "05-04"]
    assert [got[str(i)]["ambiguous"] for i in range(6)] == [False, False, False, False, True, False]


def test_shares_are_the_fixpoint_of_em(spark):
    counts = spark.createDataFrame([(1000.0, 1.0, 0.0), (10.0, 3.0, 1.0), (5.0, 0.0, 0.0)], "b double, m double, d double")
    got = [r["s"] for r in counts.select(instants.reading_shares(F.col("b"), F.col("m"), F.col("d"), F.lit(0.5)).alias("s")).collect()]
    for (b, m, d), s in zip([(1000, 1, 0), (10, 3, 1), (5, 0, 0)], got):
        assert s == pytest.approx((m + b * s) / (m + b + d)) and s == {1000: 1.0, 10: 0.75, 5: 0.5}[b]


def test_sources_too_many_to_broadcast_give_the_same(spark, rows, monkeypatch):
    data = [("d", "13.05.2026"), ("d", "04.05.2026"), ("m", "05/13/2026"), ("m", "04/05/2026"), ("open", "04/05/2026"), (None, "04/05/2026"), ("d", "04.05.2026")]
    df = spark.createDataFrame([(s, str(i), "f", v, "x") for i, (s, v) in enumerate(data)], "source string, record_key string, field string, value string, parts string").drop("parts")
    want = rows(instants.normalise_instants(df), "record_key", "epoch_s", "reading", "posterior", "ambiguous")
    monkeypatch.setattr(instants, "BROADCAST_SOURCES", 0)
    assert rows(instants.normalise_instants(df), "record_key", "epoch_s", "reading", "posterior", "ambiguous") == want and len(want) == 7
