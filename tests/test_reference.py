"""Audit, publishing, diff, resolution, linkage and ingestion operators on small fixtures."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docketry import schema
from docketry.functions import similarity, text
from docketry.operators import contract, jurisdiction, linkage, monthly, restatement, timeliness
from docketry.sources import agency_csv, cells


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("code, group", [("13A", "violent"), (" 09a ", "violent"), ("23F", "property"), ("240", "property"), ("13B", "other_criminal"), ("899", "non_criminal"), ("", "other_criminal"), (None, "unknown")])
def test_offense_group(spark, code, group):
    assert one(spark, code, text.offense_group) == group


def test_text_normal_forms(spark):
    for raw, plain in [("Señor-Åse", "SENOR-ASE"), (None, ""), ("ﬁsh", "FISH"), ("ＥＬＭ １", "ELM 1"), ("cafe\u0301", "CAFE"), ("№ 5 Ⅻ", "NO 5 XII"), ("Дом x", " X"), ("", "")]:
        assert one(spark, raw, text.ascii_upper) == plain
    assert one(spark, "The Dunmere P.D.", text.normalize_agency) == one(spark, "DUNMERE Police Dept", text.normalize_agency) == "DUNMERE POLICE DEPARTMENT"
    assert one(spark, "Ardley Cnty Sheriff Office", text.normalize_agency) == "ARDLEY COUNTY SHERIFFS OFFICE"
    assert tuple(one(spark, "77 West Granary Avenue, Suite 9C", text.normalize_address)) == ("77 W GRANARY AV", "9C")
    assert tuple(one(spark, "5 Lagoon Pky # 12", text.normalize_address)) == ("5 LAGOON PKWY", "12")
    assert tuple(one(spark, "41 N. Sorrel Trail", text.normalize_address)) == ("41 N SORREL TRL", None)
    assert tuple(one(spark, "D'Arcy-Holt III", text.normalize_person_name)) == ("DARCY HOLT", "III")


def test_schema_mapping(spark):
    df = spark.createDataFrame([("1", "2", "x", "d", "y")], ["Case Number", "Report Number", "Officer Unit", "Offense", "a`b"])
    mapped, plan = schema.map_columns(df)
    assert mapped.columns == ["incident_id", "offense_desc"] and plan.of("repeated") == ["Report Number"] and plan.of("unknown") == ["Officer Unit", "a`b"]
    assert plan.absent == ("date_reported", "offense_code") and not plan.usable()
    assert schema.plan_headers(["Case", "Report Date", "Code"]).usable()
    assert schema.schema_fingerprint(["B x", "a"]) == schema.schema_fingerprint(["A", "b_X"]) == "3930219ebff5"
    # camel case is no parting of words
    assert schema.normal_header(" ReportDate! ") == "reportdate" and schema.normal_header("GlobalID") == "globalid"
    keys = spark.createDataFrame([("ReportDate",), ("report DATE",), ("GlobalID",)], "k string")
    assert [tuple(r) for r in keys.select(schema.header_key(F.col("k")), schema.parted_key(F.col("k"))).collect()] == [("reportdate", "report_date"), ("report_date", "report_date"), ("globalid", "global_id")]


def test_similarities(spark):
    pair = lambda a, b, f: spark.createDataFrame([(a, b)], "a string, b string").select(f(F.col("a"), F.col("b")).alias("x")).first()["x"]
    for a, b in [("CHARLOTTE", "CHARLOTE"), ("", "A"), ("ABC", "XYZ"), ("KITTEN", "SITTING")]:
        assert pair(a, b, similarity.indel_ratio) == pytest.approx(similarity.ratio_of(a, b))
    assert similarity.jaro_winkler_of("MARTHA", "MARHTA") == pytest.approx(0.961111, abs=1e-6)
    assert similarity.jaro_winkler_of("", "") == 1.0 and similarity.jaro_winkler_of("", "A") == 0.0
    assert pair("MAIN ST 12", "12 MAIN ST", similarity.token_set_ratio) == 100.0
    assert [pair(a, b, similarity.dob_similarity) for a, b in [("1990-01-02", "1990-02-01"), ("1990-01-02", "1990-01-03"), ("", "1990-01-02"), ("1990-01-02", "1985-03-04")]] == [0.85, 0.6, 0.5, 0.0]


ROWS = "incident_id string, date_reported timestamp, date_occurred timestamp, clearance_date timestamp, offense_code string, city string, jurisdiction string, _copies int, rule string"
CONTRACT = {"key": "incident_id", "columns": {"incident_id": {"required": True}, "date_reported": {"type": "date", "required": True, "min": "2000-01-01", "not_future": True}, "offense_code": {"required": True, "regex": "^[0-9]{3}$"}}, "row_rules": [{"name": n, "severity": "WARN"} for n in contract.ROW_RULES]}


def test_contract(spark, rows):
    d = lambda *a: datetime(*a)
    df = spark.createDataFrame([
        ("20260801-1", d(2026, 8, 1), d(2026, 8, 1), None, "220", "X", "X", 1, ""), ("20260802-2", d(2026, 8, 3, 5), d(2026, 8, 4), d(2026, 8, 1), "220", "Y", None, 1, ""),
        ("20260805-3", d(2026, 8, 5), None, None, "22\n", None, None, 1, ""), ("20260805-3", d(2026, 8, 5), None, None, None, None, None, 1, ""), (None, d(2030, 1, 1), None, None, "220", None, None, 1, ""), (None, d(1999, 1, 1), None, None, "220", None, None, 1, ""),
    ], ROWS)
    got = rows(contract.validate(df, CONTRACT, date(2026, 9, 1)), "record_key", "rule")
    assert got == sorted([
        ("20260802-2", r) for r in ("cleared_before_reported", "id_date_mismatch", "jurisdiction_unresolved", "not_local_midnight", "occurred_after_reported")
    ] + [("20260805-3", "duplicate_key")] * 2 + [("20260805-3", "format"), ("20260805-3", "required_null"), ("<null>", "future_date"), ("<null>", "implausibly_old"), ("<null>", "required_null"), ("<null>", "required_null")])
    bad = contract.validate(df, CONTRACT, date(2026, 9, 1))
    assert rows(contract.error_rate(df, bad), "rows", "quarantined") == [(6, 2)]
    assert contract.clean_rows(df, bad, "incident_id").count() == 2
    assert rows(contract.validate(df.drop("offense_code"), CONTRACT, date(2026, 9, 1)).where("rule = 'missing_column'"), "record_key", "column") == [("*", "offense_code")]
    assert contract.validate(df.limit(0), CONTRACT, date(2026, 9, 1)).count() == 0


def test_timeliness(spark, rows):
    df = spark.createDataFrame([("2026-08", datetime(2026, 9, 15)), ("2026-08", datetime(2026, 9, 18)), ("2026-12", datetime(2027, 1, 15))], "p string, r timestamp")
    assert sorted(tuple(x["d"]) for x in df.select(timeliness.deadline(F.col("p"), F.col("r")).alias("d")).collect()) == [(date(2026, 9, 15), "LATE", 3), (date(2026, 9, 15), "ON_TIME", 0), (date(2027, 1, 15), "ON_TIME", 0)]
    months = spark.createDataFrame([(date(2026, m, 1), 250 * 30) for m in range(1, 13)] + [(date(2027, 1, 1), 480)], "month date, n long")
    z = timeliness.volume_anomalies(months).first()
    assert z["flag"] and z["robust_z"] < -3.5
    days = spark.createDataFrame([(datetime(2026, 8, d),) for d in (1, 2, 4)], "t timestamp")
    assert rows(timeliness.daily_gaps(days, "t"), "day") == [(date(2026, 8, 3),)] and timeliness.daily_gaps(days.limit(0), "t").count() == 0


def test_monthly(spark, rows):
    data = [(datetime(y, m, 5), "120", None) for y in (2024, 2025) for m in range(1, 13) for _ in range(y - 2022)] + [(datetime(2025, 12, 31), "240", "Unfounded"), (datetime(2025, 6, 1), "899", None)]
    df = spark.createDataFrame(data, "date_reported timestamp, offense_code string, clearance_status string")
    m = monthly.monthly_counts(df, date(2026, 3, 1))
    assert m.count() == 24 and rows(m.groupBy().sum("violent", "property")) == [(60, 0)]
    assert rows(monthly.trailing_12_change(m, "violent"), "last_12", "prior_12", "pct_change") == [(36, 24, 50.0)]
    assert monthly.trailing_12_change(m.limit(5), "violent").count() == 0


def test_restatement(spark, rows):
    kind = "incident_id string, date_reported timestamp, offense_code string, clearance_status string"
    d = datetime(2026, 7, 5)
    old = spark.createDataFrame([("a", d, "240", "Open"), ("b", d, "220", "Open"), ("c", d, "220", None), ("z", None, "1", "1"), ("a", d, "240", "Open")], kind)
    new = spark.createDataFrame([("a", d, "120", "Open"), ("b", d, "220", "Closed"), ("e", d, "240", None), ("f", datetime(2026, 8, 1), "240", None)], kind)
    diff = restatement.diff_snapshots(old, new)
    assert rows(diff.added) == [("e",)] and rows(diff.removed) == [("c",)] and rows(diff.changed, "incident_id", "field") == [("a", "offense_code"), ("b", "clearance_status")]
    assert rows(diff.restatements, "group", "delta") == [("property", -1), ("violent", 1)] and rows(restatement.headline(diff)) == [(1, 1, 2, 2)]


def test_jurisdiction_tiers(spark):
    gaz = spark.createDataFrame([("CHARLOTTE", "CLT", ["28202"]), ("MINT HILL", None, ["28227"]), ("MATTHEWS", None, ["28105", "28227"])], "canonical string, alias string, zips array<string>")
    raw = ["Charlotte, NC 28202-1234", "CLT", "CHARLOTTEJAVASCRIPT VOID", "Charlote", "28105", "28227", "XYZ", None, ""]
    got = {r["raw"]: (r["canonical"], r["method"]) for r in jurisdiction.resolve_places(spark.createDataFrame([(r,) for r in raw], "raw string"), gaz).collect()}
    assert got == {raw[0]: ("CHARLOTTE", "exact"), "CLT": ("CHARLOTTE", "exact"), raw[2]: ("CHARLOTTE", "prefix"), "Charlote": ("CHARLOTTE", "fuzzy"), "28105": ("MATTHEWS", "zip"), "28227": (None, "unresolved"), "XYZ": (None, "unresolved"), "": (None, "unresolved")}


def test_jurisdiction_candidates_lose_no_match(spark):
    import random

    rnd = random.Random(2)
    listed = ["CASTELLAN", "NORTH ARDLEY", "DUNMERE", "PENHALLOW", "MT O", "COUNTY (OPEN)"]
    spell = lambda w: "".join(c if rnd.random() < 0.85 else rnd.choice(["", "E", c + c]) for c in w)
    raw = sorted({spell(w) for w in listed for _ in range(25)} | set(listed))
    gaz = spark.createDataFrame([(w, None, None) for w in listed], "canonical string, alias string, zips array<string>")
    values = spark.createDataFrame([(r,) for r in raw], "raw string")
    cleaned = dict(map(tuple, values.select("raw", jurisdiction.clean_place(F.col("raw")).getField("name")).collect()))
    got = {r["raw"]: (r["canonical"], r["method"]) for r in jurisdiction.resolve_places(values, gaz).collect()}
    for r, name in cleaned.items():
        ranked = sorted(((similarity.ratio_of(name, w), w) for w in listed), key=lambda x: (-x[0], x[1]))
        begun = [w for w in listed if len(w) >= 6 and name.startswith(w)]
        want = (None, "unresolved")
        if name in listed:
            want = (name, "exact")
        elif len(begun) == 1:
            want = (begun[0], "prefix")
        elif len(name) >= 4 and ranked[0][0] >= 80 and ranked[0][0] - ranked[1][0] >= 10:
            want = (ranked[0][1], "fuzzy")
        assert got[r] == want
    assert len({m for _, m in got.values()}) >= 3


PERSON = "rec_id string, first_name string, last_name string, dob string, address string, zip string"


def test_linkage(spark, rows):
    a = spark.createDataFrame([("A1", "Robert", "Hayes", "1980-03-04", "12 Main St", "28202"), ("A2", "John", "Smith Jr", "1990-01-01", "5 Oak Ave", "28203"), ("A3", "Maria", "Garcia Lopez", "1975-05-06", "9 Elm St", "28204"), ("A4", None, None, None, None, None)], PERSON)
    b = spark.createDataFrame([("B1", "Bob", "Hayes", "1980-04-03", "12 MAIN STREET", "28202"), ("B2", "John", "Smith Sr", "1960-01-01", "5 Oak Av", "28203"), ("B3", "Garcia Lopez", "Maria", "1975-05-06", "9 ELM ST APT 2", "28204"), ("B4", None, None, "nan", None, None)], PERSON)
    links, scored, _ = linkage.link(a, b, 0.65, {"BOB": "ROBERT"})
    assert rows(links, "rec_id_a", "rec_id_b") == [("A1", "B1"), ("A3", "B3")]
    truth = spark.createDataFrame([("A1", "B1"), ("A3", "B3"), ("A9", "B9")], "rec_id_a string, rec_id_b string")
    assert rows(linkage.quality(links, truth), "tp", "fp", "fn", "precision") == [(2, 0, 1, 1.0)]
    assert linkage.link(a.limit(0), b)[0].count() == 0


def test_one_to_one_is_greedy(spark, rows):
    import random

    rnd = random.Random(5)
    pairs = [(f"a{i}", f"b{j}", rnd.choice([0.7, 0.8, 0.9, 0.95])) for i in range(8) for j in range(8) if rnd.random() < 0.5]
    used, want = set(), []
    for x, y, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if x not in used and y not in used:
            used |= {x, y}
            want.append((x, y))
    got = linkage.one_to_one(spark.createDataFrame(pairs, "rec_id_a string, rec_id_b string, score double"), 0.65)
    assert rows(got, "rec_id_a", "rec_id_b") == sorted(want)


def test_agency_csv(spark, tmp_path, rows):
    body = "Dunmere Wardens\nExport – Q3\n\nCase;Reported Date;Offense Date;NIBRS Code;Street Address;Town;Town\nD1;09/04/2026 7:15 pm;2026-09-03;240;3 ELM ST;DUNMERE;q\nD2;9/5/71;;13A;\"8 FORT DR; REAR\";o’clock;q\n\nD3;someday;12-Sep-2026;290;x;y;q\nD4;Sep 3, 2026;9/2/26;;;;q\nGrand Total;4;;;;;\n"
    (tmp_path / "x.csv").write_bytes(body.replace("\n", "\r\n").encode("cp1252"))
    df, log = agency_csv.read_agency_csv(spark, str(tmp_path / "x.csv"), "DUNMERE")
    assert (log.encoding, log.header_row, log.footer_rows_dropped, log.delimiter) == ("cp1252", 3, 2, ";")
    assert log.unparseable_dates == {"date_reported": 1, "date_occurred": 0} and log.mapping.of("repeated") == ["Town "] and not log.mapping.usable()
    got = {r["incident_id"]: r for r in df.collect()}
    assert [got[k]["date_reported"] for k in ("D1", "D2", "D3", "D4")] == [datetime(2026, 9, 4, 19, 15), datetime(1971, 9, 5), None, datetime(2026, 9, 3)]
    assert [got[k]["date_occurred"] for k in ("D3", "D4")] == [datetime(2026, 9, 12), datetime(2026, 9, 2)]
    assert got["D2"]["city"] == "o’clock" and got["D2"]["address"] == "8 FORT DR; REAR" and got["D1"]["agency"] == "DUNMERE" and got["D4"]["city"] is None
    (tmp_path / "none.csv").write_bytes(b"")
    empty, log = agency_csv.read_agency_csv(spark, str(tmp_path / "none.csv"))
    assert empty.columns == [] and log.mapping.absent == schema.REQUIRED


def test_agency_csv_in_splits(spark, tmp_path):
    lines = ["Export", "Case;Report Date;Code", *[f"X{i};2026-09-{1 + i % 28:02d};23F" for i in range(4000)]]
    (tmp_path / "x.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df, log = agency_csv.read_agency_csv(spark, str(tmp_path / "x.csv"))
        assert df.rdd.getNumPartitions() > 3 and df.distinct().count() == df.count() == 4000 and log.header_row == 1 and log.mapping.usable()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_cell_tables(spark, rows):
    grid = [["NIBRS", "Description", "Prior Year", "This Month"], ["220", "Burglary", "2", "44†"], ["240", "Car theft", "0", "–"], ["290", "Damage", "7", "1,003"], ["35A", "Drugs", "9", "12?"], ["", "Total", "18", "1,050"]]
    df = spark.createDataFrame([("p", 1 if i < 3 else 2, 0, i, c) for i, c in enumerate(grid)], "path string, page int, table int, row int, cells array<string>")
    read = cells.read_cells(df)
    assert rows(read.where("kind = 'data'"), "offense_code", "count") == [("220", 44), ("240", 0), ("290", 1003)]
    assert rows(read.where("kind = 'exception'"), "offense_code") == [("35A",)] and rows(cells.reconcile(read), "warning") == [("jump: 220",), ("jump: 290",), ("sum differs from printed total",)]
