"""Layer source, snapshot directories and the streaming counts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docketry.sources import agency_csv, layer, snapshots
from docketry.streaming.reports import daily_reports
from tests import fake_layer


def test_layer_pages_every_feature(spark, rows, monkeypatch):
    spark.dataSource.register(layer.LayerSource)
    options = {"url": "mem", "fetcher": "tests.fake_layer:fetch", "partitions": "4", "pagesize": "3"}
    df = spark.read.format("layer").options(**options).load()
    assert rows(df, "OBJECTID") == [(i * 3,) for i in range(1, 26)]
    assert df.where("CODE = '13A'").count() == 13
    assert layer.server_count("mem", fetch=fake_layer.fetch) == 25
    assert layer.Manifest("u", "w", "t", 25, 24).reconciled is False
    assert df.limit(1).select(layer.local_time(F.lit("1767153600000")).alias("x")).first()["x"] == datetime(2025, 12, 30, 23)


def test_layer_reader_pushes_simple_filters():
    reader = layer.LayerReader({"url": "mem", "since": "2022-01-01"}, fake_layer.fetch, [])
    kept = list(reader.pushFilters([layer.EqualTo(("CODE",), "O'X"), layer.GreaterThan(("OBJECTID",), 4)]))
    assert len(kept) == 2 and reader.condition() == "(DATE_REPORTED >= DATE '2022-01-01') AND (CODE = 'O''X') AND (OBJECTID > 4)"


def test_fetch_retries_and_gives_up(monkeypatch):
    tries = []
    monkeypatch.setattr(layer.time, "sleep", tries.append)
    monkeypatch.setattr(layer.urllib.request, "urlopen", lambda *a, **k: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(OSError):
        layer.fetch_json("http://127.0.0.1:1/x", {})
    assert tries == [1, 2, 4, 8]


def test_snapshot_directories(spark, tmp_path):
    assert snapshots.latest_snapshot(spark, tmp_path) is None and snapshots.latest_snapshot(spark, tmp_path / "none") is None
    for name, n in (("2026-09-01", 3), ("2026-10-01", 5), ("2026-10-01", 6)):
        snapshots.write_snapshot(spark.range(n), tmp_path, name, {"rows": n})
    (tmp_path / "2026-11-01").mkdir()
    df, manifest = snapshots.read_snapshot(spark, snapshots.latest_snapshot(spark, tmp_path))
    assert df.count() == manifest["rows"] == 6


def test_streaming_counts_repeats_once(spark, tmp_path, rows):
    kind = "event_id long, ts timestamp, event_type string"
    data = [(1, datetime(2026, 1, 1, 5), "a"), (1, datetime(2026, 1, 1, 5), "a"), (2, datetime(2026, 1, 1, 6), "b"), (3, datetime(2026, 1, 9), "a"), (4, datetime(2026, 1, 20), "a")]
    spark.createDataFrame(data, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = daily_reports(spark.readStream.schema(kind).parquet(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("append").format("memory").queryName("daily").trigger(availableNow=True).start()
    query.processAllAvailable()
    query.awaitTermination(60)
    assert rows(spark.table("daily").where("day <= '2026-01-05'")) == [(date(2026, 1, 1), "a", 1), (date(2026, 1, 1), "b", 1)]


@pytest.mark.parametrize("odd, charset, read", [(b"Caf\xe9 \x93", "cp1252", "Café “"), (b"Caf\xe9 \x81", "latin-1", "Café \x81"), ("Café".encode(), "utf-8-sig", "Café")])
def test_agency_csv_settles_the_encoding_over_the_whole_file(spark, tmp_path, odd, charset, read):
    plain = b"Case Number,City,Offense\n" + b"".join(b"%07d,DUNMERE,THEFT\n" % i for i in range(52_000))
    assert len(plain) > 1 << 20
    (tmp_path / "x.csv").write_bytes(plain + b"9999999," + odd + b",THEFT\n")
    df, log = agency_csv.read_agency_csv(spark, str(tmp_path / "x.csv"), "PINECREST")
    assert log.encoding == charset and df.count() == 52_001
    assert df.where(F.array_contains(F.array(*[F.col(c).cast("string") for c in df.columns]), read)).count() == 1
