"""Queries of the readers of files and printed tables, over whole tables written out as such texts, with reference SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.lineage import ensure_checkpoint_dir
from docketry.session import table
from docketry.sources import agency_csv, cells, snapshots


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order date written in one of the accepted formats, or as no date, and read again."""
    stamp = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 13 HOURS")
    forms = [*agency_csv.DATE_FORMATS, "'on 'yyyy"]
    texts = F.element_at(F.array(*[F.date_format(stamp, f) for f in forms]), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    read = table(spark, sf_dir, "orders").select("o_orderkey", texts.alias("text")).withColumn("stamp", agency_csv.parse_date(F.col("text")))
    return read.select("o_orderkey", F.date_format("stamp", "yyyy-MM-dd HH").alias("read"))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A printed table of offences for each snapshot: header, a row each with its count and a note sign, and a total."""
    counts = table(spark, sf_dir, "incident_snapshots").groupBy(F.col("snapshot").alias("path"), F.coalesce("offense_code", F.lit("")).alias("code")).agg(F.count("*").alias("n"))
    shown = F.format_number("n", 0)
    rows = counts.select("path", F.row_number().over(Window.partitionBy("path").orderBy("code")).alias("row"), F.array("code", F.concat(F.lit("Offence "), "code"), F.lit("—"), F.concat(shown, F.when(F.col("n") % 2 == 0, "*").otherwise(""))).alias("cells"))
    total = counts.groupBy("path").agg(F.sum("n").alias("n")).select("path", F.lit(1_000_000).alias("row"), F.array(F.lit("Total"), F.lit(""), F.lit(""), shown).alias("cells"))
    header = counts.select("path").distinct().select("path", F.lit(0).alias("row"), F.array(*map(F.lit, ("NIBRS Code", "Offense  Category:", "Prior Year", "This Month"))).alias("cells"))
    return header.unionByName(rows).unionByName(total).select("path", (F.col("row") / 25).cast("int").alias("page"), F.lit(0).alias("table"), "row", "cells")


def cell_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.read_cells(_grid(spark, sf_dir)).select("path", "kind", "offense_code", "count", "prior_year_count")


def cell_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.reconcile(cells.read_cells(_grid(spark, sf_dir)))


def document_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agency and period read from a first page written for each agency file."""
    month = F.to_date(F.concat("period", F.lit("-01")))
    period = F.when(F.month(month) % 2 == 0, F.date_format(month, "MMM. yyyy")).otherwise(F.date_format(month, "M/yyyy"))
    pages = table(spark, sf_dir, "agency_files").select("file_id", F.concat(F.lit("Monthly summary\nReporting Agency:  "), "agency", F.lit("\nReporting Period: "), period, F.lit("\n")).alias("text")).distinct()
    return pages.select("file_id", cells.document_head(F.col("text")).alias("h")).select("file_id", "h.agency", "h.period")


def _folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the session's shared checkpoint folder, for texts that a query writes and reads again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites, a table of fixed size, as one agency's export with preamble, quoted cells, blank lines and footer, read again."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    sites = table(spark, sf_dir, "sites")
    body = sites.select((F.col("site_id") + 10).alias("n"), F.concat_ws(";", F.concat(F.lit(" "), F.col("site_id").cast("string")), quoted(F.concat(F.lit(" "), F.col("site_name"), F.lit("; "), F.col("site_kind"))), F.lit("2/28/2026"), F.col("lat").cast("string"), F.col("lon").cast("string")).alias("line"))
    frame = [(1, "Harbour office"), (2, "Export"), (3, ""), (4, "Report ID;Description;Date of Report;Latitude;Longitude"), (5, ""), (1 << 60, "Grand Total;420"), ((1 << 60) + 1, "Page 1")]
    path = _folder(spark, "csv")
    body.unionByName(spark.createDataFrame(frame, "n long, line string")).coalesce(1).sortWithinPartitions("n").select("line").write.text(path)
    rows, log = agency_csv.read_agency_csv(spark, path, "HARBOUR")
    return rows.select("incident_id", "offense_desc", F.date_format("date_reported", "yyyy-MM-dd").alias("reported"), "lat", "lon", "agency", F.lit(log.header_row).alias("header_row"), F.lit(log.footer_rows_dropped).cast("long").alias("dropped"))


def accepted_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident snapshots accepted in turn, each with its manifest; the newest is found and read again."""
    root, rows = _folder(spark, "accepted"), table(spark, sf_dir, "incident_snapshots")
    passed = spark.createDataFrame([("error_rate", "PASS", "")], "gate string, status string, detail string")
    for name in sorted(r[0] for r in rows.select("snapshot").distinct().collect()):  # a handful of deliveries
        snapshots.accept(rows.where(F.col("snapshot") == name), passed, root, {"fetched_at": name}, name=name)
    read, manifest = snapshots.read_snapshot(spark, snapshots.latest_snapshot(spark, root))
    return read.withColumn("fetched_at", F.lit(manifest["fetched_at"]))


QUERIES = {f.__name__: f for f in (parse_dates, cell_tables, cell_warnings, document_heads, csv_export, accepted_snapshot)}

_COUNTS = "SELECT snapshot AS path, coalesce(offense_code, '') AS code, count(*) AS n FROM incident_snapshots GROUP BY 1, 2"
ORACLES = {
    "parse_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 9 IN (3, 4, 5) THEN strftime(o_orderdate::DATE, '%Y-%m-%d') || ' 13' WHEN o_orderkey % 9 < 8 THEN strftime(o_orderdate::DATE, '%Y-%m-%d') || ' 00' END AS read FROM orders",
    "cell_tables": f"""SELECT path, 'data' AS kind, nullif(trim(code), '') AS offense_code, n::INTEGER AS count, 0::INTEGER AS prior_year_count FROM ({_COUNTS})
        UNION ALL SELECT path, 'total', 'Total', sum(n)::INTEGER, 0 FROM ({_COUNTS}) GROUP BY 1""",
    "cell_warnings": f"SELECT path, 'jump: ' || coalesce(nullif(trim(code), ''), trim('Offence ' || code)) AS warning FROM ({_COUNTS}) WHERE n >= 20",
    "csv_export": """SELECT site_id::VARCHAR AS incident_id, trim(site_name || '; ' || site_kind) AS offense_desc, '2026-02-28' AS reported, lat::VARCHAR AS lat, lon::VARCHAR AS lon, 'HARBOUR' AS agency, 3::INTEGER AS header_row, 3::BIGINT AS dropped FROM sites""",
    "accepted_snapshot": "SELECT incident_id, date_reported, offense_code, clearance_status, snapshot AS fetched_at FROM incident_snapshots WHERE snapshot = (SELECT max(snapshot) FROM incident_snapshots)",
    "document_heads": "SELECT DISTINCT file_id, agency, period FROM agency_files",
}
