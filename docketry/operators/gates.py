"""Verdicts on a whole batch: one row (gate, status, detail) each, and whether the batch may be published.

``status`` is PASS, FAIL, WARN, REVIEWED or SKIP; only FAIL stops a batch. Gates are small frames computed from figures
the other operators give; their union is a frame too, so the rows of the batch never leave the executors.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators import contract as contracts
from docketry.operators import restatement, timeliness

GATE = "gate string, status string, detail string"
STAMP = "date_reported"


def _verdict(df: DataFrame, gate: str, status: Column, *detail: Column | str) -> DataFrame:
    parts = [F.lit(d) if isinstance(d, str) else d.cast("string") for d in detail]
    return df.select(F.lit(gate).alias("gate"), status.alias("status"), F.concat(*parts).alias("detail"))


def _ok(condition: Column, otherwise: str) -> Column:
    return F.when(condition, "PASS").otherwise(otherwise)


def error_rate(df: DataFrame, exceptions: DataFrame, limit: float = 0.0) -> DataFrame:
    """FAIL where more than ``limit`` of the rows are quarantined; repeated and keyless rows count as one key each."""
    rate = contracts.error_rate(df, exceptions)
    return _verdict(rate, "error_rate", _ok(F.col("rate") <= limit, "FAIL"), F.col("quarantined"), " of ", F.col("rows"), f" rows quarantined; budget {limit:.2%}")


def required_columns(exceptions: DataFrame) -> DataFrame:
    """FAIL where a required column is missing, else no row."""
    missing = exceptions.where(F.col("rule") == "missing_column").agg(F.array_sort(F.collect_set("column")).alias("c")).where(F.size("c") > 0)
    return _verdict(missing, "required_columns", F.lit("FAIL"), F.array_join("c", ", "))


def reconciled_count(spark: SparkSession, manifest: Mapping) -> DataFrame:
    ok = manifest["server_count"] == manifest["rows_fetched"]
    return spark.createDataFrame([("reconciled_count", "PASS" if ok else "FAIL", f"{manifest['rows_fetched']} rows came of {manifest['server_count']} the server counts")], GATE)


def freshness(df: DataFrame, fetched_at: Column, max_days: int = 10, stamp: str = STAMP) -> DataFrame:
    """FAIL where the newest row is more than ``max_days`` whole days older than the pull, or no row has a date."""
    age = timeliness.freshness(df, stamp, fetched_at, max_days)
    shown = F.coalesce(F.date_format("newest", "yyyy-MM-dd"), F.lit("none"))
    return _verdict(age, "freshness", _ok(F.coalesce(F.col("fresh"), F.lit(False)), "FAIL"), "newest row: ", shown, "; age in days: ", F.coalesce(F.col("days").cast("string"), F.lit("unknown")))


def fingerprint(spark: SparkSession, expected: str | None, found: str) -> DataFrame:
    """WARN where the headers changed; no row where none are expected."""
    rows = [("schema_fingerprint", "PASS" if expected == found else "WARN", f"headers were {expected}, are {found}")] if expected else []
    return spark.createDataFrame(rows, GATE)


def volume(df: DataFrame, as_of: date, settle_days: int = 30, trailing: int = 12, limit: float = 3.5, reviewed: Mapping[str, str] | None = None, stamp: str = STAMP) -> DataFrame:
    """One row per settled month of unusual volume, REVIEWED where a note stands for it (yyyy-MM), else WARN; one PASS without any."""
    monthly = timeliness.monthly_volume(df, stamp)
    flagged = timeliness.volume_anomalies(monthly.where(timeliness.settled(F.col("month"), as_of, settle_days)), trailing, limit).where("flag")
    notes = df.sparkSession.createDataFrame(list((reviewed or {}).items()), "m string, note string")  # a short file written by people
    noted = flagged.withColumn("m", F.date_format("month", "yyyy-MM")).join(F.broadcast(notes), "m", "left")
    rate = lambda c: F.format_number(c, 1)
    found = _verdict(
        noted, "volume_anomaly", F.when(F.col("note").isNotNull(), "REVIEWED").otherwise("WARN"),
        F.col("m"), ": ", rate("per_day"), "/day vs trailing median ", rate("trailing_median"), " (robust z ", F.format_number("robust_z", 2), "). ", F.coalesce("note", F.lit("Needs review.")),
    )
    none = flagged.agg(F.count("*").alias("n")).where("n = 0")
    return found.unionByName(_verdict(none, "volume_anomaly", F.lit("PASS"), f"every settled month within robust z {limit:g} of the trailing {trailing}"))


def daily_gaps(df: DataFrame, min_per_day: int = 1, shown: int = 10, stamp: str = STAMP) -> DataFrame:
    """FAIL where a day between the first and the last has fewer than ``min_per_day`` rows; the first few are named."""
    gaps = timeliness.daily_gaps(df, stamp, min_per_day).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.date_format("day", "yyyy-MM-dd"))).alias("days"))
    return _verdict(gaps, "daily_gaps", _ok(F.col("n") == 0, "FAIL"), F.col("n"), f" days with fewer than {min_per_day} reports", F.when(F.col("n") > 0, F.concat(F.lit(": "), F.array_join(F.slice("days", 1, shown), ", "))).otherwise(""))


def restatements(spark: SparkSession, diff: restatement.SnapshotDiff | None, since: str = "") -> DataFrame:
    """WARN where earlier months changed, SKIP where there is no earlier snapshot to compare with."""
    if diff is None:
        return spark.createDataFrame([("restatements", "SKIP", "no earlier accepted snapshot to compare with")], GATE)
    n = restatement.headline(diff)
    return _verdict(n, "restatements", _ok(F.col("restated") == 0, "WARN"), f"vs {since or 'the snapshot before'}: +", F.col("added"), " / -", F.col("removed"), " records, ", F.col("changed"), " changed, ", F.col("restated"), " month-group counts moved")


def file_deadline(files: DataFrame, due_day: int = 15) -> DataFrame:
    """WARN for each file (file_id, period, received) that came after its day of the following month."""
    d = files.select("file_id", "period", timeliness.deadline(F.col("period"), F.col("received"), due_day).alias("d"))
    return _verdict(d, "file_deadline", _ok(F.col("d.status") != "LATE", "WARN"), F.col("file_id"), ": period ", F.col("period"), " due ", F.col("d.due"), F.when(F.col("d.days_late") > 0, F.concat(F.lit(", days late: "), F.col("d.days_late"))).otherwise(""))


def period_coverage(rows: DataFrame, file: str = "file_id", period: str = "period", stamp: str = STAMP) -> DataFrame:
    """WARN for each file with rows dated outside its period (yyyy-MM); rows without date are outside."""
    inside = F.coalesce(F.date_format(stamp, "yyyy-MM") == F.col(period), F.lit(False))
    n = rows.groupBy(file, period).agg(F.count_if(~inside).alias("n"))
    return _verdict(n, "period_coverage", _ok(F.col("n") == 0, "WARN"), F.col(file), ": ", F.col("n"), " rows are not of ", F.col(period))


def passed(gates: DataFrame) -> DataFrame:
    """One row: whether no gate failed; a batch without gates passes."""
    return gates.agg((F.count_if(F.col("status") == "FAIL") == 0).alias("passed"))


def audit(df: DataFrame, contract: Mapping, as_of: date, manifest: Mapping | None = None, diff: restatement.SnapshotDiff | None = None, reviewed: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(exceptions, gates) of a batch under its contract; gates on the pull need its ``manifest``.

    ``batch_gates``, ``deadlines`` and ``volume`` of the contract set the limits.
    """
    spark = df.sparkSession
    limits, days, volumes = contract.get("batch_gates", {}), contract.get("deadlines", {}), contract.get("volume", {})
    exceptions = contracts.validate(df, contract, as_of)
    gates = [error_rate(df, exceptions, limits.get("max_error_rate", 0.0)), required_columns(exceptions)]
    if manifest:
        if limits.get("require_reconciled_count"):
            gates.append(reconciled_count(spark, manifest))
        if STAMP in df.columns:
            gates.append(freshness(df, F.lit(str(manifest["fetched_at"])).cast("timestamp"), limits.get("max_staleness_days", 10)))
        gates.append(fingerprint(spark, limits.get("expected_fingerprint"), manifest.get("schema_fingerprint", "")))
    if STAMP in df.columns:
        gates.append(volume(df, as_of, days.get("month_settle_days", 30), volumes.get("trailing_months", 12), volumes.get("robust_z_warn", 3.5), reviewed))
        gates.append(daily_gaps(df))
    gates.append(restatements(spark, diff))
    out = gates[0]
    for gate in gates[1:]:
        out = out.unionByName(gate)
    return exceptions, out


def report(snapshot: str, as_of: date, exceptions: DataFrame, gates: DataFrame, rows_checked: int, diff: restatement.SnapshotDiff | None = None, methods: DataFrame | None = None) -> str:
    """The audit as JSON: snapshot, as_of, passed, gates, exceptions by rule, diff figures, rows by resolution method.

    Only figures come to the driver: a row for each gate, rule and method.
    """
    rows = lambda frame: [r.asDict() for r in frame.collect()]
    verdicts = rows(gates)
    summary = contracts.ordered_summary(contracts.summary(exceptions, rows_checked))
    out = {
        "snapshot": snapshot, "as_of": str(as_of), "passed": all(g["status"] != "FAIL" for g in verdicts), "gates": verdicts, "exceptions": rows(summary),
        "diff": restatement.headline(diff).first().asDict() if diff else None, "jurisdiction_methods": {r["method"]: r["rows"] for r in rows(methods)} if methods is not None else {},
    }
    return json.dumps(out, indent=2, default=str)


def annotations(gates: DataFrame) -> list[str]:
    """A line for each gate, and a workflow command for each that fails or warns."""
    out = []
    for g in gates.orderBy("gate", "detail").collect():  # few rows
        out.append(f"[{g['status']:8}] {g['gate']:20} {g['detail']}")
        if g["status"] in ("FAIL", "WARN"):
            shown = g["detail"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
            out.append(f"::{'error' if g['status'] == 'FAIL' else 'warning'} title=Gate {g['status']}%3A {g['gate']}::{shown}")
    return out
