"""The monthly run: newest snapshot, jurisdictions, audit, comparison with the accepted one, report, publication.

    python -m docketry run ROOT --contract C.yaml --gazetteer PLACES.parquet
    python -m docketry audit-file FILE --contract C.yaml --received 2026-09-18 [--period 2026-08]
    python -m docketry cells GRID.parquet
    python -m docketry er-eval [--n 1200]

Exit status 1 where a gate fails, 2 where a printed table has rows that cannot be read.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.lineage import cut
from docketry.operators import contract as contracts
from docketry.operators import evaluation, gates, jurisdiction, monthly, restatement
from docketry.publish.page import render
from docketry.session import build_session
from docketry.sources import agency_csv, cells, people, snapshots


def run(spark: SparkSession, root: str, contract: Mapping, gazetteer: DataFrame, reviewed: Mapping[str, str] | None = None, chart_from: date = date(2000, 1, 1), title: str = "Incidents", **region) -> tuple[bool, str]:
    """(passed, audit report) of the newest snapshot below ``root``/raw; outputs go below ``root``/output.

    The day the snapshot was fetched is the day of reckoning, so a later run over it gives the same. Rows with errors
    are left out of what is published, and nothing is published or accepted where a gate fails.
    """
    newest = snapshots.latest_snapshot(spark, f"{root}/raw")
    if newest is None:
        raise FileNotFoundError(f"no snapshot below {root}/raw")
    mapped, manifest, _ = snapshots.load_mapped(spark, newest)
    as_of = date.fromisoformat(str(manifest["fetched_at"])[:10])
    rows, crosswalk = jurisdiction.resolve_column(mapped, gazetteer, **region) if "city" in mapped.columns else (mapped, None)
    accepted = snapshots.latest_snapshot(spark, f"{root}/accepted")
    diff = None
    if accepted is not None:
        before, told = snapshots.read_snapshot(spark, accepted)
        if told.get("fetched_at") != manifest["fetched_at"]:
            diff = restatement.diff_snapshots(before, rows)
    exceptions, verdicts = gates.audit(rows, contract, as_of, manifest, diff, reviewed)
    exceptions, verdicts = cut(exceptions), cut(verdicts)
    methods = crosswalk.groupBy("method").agg(F.sum("rows").alias("rows")) if crosswalk is not None else None
    report = gates.report(newest.rsplit("/", 1)[-1], as_of, exceptions, verdicts, rows.count(), diff, methods)
    out = f"{root}/output"
    snapshots.write_text(spark, report, f"{out}/audit_report.json")
    snapshots.write_csv(exceptions, f"{out}/exceptions")
    if crosswalk is not None:
        snapshots.write_csv(crosswalk, f"{out}/jurisdiction_crosswalk")
    if diff is not None:
        snapshots.write_csv(diff.changed, f"{out}/diff_changed_fields")
        snapshots.write_csv(diff.restatements, f"{out}/diff_restatements")
    passed = json.loads(report)["passed"]
    if passed:
        clean = contracts.clean_rows(rows, exceptions, contract["key"])
        series = cut(monthly.from_month(monthly.monthly_counts(clean, as_of, contract.get("deadlines", {}).get("month_settle_days", 30)), chart_from))
        snapshots.write_csv(series, f"{out}/monthly_counts")
        share = monthly.unfounded_share(clean).first()
        note = f"As of {as_of}. Unfounded reports, {share['unfounded']:,} ({share['pct']:.1f} %), are left out. Hollow points are preliminary."
        changes = {g: monthly.trailing_12_change(series, g) for g in monthly.GROUPS}
        snapshots.write_text(spark, render(title, series, changes, verdicts, contracts.ordered_summary(contracts.summary(exceptions, rows.count())), note), f"{out}/index.html")
        snapshots.accept(rows, verdicts, f"{root}/accepted", manifest, contract["key"])
    return passed, report


def audit_file(spark: SparkSession, path: str, contract: Mapping, received: date, period: str | None = None) -> tuple[DataFrame, DataFrame, agency_csv.ParseLog]:
    """(exceptions, gates, parse log) of one agency export; with a ``period`` its deadline and coverage are judged too."""
    rows, log = agency_csv.read_agency_csv(spark, path)
    exceptions, _ = gates.audit(rows, contract, received)
    limits = contract.get("batch_gates", {})
    verdicts = gates.error_rate(rows, exceptions, limits.get("max_error_rate", 0.0)).unionByName(gates.required_columns(exceptions))
    if period:
        name = path.rsplit("/", 1)[-1]
        filed = spark.createDataFrame([(name, period, received)], "file_id string, period string, received date")
        verdicts = verdicts.unionByName(gates.file_deadline(filed, contract.get("deadlines", {}).get("file_due_day_of_following_month", 15)))
        verdicts = verdicts.unionByName(gates.period_coverage(rows.withColumns({"file_id": F.lit(name), "period": F.lit(period)})))
    return exceptions, verdicts, log


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="docketry")
    commands = top.add_subparsers(dest="command", required=True)
    c = commands.add_parser("run")
    c.add_argument("root")
    c.add_argument("--contract", required=True)
    c.add_argument("--gazetteer", required=True)
    c.add_argument("--reviewed")
    c = commands.add_parser("audit-file")
    c.add_argument("path")
    c.add_argument("--contract", required=True)
    c.add_argument("--received", required=True, type=date.fromisoformat)
    c.add_argument("--period")
    c.add_argument("--out")
    c = commands.add_parser("cells")
    c.add_argument("path")
    c.add_argument("--out")
    c = commands.add_parser("er-eval")
    c.add_argument("--n", type=int, default=1200)
    c.add_argument("--out")
    args = top.parse_args(argv)
    spark = build_session()
    if args.command == "run":
        notes = contracts.load_contract(args.reviewed).get("volume_anomaly", {}) if args.reviewed else None
        passed, report = run(spark, args.root, contracts.load_contract(args.contract), spark.read.parquet(args.gazetteer), notes)
        print(report)
        return 0 if passed else 1
    if args.command == "audit-file":
        exceptions, verdicts, log = audit_file(spark, args.path, contracts.load_contract(args.contract), args.received, args.period)
        print(log, *gates.annotations(verdicts), sep="\n")
        if args.out:
            snapshots.write_csv(exceptions, args.out)
        return 0 if gates.passed(verdicts).first()["passed"] else 1
    if args.command == "cells":
        read = cut(cells.read_cells(spark.read.parquet(args.path)))
        cells.reconcile(read).show(100, False)
        if args.out:
            snapshots.write_csv(read.where("kind = 'data'"), args.out)
        return 2 if not read.where("kind = 'exception'").isEmpty() else 0
    dev = evaluation.evaluate(*people.labelled_sources(spark, args.n, seed=7))
    said = evaluation.summary(dev, evaluation.evaluate(*people.labelled_sources(spark, args.n, seed=2026), fixed_threshold=dev.threshold))
    print(said)
    if args.out:
        snapshots.write_text(spark, said, args.out)
    return 0
