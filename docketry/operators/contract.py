"""Declarative row contracts: every check of a row in one projection, exceptions by ``inline``.

A contract is a mapping ``key, columns {name: {type, required, regex, regex_severity, min, max, min_severity,
range_severity, not_future}}, row_rules [{name, severity}]``; limits of the whole batch are read by ``gates``. ERROR
quarantines the row's key, WARN logs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEY = "<null>"

#: rule name -> (columns it needs, condition that is true for an offending row)
ROW_RULES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "occurred_after_reported": (("date_occurred", "date_reported"), lambda: F.col("date_occurred") > F.col("date_reported")),
    "cleared_before_reported": (("clearance_date", "date_reported"), lambda: F.to_date("clearance_date") < F.to_date("date_reported")),
    "id_date_mismatch": (("incident_id", "date_reported"), lambda: _id_date().isNotNull() & ~_id_date().eqNullSafe(F.to_date("date_reported"))),
    "not_local_midnight": (("date_reported",), lambda: F.col("date_reported") != F.date_trunc("DAY", F.col("date_reported"))),
    "jurisdiction_unresolved": (("jurisdiction", "city"), lambda: F.col("jurisdiction").isNull() & F.col("city").isNotNull()),
}


def _id_date() -> Column:
    return F.to_date(F.try_to_timestamp(F.substring(F.col("incident_id"), 1, 8), F.lit("yyyyMMdd")))


def register_rule(name: str, needs: tuple[str, ...], condition: Callable[[], Column]) -> None:
    """Add a row rule under a name contracts can use."""
    ROW_RULES[name] = (needs, condition)


def load_contract(path: str | Path) -> dict:
    """A YAML contract, or notes of a review, as plain mappings; an empty file is an empty mapping."""
    import yaml

    return yaml.safe_load(Path(path).read_text()) or {}


def _shown(column: str) -> Column:
    return F.col(column).cast("string")


def _checks(contract: Mapping, columns: list[str], today: date) -> list[tuple[str, str, str, Column]]:
    out = []
    for name, rule in contract.get("columns", {}).items():
        if name not in columns:
            continue
        c = F.col(name)
        if rule.get("required"):
            out.append(("required_null", "ERROR", name, c.isNull()))
        if "regex" in rule:
            out.append(("format", rule.get("regex_severity", "ERROR"), name, c.isNotNull() & ~c.cast("string").rlike(rf"\A(?:{rule['regex']})\z")))
        if rule.get("type") == "date":
            stamp = c.cast("timestamp_ntz")
            if rule.get("not_future"):
                out.append(("future_date", "ERROR", name, stamp > F.lit(today).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")))
            if "min" in rule:
                out.append(("implausibly_old", rule.get("min_severity", "ERROR"), name, stamp < F.lit(str(rule["min"])).cast("timestamp_ntz")))
        elif "min" in rule or "max" in rule:
            number = F.expr(f"try_cast(`{name}` AS double)")
            bad = F.lit(False)
            if "min" in rule:
                bad = bad | (number < float(rule["min"]))
            if "max" in rule:
                bad = bad | (number > float(rule["max"]))
            out.append(("out_of_range", rule.get("range_severity", "ERROR"), name, number.isNotNull() & ~F.isnan(number) & bad))
    return out


def _with_copies(df: DataFrame, key: str) -> DataFrame:
    """Add ``_copied``: whether the key is not null and met more than once.

    Keys are counted with partial aggregation and only the repeated ones are joined back, so a key that is null or
    repeated in a third of all rows meets no window and the rows are shuffled by no key of their own.
    """
    repeated = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1").select("_key", F.lit(True).alias("_copied"))
    return df.join(repeated, F.col(key) == F.col("_key"), "left").drop("_key").withColumn("_copied", F.coalesce("_copied", F.lit(False)))


def validate(df: DataFrame, contract: Mapping, today: date) -> DataFrame:
    """(record_key, rule, severity, column, value) of every violation, all strings.

    Absent required columns give one ``missing_column`` row with key ``*``; rules whose columns are absent are skipped.
    Rows without key are shown as ``<null>``. All copies of a repeated key are ``duplicate_key``; null keys are not.
    """
    key = contract["key"]
    checks = _checks(contract, df.columns, today)
    for rule in contract.get("row_rules", []):
        needs, condition = ROW_RULES[rule["name"]]
        if all(c in df.columns for c in needs):
            checks.append((rule["name"], rule.get("severity", "WARN"), needs[0], condition()))
    counted = df
    if key in df.columns:
        counted = _with_copies(df, key)
        checks.append(("duplicate_key", "ERROR", key, F.col("_copied")))
    shown_key = F.coalesce(_shown(key), F.lit(NULL_KEY)) if key in df.columns else F.lit(NULL_KEY)
    entries = [
        F.when(F.coalesce(bad, F.lit(False)), F.struct(shown_key.alias("record_key"), F.lit(name).alias("rule"), F.lit(severity).alias("severity"), F.lit(column).alias("column"), _shown(column).alias("value")))
        for name, severity, column, bad in checks
    ]
    missing = [n for n, r in contract.get("columns", {}).items() if r.get("required") and n not in df.columns]
    kind = "record_key string, rule string, severity string, `column` string, value string"
    found = df.sparkSession.createDataFrame([("*", "missing_column", "ERROR", n, None) for n in missing], kind)
    if entries:
        found = counted.select(F.inline(F.filter(F.array(*entries), lambda x: x.isNotNull()))).unionByName(found)
    return found


def summary(exceptions: DataFrame, rows_checked: int) -> DataFrame:
    """(rule, severity, rows, pct) with the share of the rows checked in percent."""
    return exceptions.groupBy("rule", "severity").agg(F.count("*").alias("rows")).withColumn("pct", 100.0 * F.col("rows") / max(rows_checked, 1))


def ordered_summary(summary: DataFrame) -> DataFrame:
    """The summary with errors first, the most frequent rule first, and shares of three places."""
    return summary.withColumn("pct", F.round("pct", 3)).orderBy("severity", F.col("rows").desc(), "rule")


def quarantined_keys(exceptions: DataFrame) -> DataFrame:
    """Distinct keys with an ERROR, without ``*``."""
    return exceptions.where((F.col("severity") == "ERROR") & (F.col("record_key") != "*")).select("record_key").distinct()


def clean_rows(df: DataFrame, exceptions: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not quarantined."""
    shown = df.withColumn("_shown", F.coalesce(F.col(key).cast("string"), F.lit(NULL_KEY)))
    return shown.join(quarantined_keys(exceptions).withColumnRenamed("record_key", "_shown"), "_shown", "left_anti").drop("_shown")


def error_rate(df: DataFrame, exceptions: DataFrame) -> DataFrame:
    """One row: rows checked, distinct quarantined keys and their ratio."""
    bad = quarantined_keys(exceptions).agg(F.count("*").alias("quarantined"))
    return df.agg(F.count("*").alias("rows")).crossJoin(bad).withColumn("rate", F.col("quarantined") / F.greatest(F.col("rows"), F.lit(1)))  # two rows of one
