"""Settled monthly series and their year-over-year change."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions.text import offense_group
from docketry.operators.timeliness import settled

GROUPS = ["property", "violent"]


def without_unfounded(df: DataFrame) -> DataFrame:
    if "clearance_status" not in df.columns:
        return df
    return df.where(F.upper(F.coalesce("clearance_status", F.lit(""))) != "UNFOUNDED")


def monthly_counts(df: DataFrame, as_of: date, settle_days: int = 30, exclude_unfounded: bool = True) -> DataFrame:
    """(month, property, violent, settled) of the months the data cover to their end.

    The last covered day is that of all rows, unfounded ones included. Months without either group have no row.
    """
    kept = without_unfounded(df) if exclude_unfounded else df
    grouped = kept.select(F.trunc(F.to_date("date_reported"), "MM").alias("month"), offense_group(F.col("offense_code")).alias("g")).where(F.col("g").isin(GROUPS) & F.col("month").isNotNull())
    counts = grouped.groupBy("month").agg(*[F.count_if(F.col("g") == g).alias(g) for g in GROUPS])
    through = df.agg(F.to_date(F.max("date_reported")).alias("through"))
    return counts.crossJoin(F.broadcast(through)).where(F.last_day("month") <= F.col("through")).select("month", *GROUPS, settled(F.col("month"), as_of, settle_days).alias("settled"))  # through is one row


def from_month(monthly: DataFrame, first: date) -> DataFrame:
    """The series from a month on, in order."""
    return monthly.where(F.col("month") >= F.lit(first)).orderBy("month")


def trailing_12_change(monthly: DataFrame, column: str) -> DataFrame:
    """One row (last_12, prior_12, pct_change, windows) over the last 24 settled months; none where there are fewer."""
    ranked = monthly.where("settled").withColumn("k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("month").desc())))
    recent, prior = F.col("k") <= 12, F.col("k").between(13, 24)
    sums = ranked.agg(
        F.count("*").alias("months"),
        F.sum(F.when(recent, F.col(column))).alias("last_12"),
        F.sum(F.when(prior, F.col(column))).alias("prior_12"),
        F.min(F.when(recent, F.col("month"))).alias("window_from"),
        F.max(F.when(recent, F.col("month"))).alias("window_to"),
    )
    change = 100.0 * (F.col("last_12") - F.col("prior_12")) / F.nullif(F.col("prior_12"), F.lit(0))
    return sums.where(F.col("months") >= 24).select("last_12", "prior_12", change.alias("pct_change"), "window_from", "window_to")


def unfounded_share(df: DataFrame) -> DataFrame:
    """One row: violent and property records, unfounded ones among them, and their share in percent."""
    rows = df.where(offense_group(F.col("offense_code")).isin(GROUPS))
    bad = F.count_if(F.upper(F.coalesce("clearance_status", F.lit(""))) == "UNFOUNDED")
    return rows.agg(F.count("*").alias("n"), bad.alias("unfounded")).withColumn("pct", 100.0 * F.col("unfounded") / F.greatest(F.col("n"), F.lit(1)))
