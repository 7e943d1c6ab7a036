"""Settled months, file deadlines, day gaps, freshness and robust volume anomalies."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def settled(month: Column, as_of: date, settle_days: int = 30) -> Column:
    """Whether the month ended at least ``settle_days`` before ``as_of``."""
    return F.datediff(F.lit(as_of), F.last_day(month)) >= settle_days


def deadline(period: Column, received: Column, due_day: int = 15) -> Column:
    """Struct of ``due`` (that day of the month after the yyyy-MM period), ``status`` ON_TIME or LATE, and ``days_late``."""
    following = F.add_months(F.to_date(F.concat(period, F.lit("-01"))), 1)
    due = F.date_add(following, due_day - 1)
    late = F.greatest(F.datediff(F.to_date(received), due), F.lit(0))
    return F.struct(due.alias("due"), F.when(late > 0, "LATE").otherwise("ON_TIME").alias("status"), late.alias("days_late"))


def monthly_volume(df: DataFrame, stamp: str) -> DataFrame:
    """(month, n) of all rows with a date."""
    return df.where(F.col(stamp).isNotNull()).groupBy(F.trunc(F.to_date(stamp), "MM").alias("month")).agg(F.count("*").alias("n"))


def _median(values: Column) -> Column:
    s, n = F.array_sort(values), F.size(values)
    return (F.get(s, ((n - 1) / 2).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2


def volume_anomalies(monthly: DataFrame, trailing: int = 12, limit: float = 3.5) -> DataFrame:
    """Robust z of each month's daily rate against the ``trailing`` months before it, by row position.

    The median absolute deviation counts as 1 where it is 0. The first ``trailing`` months have no z. The window runs
    over months, of which there are few whatever the number of rows.
    """
    rated = monthly.withColumn("per_day", F.col("n") / F.day(F.last_day("month")))
    order = Window.partitionBy(F.lit(0)).orderBy("month")
    before = rated.withColumns({"_past": F.collect_list("per_day").over(order.rowsBetween(-trailing, -1)), "_k": F.row_number().over(order)}).where(F.col("_k") > trailing)
    spread = before.withColumn("trailing_median", _median(F.col("_past"))).withColumn("_mad", _median(F.transform("_past", lambda x: F.abs(x - F.col("trailing_median")))))
    z = 0.6745 * (F.col("per_day") - F.col("trailing_median")) / F.when(F.col("_mad") == 0, 1.0).otherwise(F.col("_mad"))
    return spread.withColumn("robust_z", z).withColumn("flag", F.abs("robust_z") > limit).drop("_past", "_k", "_mad")


def daily_gaps(df: DataFrame, stamp: str, min_per_day: int = 1) -> DataFrame:
    """(day, n) of the days between first and last date that have fewer than ``min_per_day`` rows."""
    days = df.where(F.col(stamp).isNotNull()).groupBy(F.to_date(stamp).alias("day")).agg(F.count("*").alias("n"))
    spine = days.agg(F.min("day").alias("a"), F.max("day").alias("b")).where(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("day"))
    return spine.join(days, "day", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < min_per_day)


def freshness(df: DataFrame, stamp: str, fetched_at: Column, max_days: int = 10) -> DataFrame:
    """One row: newest date, whole days to ``fetched_at`` and whether that is fresh enough."""
    newest = df.agg(F.max(stamp).alias("newest"))
    age = F.floor((F.unix_seconds(fetched_at.cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))) / 86400)
    return newest.withColumn("days", age.cast("long")).withColumn("fresh", F.col("days") <= max_days)
