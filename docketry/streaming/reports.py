"""The batch rules as a stream: repeated reports dropped and days counted behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_reports(events: DataFrame, stamp: str = "ts", key: str = "event_id", kind: str = "event_type", settle: str = "1 day") -> DataFrame:
    """(day, kind, n) of distinct reports; a day is final once the watermark, ``settle`` behind the newest, has passed it."""
    fresh = events.withWatermark(stamp, settle).dropDuplicatesWithinWatermark([key])
    return fresh.groupBy(F.window(stamp, "1 day"), kind).agg(F.count("*").alias("n")).select(F.to_date("window.start").alias("day"), kind, "n")
