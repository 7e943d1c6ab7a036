"""Difference between an accepted snapshot and a newer one, and what it restates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import offense_group

TRACKED = ("date_reported", "offense_code", "clearance_status")


@dataclass
class SnapshotDiff:
    added: DataFrame
    removed: DataFrame
    changed: DataFrame
    restatements: DataFrame


def _fold(df: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """One row per key: the least of its copies, so the choice does not depend on partitions."""
    rest = [c for c in dict.fromkeys(["date_reported", "offense_code", *tracked]) if c in df.columns and c != key]
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def diff_snapshots(old: DataFrame, new: DataFrame, key: str = "incident_id", tracked: Sequence[str] = TRACKED, overlap_from=None) -> SnapshotDiff:
    """Late additions, removals, changed fields (null-safe) and restated monthly counts.

    Rows without date are left out on both sides; new rows beyond the old snapshot's last date are no late additions.
    Repeated keys count once, with the least of their rows.
    """
    start = F.lit(True) if overlap_from is None else F.col("date_reported") >= F.lit(overlap_from)
    before = _fold(old.where(F.col("date_reported").isNotNull() & start), key, tracked)
    horizon = F.broadcast(old.agg(F.max("date_reported").alias("_horizon")))  # one row
    after = _fold(new.where(F.col("date_reported").isNotNull() & start), key, tracked).crossJoin(horizon).where(F.col("date_reported") <= F.col("_horizon")).drop("_horizon")
    shared = [c for c in tracked if c in before.columns and c in after.columns]
    both = before.select(F.col(key), *[F.col(c).alias(f"o_{c}") for c in shared]).join(after.select(F.col(key), *[F.col(c).alias(f"n_{c}") for c in shared]), key)
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"o_{c}").cast("string").alias("old"), F.col(f"n_{c}").cast("string").alias("new")) for c in shared])
    changed = both.select(key, F.inline(cells)).where(~F.col("old").eqNullSafe(F.col("new")))
    count = lambda df, name: df.select(F.trunc(F.to_date("date_reported"), "MM").alias("month"), offense_group(F.col("offense_code")).alias("group")).groupBy("month", "group").agg(F.count("*").alias(name))
    joined = count(before, "old").join(count(after, "new"), ["month", "group"], "full").fillna(0, ["old", "new"])
    restated = joined.withColumn("delta", F.col("new") - F.col("old")).withColumn("pct", 100.0 * F.col("delta") / F.nullif(F.col("old"), F.lit(0)))
    return SnapshotDiff(after.join(before, key, "left_anti").select(key), before.join(after, key, "left_anti").select(key), changed, restated)


def headline(diff: SnapshotDiff, key: str = "incident_id") -> DataFrame:
    """One row of counts: added, removed, records changed, months restated."""
    n = lambda df, c, name: df.agg(c.alias(name))
    parts = [n(diff.added, F.count("*"), "added"), n(diff.removed, F.count("*"), "removed"), n(diff.changed, F.count_distinct(key), "changed"), n(diff.restatements, F.count_if(F.col("delta") != 0), "restated")]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # single rows
    return out
