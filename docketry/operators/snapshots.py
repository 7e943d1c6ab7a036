"""What changed between full snapshots, from signed key-field-value cells.

Each snapshot row becomes one cell per tracked field plus a presence marker. Every distinct cell remembers the set of
snapshots that hold it; entering a snapshot is +1, leaving one is -1, and cells whose signs cancel never leave the first
aggregation. Nonzero cells then say which keys came, went or changed, and in which field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: field name of the marker that says only that the key is there
PRESENCE = ""


def normal_value(column):
    """Blank and null are the same value; letter case and surrounding white space are no difference."""
    return F.upper(F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), r"^\s+|\s+$", ""))


def signed_cells(snapshots: DataFrame, key: str, snapshot: str, fields: Sequence[str]) -> DataFrame:
    """(snapshot, key, field, value, sign): +1 where a cell is new in a snapshot, -1 where it is gone from it."""
    order = snapshots.select(F.col(snapshot).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    names = order.agg(F.array_sort(F.collect_set("_s")).alias("_names"))
    marks = [F.struct(F.lit(PRESENCE).alias("field"), F.lit("").alias("value"))]
    marks += [F.struct(F.lit(f).alias("field"), normal_value(F.col(f)).alias("value")) for f in fields]
    cells = (
        snapshots.where(F.col(snapshot).isNotNull() & F.col(key).isNotNull())
        .select(F.col(snapshot).alias("_s"), F.col(key).alias("_k"), F.explode(F.array(*marks)).alias("c"))
        .groupBy("_k", "c.field", "c.value")
        .agg(F.collect_set("_s").alias("_in"))
        .crossJoin(F.broadcast(names))  # one row: the list of snapshots
    )
    steps = F.filter(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("_names") - 1, F.lit(1))),
            lambda i: F.struct(
                F.get("_names", i).alias("snapshot"),
                (F.array_contains("_in", F.get("_names", i)).cast("int") - F.array_contains("_in", F.get("_names", i - 1)).cast("int")).alias("sign"),
            ),
        ),
        lambda x: x["sign"] != 0,
    )
    moved = F.when((F.size("_in") < F.size("_names")) & (F.size("_names") > 1), steps)
    return cells.select("_k", "field", "value", F.explode(moved).alias("x")).select(F.col("x.snapshot").alias("snapshot"), F.col("_k").alias("key"), "field", "value", F.col("x.sign").alias("sign"))


def snapshot_changes(snapshots: DataFrame, key: str = "incident_id", snapshot: str = "snapshot", fields: Sequence[str] = ("offense_code", "clearance_status")) -> DataFrame:
    """(snapshot, key, change, field) between consecutive snapshots, ``snapshot`` being the later one.

    ``added`` and ``removed`` have an empty ``field``; ``changed`` has one row per field. Rows without key or snapshot
    belong to no record and are left out. Rows repeated within a snapshot count once; where copies differ, the set of
    values is compared. One snapshot, or none, has no changes.
    """
    cells = signed_cells(snapshots, key, snapshot, fields)
    moved = cells.groupBy("snapshot", "key").agg(
        F.sum(F.when(F.col("field") == PRESENCE, F.col("sign")).otherwise(0)).alias("presence"),
        F.collect_set(F.when(F.col("field") != PRESENCE, F.col("field"))).alias("fields"),
    )
    changes = F.when(F.col("presence") > 0, F.array(F.struct(F.lit("added").alias("change"), F.lit("").alias("field"))))
    changes = changes.when(F.col("presence") < 0, F.array(F.struct(F.lit("removed").alias("change"), F.lit("").alias("field"))))
    changes = changes.otherwise(F.transform("fields", lambda f: F.struct(F.lit("changed").alias("change"), f.alias("field"))))
    return moved.select("snapshot", F.col("key").alias(key), F.explode(changes).alias("c")).select("snapshot", key, "c.change", "c.field")
