"""Snapshot directories: Parquet rows with a JSON manifest, newest by name, swapped in whole.

Paths are read and written through Spark's own file systems, so a root may lie wherever the cluster stores data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators.restatement import TRACKED
from docketry.schema import HeaderPlan, map_columns

ROWS, MANIFEST = "rows.parquet", "manifest.json"


class _Folder:
    """A directory of one of Spark's file systems."""

    def __init__(self, spark: SparkSession, root):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.root = str(root).rstrip("/")
        self.files = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.files.listStatus(self.path())] if self.files.exists(self.path()) else []

    def has(self, *parts: str) -> bool:
        return self.files.exists(self.path(*parts))

    def drop(self, *parts: str) -> None:
        self.files.delete(self.path(*parts), True)

    def move(self, old: str, new: str) -> None:
        if not self.files.rename(self.path(old), self.path(new)):
            raise OSError(f"could not move {old} to {new} in {self.root}")

    def write(self, text: str, *parts: str) -> None:
        out = self.files.create(self.path(*parts), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, *parts: str) -> str:
        given = self.files.open(self.path(*parts))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(given)).decode()
        finally:
            given.close()


def write_snapshot(df: DataFrame, root, name: str, manifest: Mapping) -> str:
    """Write rows and manifest beside the target, then swap; a reader never meets a half-written snapshot."""
    folder, fresh = _Folder(df.sparkSession, root), f".{name}.new"
    folder.drop(fresh)
    df.write.option("compression", "zstd").parquet(f"{folder.root}/{fresh}/{ROWS}")
    folder.write(json.dumps(manifest, indent=1), fresh, MANIFEST)
    folder.drop(name)
    folder.move(fresh, name)
    return f"{folder.root}/{name}"


def settle_snapshot(spark: SparkSession, root, hidden: str, name: str, manifest: Mapping) -> None:
    """Give a snapshot written under a hidden name its manifest and its own name."""
    folder = _Folder(spark, root)
    folder.write(json.dumps(manifest, indent=1), hidden, MANIFEST)
    folder.drop(name)
    folder.move(hidden, name)


def latest_snapshot(spark: SparkSession, root) -> str | None:
    """The last directory by name that has a manifest."""
    folder = _Folder(spark, root)
    named = [n for n in folder.names() if not n.startswith(".") and folder.has(n, MANIFEST)]
    return f"{folder.root}/{max(named)}" if named else None


def read_snapshot(spark: SparkSession, path) -> tuple[DataFrame, dict]:
    folder = _Folder(spark, path)
    return spark.read.parquet(f"{folder.root}/{ROWS}"), json.loads(folder.read(MANIFEST))


def load_mapped(spark: SparkSession, path) -> tuple[DataFrame, dict, HeaderPlan]:
    """A snapshot in canonical columns; headers that leave a required column open or name one twice stop the run."""
    rows, manifest = read_snapshot(spark, path)
    mapped, plan = map_columns(rows)
    if not plan.usable():
        raise ValueError(f"headers of {path} cannot be mapped: absent {list(plan.absent)}, repeated {plan.of('repeated')}")
    return mapped, manifest, plan


def accept(df: DataFrame, gates: DataFrame, root, manifest: Mapping, key: str = "incident_id", tracked: Sequence[str] = TRACKED, name: str = "accepted") -> bool:
    """Keep a batch as the accepted snapshot, its key and tracked columns only, if no gate failed; whether it was kept."""
    if not gates.where(F.col("status") == "FAIL").isEmpty():
        return False
    write_snapshot(df.select(key, *[c for c in tracked if c in df.columns and c != key]), root, name, manifest)
    return True


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One text file, replaced if it is there."""
    root, _, name = str(path).rpartition("/")
    _Folder(spark, root).write(text, name)


def write_csv(df: DataFrame, path) -> None:
    """One directory of CSV parts with a header; order rows before where it matters."""
    df.write.mode("overwrite").option("header", True).csv(str(path))
