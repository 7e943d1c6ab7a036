"""Session construction and table access shared by every operator."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "docketry", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC clock and adaptive execution; ``master`` and partitions only override what the caller names."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one Parquet table of a data directory."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
