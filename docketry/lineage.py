"""Cutting lineage in storage that outlives an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame


def ensure_checkpoint_dir(spark) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session without one (tests) gets a directory of its own.

    On a cluster a machine's own directory would lose the data with the machine, so there the setting is required.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        named = tempfile.mkdtemp(prefix="docketry-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is read from shared storage, so losing executors costs no recomputation.

    ``build_session`` lets Spark delete the files once nothing refers to them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
