"""Session construction and lineage control.

Cluster settings live here so every job runs with the same plan-shaping
configuration: AQE on (runtime coalescing of shuffle partitions, skew-join
splitting, broadcast conversion from measured sizes), UTC session time, Arrow
for the few pandas boundaries.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings that shape plans at 100 TB scale. The shuffle partition count is an
# upper bound that AQE coalesces down to ``advisoryPartitionSizeInBytes``.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Only on a cluster: the width of shuffles before AQE coalesces them. At 100 TB the
# default of 200 would put hundreds of GB into a partition.
WIDTH_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_spark(master: str | None = None, app: str = "kiln", **extra: str) -> SparkSession:
    """Return the active session, or build one with the kiln settings.

    ``master`` is only given in tests and the bench (``local[N]``); on a
    cluster the launcher supplies it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**CLUSTER_CONF, **(LOCAL_CONF if master else WIDTH_CONF), **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster to a shared file
    system). Only when it is unset and the master is local -- tests -- a private
    folder is made; on a cluster an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="kiln-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Truncate the plan of ``df`` with a reliable checkpoint.

    The data is written to the shared checkpoint folder, so the result
    survives the loss of any executor (unlike a local checkpoint or cache).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), "tables", name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    For an input of several aggregates: it is evaluated once, later scans read
    only the columns they need, and the table survives the loss of executors.
    """
    return staged_with(df, name, {})[0]


def staged_with(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``staged``, and the aggregates ``metrics`` gathered while the rows are written."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    seen = Observation()
    out = df.observe(seen, *[c.alias(k) for k, c in metrics.items()]) if metrics else df
    out.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get) if metrics else {}


def reloaded(spark: SparkSession, model):
    """A fitted Spark ML classifier without its training summary: written to the shared folder and read back.

    A binary classifier's summary holds the session, which tasks cannot be sent once
    the session has observed any query (``staged_with``): the fitted model could not score.
    """
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    model.write().session(spark).save(path)
    return type(model).load(path)
