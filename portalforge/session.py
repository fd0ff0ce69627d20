"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "portalforge",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """SparkSession with the settings every job here assumes.

    AQE re-plans joins from runtime sizes (a shuffled side that turns out
    small becomes a broadcast) and splits skewed shuffle partitions, so a
    hypermutated sample or a hot gene does not pin one task.  Master and
    partition count are the caller's or the submit command's; code sets none.
    The UI stays off: nothing here serves a port.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if os.environ.get("SPARK_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", os.environ["SPARK_DRIVER_MEMORY"])
    return (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    try:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
    except Exception:  # no JVM-side context (e.g. a Connect session): use the conf only
        pass
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or None


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor and the driver can reach: under
    ``spark.checkpoint.dir``, or under this machine's temporary folder where
    the session runs on this machine alone."""
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="portalforge-")
    return f"{base.rstrip('/')}/portalforge/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "model") -> DataFrame:
    """Keep a model that several jobs read (sample registry, sheets, file
    manifest) so it is computed once.

    With a shared ``spark.checkpoint.dir`` the model is written there as a
    parquet table (a fresh folder per call) and read back: lineage is cut, a
    lost executor re-reads the table instead of re-running the warehouse
    joins, and the planner sees the model's real size when it chooses
    broadcast joins downstream.  Without a shared folder the model is
    persisted (memory, spilling to disk) and a lost block is recomputed from
    its lineage -- a machine-local folder would not survive the loss of that
    machine.  The models are sized by specimens and files, not by result
    rows.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if base is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{base.rstrip('/')}/portalforge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
