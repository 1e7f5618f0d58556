"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "regiocast", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution, skew splitting and UTC time."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # call-site capture costs several round trips per Column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("REGIOCAST_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root for checkpoints and tables that must outlive an executor.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset (tests, laptops)
    is a local folder chosen, and it is kept for the rest of the session. A session on a cluster
    without the setting is refused: its executors would write to folders of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("regiocast.scratch.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to shared storage (master {master})")
        root = tempfile.mkdtemp(prefix="regiocast-")
        spark.conf.set("regiocast.scratch.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared root; never reused, so nothing needs clearing."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint in the shared folder (survives the loss of executors)."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession):
    """Frames made inside lose their shuffle files as soon as an action on them ends.

    For jobs of many steps that each write a checkpoint: Spark otherwise keeps the files of every
    step until the driver happens to collect its garbage. A frame that is run again after that
    shuffles again, so what is handed on should be made outside.
    """
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int):
    """Actions inside hand rows to Python workers in Arrow batches of about ``size`` bytes.

    For rows of megabytes: a batch is held outside the heap, twice while it grows, and again in
    the worker. Only what runs inside counts, so what is handed on should be written or
    checkpointed there.
    """
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)
