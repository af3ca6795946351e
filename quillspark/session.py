"""Session helpers: building a local session for tests and benches, finding the
shared checkpoint folder, and pinning frames that several passes read."""

from __future__ import annotations

import logging
import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "quillspark") -> SparkSession:
    """A session for tests and benches. On a cluster the caller builds its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # bound Arrow batches by bytes too: a batch of long documents stays small
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        # lookups of some hundred ids or words skip pages by each of them, not by their range
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # remove checkpoint files once the pinned frame is garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QS_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; only where none is set (local
    tests) create a scratch one, and say so."""
    current = checkpoint_dir(spark)
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    scratch = tempfile.mkdtemp(prefix="qs-ckpt-")
    logging.getLogger(__name__).warning(
        "spark.checkpoint.dir is not set; %s is used, which other machines don't see", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir()


def kept_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint folder, for tables that
    outlive the plan that writes them. Whoever owns that folder clears it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write a frame that several passes read to the checkpoint folder (lineage
    cut, so a lost executor re-reads files instead of re-running it)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """``pin`` a frame that a driver loop scans many times, and keep it in
    memory and on disk for the following passes."""
    return pin(df).persist(StorageLevel.MEMORY_AND_DISK)
