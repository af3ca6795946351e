"""Reading tables, cutting lineage and bounding Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.tables import read_table

SEED = 42
#: Spark's switch for removing a query's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a scratch
    folder only where that is unset (local tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: later
    steps (and retries after a lost executor) start from the files, a plan read
    twice is computed once, and Spark knows the sizes when it picks joins.
    The files stay for as long as the result may be read; the shared folder's
    owner clears ``llm-cut-*``. What the write shuffled goes as it ends, as no
    later plan reads it; else it stays until the driver collects its garbage,
    which is no sooner the more there is."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-cut-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, mb: int = 16) -> None:
    """Bound Arrow batches by bytes, so that a batch of very long texts stays
    small in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def seeded(seed: int, *cols: Column | str) -> Column:
    """A 64-bit hash of columns that differs by seed and agrees between reruns."""
    return F.xxhash64(F.lit(seed), *cols)
