"""The parquet tables of a test-data folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillspark.session import kept_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Keep a frame as a table of ``buckets`` files by the hash of ``key``, each
    sorted by it (the session's number of shuffle partitions, if not given).
    Tables that are kept so with one number of buckets are joined or grouped by
    the key file by file: the rows were dealt out when they were written."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"kept_{uuid.uuid4().hex}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", kept_folder(spark, "bucketed")).saveAsTable(name)
    return spark.table(name)
