"""Headerless delimited files read as strings, plain or bz2.

Every field is read as STRING with an explicit schema (no inference pass);
typing happens afterwards with safe casts (operators.clean). Hadoop's bz2
codec is splittable, so a ``.csv.bz2`` file is read in parallel directly and
needs no decompressed copy on local disk."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.clean import in_range, parsed_fields
from quillspark.sources.layout import Layout, laid_out

# The public taxi-trip layout, in file order (17 fields).
TAXI_FIELDS = (
    "medallion",
    "hack_license",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_time_in_secs",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "payment_type",
    "fare_amount",
    "surcharge",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)


def read_csv_strings(spark: SparkSession, path: str, names=TAXI_FIELDS,
                     sep: str = ",", limit: int | None = None, layout: Layout = None) -> DataFrame:
    """One STRING column per field; short rows get nulls, which the safe
    casts then drop. ``limit`` (a positive int) keeps only that many rows;
    ``layout`` deals the rows out anew (sources.layout)."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = (
        spark.read.schema(schema)
        .option("header", "false")
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    if isinstance(limit, int) and not isinstance(limit, bool) and limit > 0:
        df = df.limit(limit)
    return laid_out(df, layout)


# ------------------------------------------------------------------- rejects

RAGGED, UNPARSABLE, OUT_OF_RANGE = "ragged", "unparsable", "out_of_range"
CAUSES = (RAGGED, UNPARSABLE, OUT_OF_RANGE)


def checked_records(lines: DataFrame, names: Sequence[str], keep: Mapping[str, str], ranges: Mapping[str, tuple[float, float]],
                    sep: str = ",", line_col: str = "value", passthrough: Sequence[str] = ()) -> DataFrame:
    """Every line with what became of it: ``(*passthrough, line, cause, *keep)``.

    ``cause`` is null for a record to keep. A line with too few or too many
    fields, an empty and a null one are ``ragged`` (Spark's parser hands such a
    line over in its corrupt-record column); a kept or tested field that is no
    plain number is ``unparsable``; a tested one outside its inclusive range is
    ``out_of_range``. The first cause in this order counts. Fields of ``keep``
    (output name -> field) are doubles, null where they don't parse."""
    fields = ", ".join(f"`{n}` string" for n in names) + ", `__corrupt` string"
    record = F.from_csv(line_col, fields, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    rows = lines.select(*passthrough, F.col(line_col).alias("line"), record.alias("r")).select(*passthrough, "line", "r.*")
    numbers = parsed_fields(keep, ranges)
    rows = rows.select(*passthrough, "line", F.col("__corrupt"), *[c.alias(f"__{n}") for n, c in numbers.items()])
    ragged = F.col("__corrupt").isNotNull() | F.col("line").isNull() | (F.col("line") == "")
    bad, outside = F.lit(False), F.lit(False)
    for n in numbers:
        bad = bad | F.col(f"__{n}").isNull()
    for n, (lo, hi) in ranges.items():
        outside = outside | ~in_range(F.col(f"__{n}"), lo, hi)
    cause = F.when(ragged, RAGGED).when(bad, UNPARSABLE).when(outside, OUT_OF_RANGE)
    return rows.select(*passthrough, "line", cause.alias("cause"), *[F.col(f"__{n}").alias(n) for n in keep])


def observe_causes(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted as they pass: ``lines``, ``kept`` and one count
    for each cause, there once an action has run over the frame."""
    seen = Observation()
    counts = [F.count_if(F.col("cause") == c).alias(c) for c in CAUSES]
    return checked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("cause").isNull()).alias("kept"), *counts), seen


def split_records(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Writes all records once, the kept ones and the rejects in partitions of
    their own, and returns both with the counts of that pass. Rejects have
    their line and its cause."""
    counted, seen = observe_causes(checked)
    counted.withColumn("rejected", F.col("cause").isNotNull()).write.partitionBy("rejected").parquet(path)
    both = checked.sparkSession.read.schema(counted.schema.add("rejected", "boolean")).parquet(path)
    inside = [c for c in checked.columns if c not in ("line", "cause")]
    numbers = [f.name for f in checked.schema.fields if f.name in inside and f.dataType.typeName() == "double"]
    kept = both.where("NOT rejected").select(*inside)
    rejects = both.where("rejected").select(*[c for c in inside if c not in numbers], "line", "cause")
    return kept, rejects, dict(seen.get)
