"""Line-marked documents: one ``<doc id="..." ...>body</doc>`` per line.

Parsing is regexp_extract with DOTALL, so it stays in the JVM. A line that does
not match is filtered out (``line_counts`` counts them) instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.layout import Layout, laid_out

# The document markers and the class-1 id prefix.
ID_PATTERN = r'(?s)<doc id="(.*?)"'
BODY_SHORTEST = r'(?s)">(.*?)</doc>'
BODY_GREEDY = r'(?s)<doc id.*?">(.*)</doc>'
CLASS_ONE_MARK = '<doc id="AU'


def read_lines(spark: SparkSession, path: str, layout: Layout = None) -> DataFrame:
    """One row per line, column ``value``, dealt out as ``layout`` says."""
    return laid_out(spark.read.text(path), layout)


def parse_id_text(lines: DataFrame, line_col: str = "value", keep=()) -> DataFrame:
    """``(id STRING, text STRING)``: first id, shortest body."""
    value = F.col(line_col)
    return lines.where(value.rlike(ID_PATTERN) & value.rlike(BODY_SHORTEST)).select(
        *keep,
        F.regexp_extract(value, ID_PATTERN, 1).alias("id"),
        F.regexp_extract(value, BODY_SHORTEST, 1).alias("text"),
    )


def class_from_marker(value: Column) -> Column:
    return F.when(value.contains(CLASS_ONE_MARK), F.lit(1.0)).otherwise(F.lit(0.0))


def parse_labelled(lines: DataFrame, line_col: str = "value",
                   with_id: bool = True, keep=()) -> DataFrame:
    """``(doc_id STRING, text STRING, label DOUBLE)``: the id that the line
    names, greedy body (to the last ``</doc>``), label 1.0 when the id starts
    with ``AU``."""
    value = F.col(line_col)
    named = [F.regexp_extract(value, ID_PATTERN, 1).alias("doc_id")] if with_id else []
    return lines.where(value.rlike(BODY_GREEDY)).select(
        *named, *keep,
        F.regexp_extract(value, BODY_GREEDY, 1).alias("text"),
        class_from_marker(value).alias("label"),
    )


def line_counts(lines: DataFrame, pattern: str = BODY_GREEDY, line_col: str = "value") -> DataFrame:
    """One row: lines, those that parse, those that don't (one pass)."""
    hit = F.coalesce(F.col(line_col).rlike(pattern), F.lit(False))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(hit).alias("parsed"), F.count_if(~hit).alias("unmatched"))


def observe_lines(lines: DataFrame, pattern: str = BODY_GREEDY, line_col: str = "value") -> tuple[DataFrame, Observation]:
    """The lines, counted as a parser reads them: ``lines``, ``parsed`` and
    ``unmatched`` are there once an action has run over what it made of them."""
    seen, hit = Observation(), F.coalesce(F.col(line_col).rlike(pattern), F.lit(False))
    return lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(hit).alias("parsed"), F.count_if(~hit).alias("unmatched")), seen


def load_corpus(spark: SparkSession, train_path: str, test_path: str | None = None,
                test_fraction_mod: int = 10, layout: Layout = None):
    """Labelled training and test frames, the lines dealt out as ``layout`` says.

    Two paths: both files are parsed the same way. One path: a stable split by
    the line's own id (``pmod(xxhash64(doc_id), 10) = 0`` is test), the same
    however the file is cut into partitions."""
    from quillspark.operators.profile import stable_split

    train = parse_labelled(read_lines(spark, train_path, layout))
    if test_path is not None:
        return train, parse_labelled(read_lines(spark, test_path, layout))
    return stable_split(train, "doc_id", test_fraction_mod)
