"""Secrets in texts, with multipart credential linking. [native]

Strong parts stand alone: assigned values, access identifiers and long hex
runs. Weak ones (a short assigned value, a short access identifier, a bare
40-character key) are common in clean text, so they are reported only where a
complementary part lies in their scope: an interval join of weak parts with
the parts that complete them, both ends at most ``SCOPE`` code points apart.

The join never lists pairs. With a document's parts in the order of their
starts, a weak part has a partner in scope before it if the largest end so far
reaches its scope, and one after it if the smallest later start does; both are
running windows.

Defined results. Null text counts as empty: no spans. Every input row gives
one result row, repeated rows too; an empty table gives none. Extra columns
are ignored. Positions are code points, end exclusive. Of parts with equal
start, the kind listed first comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import documents

SCOPE = 200
#: Names by number; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "weak_assign", "weak_access", "key40")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH, WEAK_ASSIGN_LENGTH = 12, 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH, WEAK_ACCESS_LENGTH = 18, 12
HEX = r"[0-9a-f]{16,}"
KEY40 = r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?i:https?|wss?|ftp|jdbc|s3|redis|amqp|mongodb|mysql|postgres(?:ql)?)://[^\s\"'<>]+"
ENDPOINT_KIND = len(KINDS)


def occurrences(text: Column, kind: int, pattern: str, where: Column, core: int = 0) -> Column:
    """Array of ``(kind, i, gap, len, core)``: the i-th leftmost match, the code
    points between it and the match before, its own and those of a group.
    Matching runs only on texts that pass the cheap test ``where``."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(core))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    rows = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
            F.length(x["whole"]).alias("len"), F.length(x["part"]).alias("core")))
    return F.when(where, rows).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,core:int>>"))


def parts(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, _row, kind, start, end)``; a text without any gives one
    row of kind null. Texts are read once and stay where they are; only these
    narrow rows move."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(
        occurrences(text, 0, ASSIGN, text.rlike(ASSIGN), 2),
        occurrences(text, 1, ACCESS, text.contains("AKIA")),
        occurrences(text, 2, HEX, text.rlike(HEX)),
        occurrences(text, 5, KEY40, text.rlike(KEY40)),
        occurrences(text, ENDPOINT_KIND, ENDPOINT, text.contains("://")))
    # The row's own number comes first: beside explode() each exploded row would get one.
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    rows = rows.select("doc_id", "_row", F.explode_outer(found).alias("p"))
    rows = rows.select("doc_id", "_row", "p.*").repartition("doc_id", "_row")
    so_far = Window.partitionBy("doc_id", "_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
    kind = (F.when((F.col("kind") == 0) & (F.col("core") < ASSIGN_LENGTH), F.when(F.col("core") >= WEAK_ASSIGN_LENGTH, 3).otherwise(-1))
            .when((F.col("kind") == 1) & (F.col("len") < ACCESS_LENGTH), F.when(F.col("len") >= WEAK_ACCESS_LENGTH, 4).otherwise(-1))
            .otherwise(F.col("kind")))
    return rows.select("doc_id", "_row", kind.alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end")


def linked(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Adds ``reported``: base kinds are, weak ones if a complementary part is
    in scope. A weak secret needs an access identifier or an endpoint; a weak
    identifier needs a secret."""
    kind = F.col("kind")
    by_start = Window.partitionBy("doc_id", "_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    from_end = Window.partitionBy("doc_id", "_row").orderBy(F.col("start").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    weak_secret, weak_id = kind.isin(3, 5), kind == 4
    completes_secret = kind.isin(1, 4, ENDPOINT_KIND)
    completes_id = kind.isin(0, 2, 3, 5)

    def near(partner: Column) -> Column:
        before = F.max(F.when(partner, F.col("end"))).over(by_start) >= F.col("start") - scope
        after = F.min(F.when(partner, F.col("start"))).over(from_end) <= F.col("end") + scope
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    both = rows.withColumn("_s", near(completes_secret)).withColumn("_i", near(completes_id))
    reported = kind.isin(0, 1, 2) | (weak_secret & F.col("_s")) | (weak_id & F.col("_i"))
    return both.withColumn("reported", F.coalesce(reported, F.lit(False))).drop("_s", "_i")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``spans``, an array of
    ``(start, kind, end)`` in order, kind being a number into ``KINDS``."""
    span = F.struct("start", "kind", "end")
    return linked(parts(docs), scope).groupBy("doc_id", "_row").agg(
        F.sort_array(F.collect_list(F.when(F.col("reported"), span))).alias("spans")).drop("_row")


def op6_link_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))

    def written(spans: Column) -> Column:
        name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), (x["kind"] + 1).cast("int"))
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",")

    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
