"""Order-min-hash fingerprints of whole texts. [native]

A text is cut into words (long ones into pieces of ``PIECE`` code points). Its
k-mers are runs of ``K`` pieces, the first padded on the left, each numbered by
its occurrence: the third time a k-mer appears it is another element than the
first time. The ``KEEP`` elements of least hash are selected, put back into
text order, and each run of ``TUPLE`` neighbours in that order is hashed. The
set of these hashes is the fingerprint: unlike a set of k-mers it changes when
parts change places. Two fingerprints' likeness is the Jaccard share of it.

Everything happens inside the row that holds the text, on arrays of longs
that pack a hash and a position, so no k-mer is ever shuffled.

Defined results. Null text counts as empty. A text without words has the empty
fingerprint; two such are alike (1.0), one such and another text are not
(0.0). One k-mer alone makes one tuple. Rows of equal id and text share their
successor: the next row of larger (id, text hash). Every input row gives one
result row; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, cut, documents

PIECE = 8
K = 2
KEEP = 64
TUPLE = 2
#: A long holds 39 bits of a hash above 24 bits of a position (16 million pieces).
POSITION_BITS = 24
HASH_MASK = (1 << 39) - 1


def _shifted(values: Column, by: int, fill: Column) -> Column:
    """An array moved right by some places, ``fill`` before it, of equal size."""
    return F.slice(F.concat(F.array_repeat(fill, by), values), F.lit(1), F.size(values))


def _packed(hashed: Column, position: Column) -> Column:
    return F.coalesce(F.shiftleft(hashed.bitwiseAND(F.lit(HASH_MASK)), POSITION_BITS).bitwiseOR(position.cast("long")), F.lit(0).cast("long"))


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, POSITION_BITS)


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, keep: int = KEEP) -> DataFrame:
    """Adds ``out``, an array of ints. Each step is a projection of its own: an
    array that later steps read more than once is computed once."""
    long = F.lit(0).cast("long")
    df = df.withColumn("_pieces", F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,%d}" % PIECE), F.lit(0)))
    runs = reduce(lambda a, by: F.zip_with(a, _shifted(F.col("_pieces"), by, F.lit("")), lambda x, y: F.concat_ws(" ", y, x)), range(1, k), F.col("_pieces"))
    # k-mers in the order of their hash, equal ones in text order
    df = df.withColumn("_kmers", F.sort_array(F.transform(runs, lambda x, i: _packed(F.xxhash64(x, F.lit(SEED)), i))))
    # places where another k-mer begins, the lengths of the runs, the number within the run
    begins = F.array_compact(F.transform(
        F.arrays_zip(F.col("_kmers").alias("a"), _shifted(F.col("_kmers"), 1, F.lit(-1).cast("long")).alias("b")),
        lambda x, i: F.when(_hash_of(x["a"]) != _hash_of(x["b"]), i)))
    df = df.withColumn("_begins", begins)
    ends = F.concat(F.slice("_begins", F.lit(2), F.greatest(F.size("_begins"), F.lit(1))), F.array(F.size("_kmers")))
    lengths = F.zip_with("_begins", F.slice(ends, F.lit(1), F.size("_begins")), lambda a, b: b - a)
    df = df.withColumn("_number", F.flatten(F.transform(lengths, lambda n: F.sequence(F.lit(0), n - 1))))
    least = F.slice(F.sort_array(F.zip_with(
        "_kmers", "_number",
        lambda x, n: _packed(F.xxhash64(_hash_of(x), n), x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))))), 1, keep)
    # back into text order
    df = df.withColumn("_order", F.sort_array(F.transform(
        least, lambda x: F.struct(x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("at"), _hash_of(x).alias("hash")))))
    df = df.withColumn("_order", F.transform("_order", lambda x: x["hash"]))
    neighbours = [F.slice(F.slice("_order", F.lit(1 + j), F.greatest(F.size("_order"), F.lit(1))), F.lit(1), F.greatest(F.size("_order") - (TUPLE - 1), F.lit(1))) for j in range(TUPLE)]
    tuples = F.transform(F.arrays_zip(*[n.alias(f"t{j}") for j, n in enumerate(neighbours)]),
                         lambda x: F.shiftright(F.xxhash64(*[F.coalesce(x[f"t{j}"], long) for j in range(TUPLE)]), 32).cast("int"))
    signature = F.sort_array(F.array_distinct(tuples))
    signature = F.when(F.size("_order") > 0, signature).otherwise(F.array().cast("array<int>"))
    return df.withColumn(out, signature).drop("_pieces", "_kmers", "_begins", "_number", "_order")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard share of two fingerprints; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both)).cast("double")


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def successors(keys: DataFrame) -> DataFrame:
    """``keys(k, th, ...)`` with the next distinct key in ascending order,
    ``next_k`` and ``next_th``; after the last comes the first. The keys are
    dealt out by range; each range finds its own successors, and the first of
    the next range, one row a range, completes the last of each."""
    ranged = cut(keys.distinct().repartitionByRange("k", "th").withColumn("range", F.spark_partition_id()))
    inside = ranged.withColumn("next", F.lead(F.struct("k", "th")).over(Window.partitionBy("range").orderBy("k", "th")))
    firsts = ranged.groupBy("range").agg(F.min(F.struct("k", "th")).alias("first"))
    everything = Window.partitionBy(F.lit(0)).orderBy("range")
    around = F.min("first").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select(F.col("range").alias("_range"), F.coalesce(F.lead("first").over(everything), around).alias("after"))
    # as many rows as there are ranges
    found = inside.join(F.broadcast(firsts), F.col("range") == F.col("_range"))
    following = F.coalesce("next", "after")
    return found.select(*keys.columns, following["k"].alias("next_k"), following["th"].alias("next_th"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp)``: for each
    text its fingerprint, its edited text's and its successor's. The edited
    text has its last quarter replaced by the successor's start.

    Texts are shuffled once: both joins read the same columns by the same key,
    so Spark makes that exchange once. Fingerprints are made after it and
    written; successors' are joined from there."""
    text = F.coalesce("text", F.lit(""))
    # a key without nulls, equal for rows of equal id and text
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.xxhash64(text, F.lit(SEED)).alias("th"), text.alias("text"))
    following = successors(keyed.select("doc_id", "k", "th", F.length("text").cast("long").alias("n_chars")))
    texts = keyed.select("k", "th", "text")
    source = texts.select(F.col("k").alias("_k"), F.col("th").alias("_th"), "text")
    tails = following.join(source, (F.col("next_k") == F.col("_k")) & (F.col("next_th") == F.col("_th")))
    tails = tails.withColumn("tail", F.expr("substring(text, 1, cast(n_chars div 4 as int))"))
    kept = ["doc_id", "n_chars", "next_k", "next_th", "tail"]
    tails = tails.groupBy("k", "th").agg(*[F.first(c).alias(c) for c in kept])      # once for repeated successors
    both = texts.join(tails, ["k", "th"])
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - n_chars div 4 as int))"), F.col("tail"))
    both = with_fingerprint(both.withColumn("edited", edited), "text", "fp")
    both = with_fingerprint(both, "edited", "edited_fp")
    done = cut(both.select("k", "th", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "edited_fp", "next_k", "next_th"))
    others = done.select(F.col("k").alias("_k"), F.col("th").alias("_th"), F.col("fp").alias("next_fp")).dropDuplicates(["_k", "_th"])
    return done.join(others, (F.col("next_k") == F.col("_k")) & (F.col("next_th") == F.col("_th"))).select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def op7_order_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
