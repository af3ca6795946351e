"""Class profiles, stable train/test split, class counts and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.text import FORCED_WORDS, Vocabulary, term_freq


def stable_split(df: DataFrame, id_col: str = "doc_id", mod: int = 10):
    """(train, test): ``pmod(id, mod) = 0`` is test (10 % for mod 10).

    Depends only on the id, not on partitioning or task order, so a re-run
    after a lost executor gives the same split. Non-integer ids are hashed."""
    key = F.col(id_col)
    if dict(df.dtypes)[id_col] not in ("bigint", "int", "smallint", "tinyint"):
        key = F.xxhash64(key)
    is_test = F.pmod(key, F.lit(mod)) == 0
    return df.where(~is_test), df.where(is_test)


def split_flag(df: DataFrame, id_col: str = "doc_id", mod: int = 10) -> DataFrame:
    key = F.col(id_col)
    if dict(df.dtypes)[id_col] not in ("bigint", "int", "smallint", "tinyint"):
        key = F.xxhash64(key)
    return df.withColumn("is_test", F.pmod(key, F.lit(mod)) == 0)


def label_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, n)``: rows per class (partial counts per task, one row per
    class per task shuffled)."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def class_shares(df: DataFrame, label_col: str = "label",
                 classes: Sequence[float] = (1.0, 0.0)) -> dict[float, float]:
    """Share of the rows that each class has, from one count per class. Raises
    if one of ``classes`` has no row (the weighted loss divides by the share)."""
    counts = {float(r[label_col]): r["n"] for r in label_counts(df, label_col).collect()
              if r[label_col] is not None}                             # one row per class
    missing = [c for c in classes if c not in counts]
    if missing:
        raise ValueError(f"class(es) {missing} have no rows; class weights undefined")
    return {c: n / sum(counts.values()) for c, n in counts.items()}


def class_weights(df: DataFrame, label_col: str = "label",
                  classes: Sequence[float] = (1.0, 0.0)) -> DataFrame:
    """``(label, n, share)`` with share = rows of the class / all rows.
    Raises if one of ``classes`` has no row."""
    counts = label_counts(df, label_col).where(F.col(label_col).isNotNull()).collect()   # one row per class
    total = sum(r["n"] for r in counts)
    missing = [c for c in classes if c not in {float(r[label_col]) for r in counts}]
    if missing:
        raise ValueError(f"class(es) {missing} have no rows; class weights undefined")
    return df.sparkSession.createDataFrame(
        [(float(r[label_col]), r["n"], r["n"] / total) for r in counts], "label double, n bigint, share double")


def first_per_class(df: DataFrame, n: int, label_col: str = "label",
                    order_col: str = "doc_id") -> DataFrame:
    """The first ``n`` rows of each class by ``order_col``.

    ``row_number() <= n`` is planned with a partial per-task group limit
    before the shuffle (WindowGroupLimit), so a class holding most rows still
    moves only n rows per task."""
    w = Window.partitionBy(label_col).orderBy(order_col)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def class_mean_tf(docs: DataFrame, vocab: Vocabulary, n: int = 40,
                  words: Sequence[str] = FORCED_WORDS, label_col: str = "label",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(label, word, avg_tf, n_docs)``: mean term frequency of ``words`` over
    the first ``n`` documents of each class (a word outside the vocabulary or
    absent from a document counts 0; the divisor is the documents found).
    Only those documents (at most n per class) are tokenised."""
    chosen = first_per_class(docs.select(id_col, label_col), n, label_col, id_col)
    # at most n ids per class: pushed into the scan as an IN filter, so only
    # the row groups holding them are read for tokenising
    ids = [r[id_col] for r in chosen.select(id_col).collect()]
    chosen_docs = docs.where(F.col(id_col).isin(ids))      # of texts or of tokenised rows
    tf = term_freq(chosen_docs, vocab, id_col, text_col, keep=[label_col]).where(
        F.col("word").isin(list(words)))
    per_class = chosen.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_docs"))
    word_rows = docs.sparkSession.createDataFrame([(w,) for w in words], "word string")
    grid = per_class.crossJoin(F.broadcast(word_rows))
    sums = tf.groupBy(label_col, "word").agg(F.sum("tf").alias("s"))
    return grid.join(sums, [label_col, "word"], "left").select(
        F.col(label_col).alias("label"), "word",
        (F.coalesce(F.col("s"), F.lit(0.0)) / F.col("n_docs").cast("double")).alias("avg_tf"),
        "n_docs")
