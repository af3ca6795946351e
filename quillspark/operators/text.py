"""Vocabulary, term frequency, TF-IDF and top-k similar documents.

Plan shapes:

* tokens (``tokenised``): one map-only Arrow pass over the texts gives a row
  per document with its distinct words and their counts. Everything below is
  made from those rows, so a caller that needs several of them pins the rows
  once (``session.pin``) and the texts are read once. No text crosses an
  exchange. Rows without a text aren't documents: they are dropped there, and
  nowhere counted.
* document frequency: ``explode(words)`` then ``groupBy(word).count()``. The
  partial aggregate collapses each task to one row per distinct word, so a
  word found in every document (a hot key) costs one row per task in the
  shuffle, not one per document.
* vocabulary: filter rule, then the top ``dim`` words by (df desc, word asc)
  as a TakeOrderedAndProject (no global sort); positions are numbered on those
  ``dim`` rows only. The vocabulary therefore has at most ``dim`` rows, which
  is the bound that makes broadcasting it safe.
* term counts: a document's words joined with the broadcast vocabulary; the
  counts are there already, so nothing is aggregated or shuffled.
* sparse features: map-only, one row per document, ``i ARRAY<INT>``
  (ascending) and ``v ARRAY<DOUBLE>``; a document without any vocabulary word
  keeps an empty vector, it still counts in losses and metrics.
* similarity: a document's words against the query's weights (at most ``dim``
  numbers in the task closure), map-only, then a top-k.
* similarity from kept vectors (``top_k_similar``): each sparse vector is
  dotted in-row with the dense query array (a one-row broadcast), then a
  top-k; no shuffle besides the top-k merge.
* snippets for the k hits: an IN filter on the k ids, pushed into the scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.columns import snippet, sparse_dot, tokens
from quillspark.operators.blocks import ENTRIES, TEXT_BYTES, blocks, bound_batches

# The words the logistic job forces past the universal-word
# filter, and profiles per class.
FORCED_WORDS = ("applicant", "and", "attack", "protein", "court")

RULE_NOT_ALL = "not_all"   # drop words found in every document
RULE_FORCED = "forced"     # as not_all, but forced words pass the filter
RULE_MAX_DF = "max_df"     # keep words with df / n <= max_df


@dataclass
class Vocabulary:
    """Fitted corpus statistics: ``table`` has ``idx INT, word STRING,
    df BIGINT, n_docs BIGINT, idf DOUBLE`` and at most ``dim`` rows."""

    table: DataFrame
    dim: int

    def words(self) -> DataFrame:
        return self.table.select("idx", "word", "df")

    def size(self) -> int:
        return self.table.count()

    def save(self, path: str) -> None:
        """Keep the fitted statistics; ``load`` gives them back."""
        self.table.write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, dim: int) -> Vocabulary:
        rows = spark.read.parquet(path).collect()      # at most dim rows
        return Vocabulary(spark.createDataFrame(rows, VOCAB_SCHEMA), dim)


def require_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"input column {name!r} not in frame columns {df.columns}")


def _types(df: DataFrame, names: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return "".join(f"`{c}` {kinds[c]}, " for c in names)


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, *keep, n_tok INT, words ARRAY<STRING>, counts ARRAY<INT>)``:
    the distinct tokens of each text, split on single spaces, with their
    counts. Rows without a text are dropped. Map-only."""
    require_column(docs, text_col)
    bound_batches(docs.sparkSession)
    names = ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, len(names), TEXT_BYTES):
            rows = b.num_rows
            split = pc.split_pattern(b.column(len(names)), " ")
            n_tok = pc.list_value_length(split)
            coded = pc.list_flatten(split).dictionary_encode()
            size = max(1, len(coded.dictionary))
            row = pc.list_parent_indices(split).to_numpy(zero_copy_only=False).astype(np.int64)
            key, count = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            ends = pa.array(np.searchsorted(key, np.arange(rows + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], n_tok.cast(pa.int32()),
                 pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(key % size))),
                 pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32)))],
                names=[*names, "n_tok", "words", "counts"])

    source = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("__text"))
    return source.mapInArrow(run, _types(source, names) + "n_tok int, words array<string>, counts array<int>")


def as_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              keep: Sequence[str] = ()) -> DataFrame:
    """``docs`` if it is tokenised already, else its ``tokenised`` rows."""
    if {"n_tok", "words", "counts"} <= set(docs.columns):
        return docs.select("doc_id", *keep, "n_tok", "words", "counts")
    return tokenised(docs, id_col, text_col, keep)


def doc_freq(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, df)``: number of documents holding each token. From texts it is
    a pass within the JVM; kept tokens have each word once already."""
    if "words" not in docs.columns:
        require_column(docs, text_col)
        docs = docs.select(F.array_distinct(tokens(text_col)).alias("words"))
    return docs.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))


VOCAB_SCHEMA = "idx int, word string, df bigint, n_docs bigint, idf double"


def fit_vocabulary(docs: DataFrame, dim: int = 2000, text_col: str = "text",
                   rule: str = RULE_NOT_ALL, forced_words: Sequence[str] = FORCED_WORDS,
                   max_df: float = 0.8, eager: bool = True) -> Vocabulary:
    """Top ``dim`` words by document frequency after the filter ``rule``;
    ties broken by word (byte order), positions 0..dim-1 in that order.

    ``eager`` (default) runs the fit once and keeps the at most ``dim`` rows
    as a local relation: later uses (train and test features, the query
    vector) broadcast those rows instead of re-running the corpus-wide
    document-frequency job, and the lineage is cut there."""
    if dim < 1:
        raise ValueError("dim must be positive")
    docs = as_tokens(docs, docs.columns[0] if "doc_id" not in docs.columns else "doc_id", text_col)
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    dfreq = doc_freq(docs, text_col).crossJoin(F.broadcast(n))
    df, n_docs = F.col("df"), F.col("n_docs")
    if rule == RULE_NOT_ALL:
        keep = df != n_docs
    elif rule == RULE_FORCED:
        keep = F.col("word").isin(list(forced_words)) | (df != n_docs)
    elif rule == RULE_MAX_DF:
        keep = (df / n_docs) <= F.lit(float(max_df))
    else:
        raise ValueError(f"unknown vocabulary rule {rule!r}")
    top = dfreq.where(keep).orderBy(F.desc("df"), F.asc("word")).limit(dim)
    pos = Window.orderBy(F.desc("df"), F.asc("word"))
    table = top.select(
        (F.row_number().over(pos) - 1).cast("int").alias("idx"),
        "word",
        "df",
        "n_docs",
        F.log((n_docs + 1).cast("double") / (df + 1).cast("double")).alias("idf"),
    )
    if eager:
        rows = table.collect()          # at most dim rows
        table = docs.sparkSession.createDataFrame(rows, VOCAB_SCHEMA)
    return Vocabulary(table, dim)


def _exploded(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per distinct word of a tokenised document."""
    each = docs.select("doc_id", *keep, "n_tok", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    return each.select("doc_id", *keep, "n_tok", F.col("e.words").alias("word"), F.col("e.counts").cast("bigint").alias("cnt"))


def term_counts(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id",
                text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, *keep, n_tok, idx, cnt)`` for vocabulary words present in a
    document; ``n_tok`` counts every token of the document."""
    v = F.broadcast(vocab.table.select("word", "idx"))
    each = _exploded(as_tokens(docs, id_col, text_col, keep), keep)
    return each.join(v, "word").select("doc_id", *keep, "n_tok", "idx", "cnt")


def term_freq(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id",
              text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, *keep, idx, word, tf)`` with tf = count / all tokens."""
    c = term_counts(docs, vocab, id_col, text_col, keep)
    v = F.broadcast(vocab.table.select("idx", "word"))
    return c.join(v, "idx").select(
        "doc_id", *keep, "idx", "word",
        (F.col("cnt") / F.col("n_tok").cast("double")).alias("tf"))


def tfidf_long(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id",
               text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, *keep, idx, x)`` with x = tf * ln((n + 1) / (df + 1))."""
    c = term_counts(docs, vocab, id_col, text_col, keep)
    v = F.broadcast(vocab.table.select("idx", "idf"))
    return c.join(v, "idx").select(
        "doc_id", *keep, "idx",
        (F.col("cnt") / F.col("n_tok").cast("double") * F.col("idf")).alias("x"))


def _weights(vocab: Vocabulary) -> tuple[pa.Array, np.ndarray]:
    """The vocabulary's words and idf by position: at most ``dim`` rows."""
    rows = sorted(vocab.table.select("idx", "word", "idf").collect())
    return pa.array([r["word"] for r in rows], pa.string()), np.array([r["idf"] for r in rows])


def features(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id",
             text_col: str = "text", keep: Sequence[str] = (),
             value: str = "tfidf") -> DataFrame:
    """Sparse vectors, one row per document: ``(doc_id, *keep, i, v)``.

    ``value`` is ``tfidf`` or ``tf``. Map-only: per Arrow batch the words are
    looked up in the vocabulary's (at most ``dim``, in the task closure). Works
    on a streaming frame too."""
    words, idf = _weights(vocab)
    bound_batches(docs.sparkSession)
    names = ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, len(names) + 1, ENTRIES):
            rows = b.num_rows
            n_tok, listed, counts = b.columns[len(names):]
            hit = pc.index_in(listed.flatten(), value_set=words)
            known = hit.is_valid()
            row = pc.list_parent_indices(listed).filter(known).to_numpy(zero_copy_only=False).astype(np.int64)
            i = hit.filter(known).to_numpy(zero_copy_only=False).astype(np.int64)
            x = counts.flatten().filter(known).to_numpy(zero_copy_only=False) / n_tok.to_numpy(zero_copy_only=False)[row].astype(np.float64)
            if value == "tfidf":
                x = x * idf[i]
            order = np.lexsort((i, row))
            ends = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(names)], pa.ListArray.from_arrays(ends, pa.array(i[order].astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(x[order], pa.float64()))], names=[*names, "i", "v"])

    source = as_tokens(docs, id_col, text_col, keep)
    return source.mapInArrow(run, _types(source, names) + "i array<int>, v array<double>")


def dense_query(query_features: DataFrame, dim: int) -> DataFrame:
    """One-row frame ``(q ARRAY<DOUBLE>)`` of length ``dim`` from the sparse
    vector(s) of ``query_features`` (summed if several rows)."""
    ex = query_features.select(F.explode(F.arrays_zip("i", "v")).alias("e"))
    per_idx = ex.groupBy(F.col("e.i").alias("i")).agg(F.sum("e.v").alias("v"))
    m = per_idx.agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("m"))
    full = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                       lambda j: F.coalesce(F.element_at(F.col("m"), j), F.lit(0.0)))
    return m.select(F.when(F.col("m").isNull(), F.array_repeat(F.lit(0.0), dim))
                    .otherwise(full).alias("q"))


def vectorize_text(spark, text: str | Column | DataFrame, vocab: Vocabulary) -> DataFrame:
    """Sparse TF-IDF vector of a query text with the corpus statistics."""
    if isinstance(text, DataFrame):
        q = text
    else:
        q = spark.range(1).select(F.lit(text).alias("text"))
    q = q.select(F.lit(0).cast("bigint").alias("doc_id"), "text")
    return features(q, vocab)


def top_k_similar(feats: DataFrame, qvec: DataFrame, k: int = 20,
                  docs: DataFrame | None = None, text_col: str = "text",
                  id_col: str = "doc_id", digits: int = 9) -> DataFrame:
    """Top ``k`` documents by the unnormalised dot product with the query.

    Every document is scored (zero when no word is shared), so fewer than k
    matches are filled with zero-score documents by id. Ties: score rounded to
    ``digits`` decimals, then id ascending. With ``docs``, a 200-character
    snippet is attached by a join of the k hits (broadcast) with the documents."""
    scored = feats.crossJoin(F.broadcast(qvec)).select(
        "doc_id", F.round(sparse_dot("i", "v", "q"), digits).alias("score"))
    hits = scored.orderBy(F.desc("score"), F.asc("doc_id")).limit(k)
    if docs is None:
        return hits
    return attach_snippets(hits, docs, id_col, text_col)


def query_weights(spark, text, vocab: Vocabulary) -> DataFrame:
    """``(word, wq)`` for the vocabulary words of the query text, with
    wq = idf(word) * q(word) and q the query's TF-IDF value: at most one row
    per distinct query word (bounded by the vocabulary size)."""
    q = vectorize_text(spark, text, vocab)
    entries = q.select(F.explode(F.arrays_zip("i", "v")).alias("e")).select(
        F.col("e.i").alias("idx"), F.col("e.v").alias("qx"))
    v = F.broadcast(vocab.table.select("idx", "word", "idf"))
    return entries.join(v, "idx").select("word", (F.col("idf") * F.col("qx")).alias("wq"))


def top_k_similar_text(docs: DataFrame, vocab: Vocabulary, text, k: int = 20,
                       id_col: str = "doc_id", text_col: str = "text",
                       digits: int = 9, tokens: DataFrame | None = None) -> DataFrame:
    """Top ``k`` documents by dot product with the query, straight from their
    words (no feature vectors): ``(rank, doc_id, score, snippet)``, best first.

    score = Σ_w tf(d, w) idf(w) q(w) = (1 / n_tok) Σ_w count(d, w) idf(w) q(w):
    one map-only pass with the query's weights (at most one number per
    vocabulary word) in the task closure, then a top-k. Documents sharing no
    word with the query score 0 (zero fill by id, ties by id). ``tokens`` are
    the documents' tokenised rows, where they are kept."""
    bound_batches(docs.sparkSession)
    rows = query_weights(docs.sparkSession, text, vocab).collect()     # at most dim rows
    words, weight = pa.array([r["word"] for r in rows], pa.string()), np.array([r["wq"] for r in rows] or [0.0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, 2, ENTRIES):
            n_tok, listed, counts = b.columns[1:]
            hit = pc.index_in(listed.flatten(), value_set=words)
            known = hit.is_valid()
            row = pc.list_parent_indices(listed).filter(known).to_numpy(zero_copy_only=False)
            w = weight[hit.filter(known).to_numpy(zero_copy_only=False).astype(np.int64)]
            s = np.bincount(row, weights=counts.flatten().filter(known).to_numpy(zero_copy_only=False) * w, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s / n_tok.to_numpy(zero_copy_only=False))], names=["doc_id", "s"])

    source = as_tokens(docs if tokens is None else tokens, id_col, text_col)
    scored = source.mapInArrow(run, _types(source, ["doc_id"]) + "s double")
    hits = scored.select("doc_id", F.round("s", digits).alias("score")).orderBy(F.desc("score"), F.asc("doc_id")).limit(k)
    return attach_snippets(hits, docs, id_col, text_col)


def attach_snippets(hits: DataFrame, docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(rank, doc_id, score, snippet)`` for the hits, best first.

    The hits are at most k rows, so they are collected once; their ids go into
    the documents scan as an IN filter, which parquet uses to skip every row
    group whose id range holds none of them. The corpus text is therefore not
    read in full a second time just for k snippets."""
    rows = sorted(hits.collect(), key=lambda r: (-r["score"], r["doc_id"]))     # at most k rows
    kinds = dict(hits.dtypes)
    local = docs.sparkSession.createDataFrame(
        [(n, r["doc_id"], r["score"]) for n, r in enumerate(rows, 1)], f"rank int, doc_id {kinds['doc_id']}, score double")
    snip = docs.where(F.col(id_col).isin([r["doc_id"] for r in rows])).select(
        F.col(id_col).alias("doc_id"), snippet(text_col).alias("snippet"))
    return snip.join(F.broadcast(local), "doc_id").select("rank", "doc_id", "score", "snippet").orderBy("rank")
