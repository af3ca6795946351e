"""The vocabulary from bounded summaries of the words, proven exact.

``fit_vocabulary`` counts every distinct word of the corpus, of which the
vocabulary keeps ``dim``. Here each task keeps a summary of ``size`` counters: a
word's counter is at most its document frequency, and falls short of it by no
more than the summary's ``error`` (when there are too many counters, the value
of the largest one that has no room is taken from all, and those at zero go).
Summaries add up: counters by word, errors by sum, and the same cut again. So
one row per task goes through the levels of ``operators.merge``, of a size that
the corpus doesn't change.

A word without a counter at the end is in at most ``error`` documents. The
words that have one, ``size`` at most, are counted exactly in a second pass
over the tokens. If the last of the ``dim`` chosen ones is in more than
``error`` documents, no other word can be among them: the vocabulary is proven.
Otherwise it is fitted by counting all words, as ever."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import text as tx
from quillspark.operators.blocks import ENTRIES, blocks, bound_batches
from quillspark.operators.merge import FAN, merged, one_row_per_task
from quillspark.session import pin

SIZE = 1 << 15
SUMMARY = "words array<string>, counts array<bigint>, error bigint"


def _packed(words: pa.Array, counts: np.ndarray, error: int) -> list[pa.Array]:
    ends = pa.array([0, len(words)], pa.int32())
    return [pa.ListArray.from_arrays(ends, words), pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int64))), pa.array([error], pa.int64())]


def cut_down(words: pa.Array, counts: np.ndarray, error: int, size: int) -> tuple[pa.Array, np.ndarray, int]:
    """At most ``size`` counters, and how far they can fall short now."""
    if len(counts) <= size:
        return words, counts, error
    off = int(np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1])      # the largest without room
    stay = counts > off
    return words.filter(pa.array(stay)), counts[stay] - off, error + off


def added(words: list[pa.Array], counts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Counters added up by word."""
    if not words:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    table = pa.table([pa.chunked_array(words, pa.string()), np.concatenate(counts)], ["word", "n"])
    sums = table.group_by("word").aggregate([("n", "sum")]).sort_by("word")
    return sums.column("word").combine_chunks(), sums.column("n_sum").to_numpy()


def summaries(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """One summary per task of the words of ``tokens(words, ...)``, in which a
    document has each of its words once."""
    def run(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        words, counts, error = pa.array([], pa.string()), np.zeros(0, np.int64), 0
        for b in blocks(batches, 0, ENTRIES):
            new = pc.value_counts(b.column(0).flatten())
            words, counts = added([words, new.field("values")], [counts, new.field("counts").to_numpy()])
            if len(counts) > 2 * size:
                words, counts, error = cut_down(words, counts, error, size)
        words, counts, error = cut_down(words, counts, error, size)
        return pa.RecordBatch.from_arrays(_packed(words, counts, error), names=["words", "counts", "error"])

    return tokens.select("words").mapInArrow(one_row_per_task(run), SUMMARY)


def add_summaries(rows: pa.Table, size: int = SIZE) -> pa.Table:
    words = [r.values for r in rows.column("words") if len(r)]
    counts = [r.values.to_numpy() for r in rows.column("counts") if len(r)]
    error = sum(rows.column("error").to_pylist())
    return pa.table(_packed(*cut_down(*added(words, counts), error, size)), ["words", "counts", "error"])


def summary(tokens: DataFrame, size: int = SIZE, tasks: int | None = None, fan: int = FAN) -> tuple[pa.Array, np.ndarray, int]:
    """The corpus' words with a counter, their counters and the error."""
    one = merged(summaries(tokens, size), lambda rows: add_summaries(rows, size), tasks, fan)
    if not one.num_rows:
        return pa.array([], pa.string()), np.zeros(0, np.int64), 0
    return one.column("words")[0].values, one.column("counts")[0].values.to_numpy(), one.column("error")[0].as_py()


def exact_counts(tokens: DataFrame, words: pa.Array, tasks: int | None = None, fan: int = FAN) -> np.ndarray:
    """Document frequencies of the given words, and last the number of
    documents: one packed row per task."""
    n = len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        total = np.zeros(n + 1, np.int64)
        for b in blocks(batches, 0, ENTRIES):
            at = pc.index_in(b.column(0).flatten(), value_set=words).drop_null().to_numpy()
            total[:n] += np.bincount(at, minlength=n)[:n]
            total[n] += b.num_rows
        return pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["n"])

    def add_up(rows: pa.Table) -> pa.Table:
        total = np.sum([r.values.to_numpy() for r in rows.column("n")], axis=0)
        return pa.table([pa.array([total], pa.list_(pa.int64()))], ["n"])

    rows = merged(tokens.select("words").mapInArrow(one_row_per_task(run), "n array<bigint>"), add_up, tasks, fan)
    return rows.column("n")[0].values.to_numpy() if rows.num_rows else np.zeros(n + 1, np.int64)


@dataclass
class Proof:
    """Why a vocabulary is complete: ``least`` is the document frequency of its
    last word, ``error`` the most that a word without a counter can have."""

    proven: bool
    error: int
    least: int
    candidates: int


def fit_vocabulary(docs: DataFrame, dim: int = 2000, text_col: str = "text", rule: str = tx.RULE_NOT_ALL,
                   forced_words: Sequence[str] = tx.FORCED_WORDS, max_df: float = 0.8, size: int = SIZE,
                   fan: int = FAN) -> tuple[tx.Vocabulary, Proof]:
    """``text.fit_vocabulary`` with the same rows, and the proof. ``docs`` are
    texts or their tokenised rows, which are pinned (they are read twice)."""
    if dim < 1 or size < 1:
        raise ValueError("dim and size must be positive")
    bound_batches(docs.sparkSession)
    tokens = docs if "words" in docs.columns else pin(tx.tokenised(docs, docs.columns[0] if "doc_id" not in docs.columns else "doc_id", text_col))
    tasks = tokens.rdd.getNumPartitions()
    words, _, error = summary(tokens, size, tasks, fan)
    counts = exact_counts(tokens, words, tasks, fan)
    df, n = counts[:-1], int(counts[-1])
    names = np.array(words.to_pylist(), object)
    if rule == tx.RULE_MAX_DF:
        keep = df / max(n, 1) <= max_df
    elif rule in (tx.RULE_NOT_ALL, tx.RULE_FORCED):
        keep = df != n
        if rule == tx.RULE_FORCED:
            keep |= np.isin(names, list(forced_words))
    else:
        raise ValueError(f"unknown vocabulary rule {rule!r}")
    rows = sorted(zip((-df[keep]).tolist(), (w.encode("utf-8") for w in names[keep])))[:dim]
    least = -rows[-1][0] if len(rows) == dim else 0
    proof = Proof(error == 0 or least > error, error, least, len(words))
    if not proof.proven:
        return tx.fit_vocabulary(tokens, dim, text_col, rule, forced_words, max_df), proof
    spark = tokens.sparkSession
    known = spark.createDataFrame([(k, w.decode("utf-8"), -m, n) for k, (m, w) in enumerate(rows)], "idx int, word string, df bigint, n_docs bigint")
    idf = F.log((F.col("n_docs") + 1).cast("double") / (F.col("df") + 1).cast("double")).alias("idf")
    table = spark.createDataFrame(known.select("*", idf).collect(), tx.VOCAB_SCHEMA)        # at most dim rows
    return tx.Vocabulary(table, dim), proof
