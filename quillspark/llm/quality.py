"""Quality scores: random-indexing word vectors, pooled, and a small network.

A word is a run of letters, digits or other signs; its hash picks one of
``WORDS`` rows. Each row has a sparse random ternary index vector. Its word
vector is the sum of the index vectors of the words up to ``WINDOW`` places
from it, over the whole corpus: one pass that adds up a table of fixed size per
task, merged by table part in as many levels as there are tasks for. A document's features are the mean of
its words' vectors, the mean of the random vectors of their shapes (case, kind,
repeats of the word before), and its length. A network of two layers, trained
in numpy on at most ``FIT_ROWS`` labelled rows (those of least hash of the id),
scores them; a temperature fitted on a fifth of those rows calibrates it.

Defined results. Null and empty texts have zero vectors and a score like any
other. Labels whose quality is null are left out; of several labels for an id
the mean decides (0.5 counts as 1). Without labels of both kinds every score is
the share of label 1 (0.5 without any). Every input row gives one result row;
extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, bounded_batches, documents, seeded
from quillspark.llm.tokens import Splitter, Words, mix
from quillspark.operators.merge import FAN, levels
from quillspark.sources.tables import read_table

WORDS = 1 << 14
DIMS = 32
NONZERO = 4           # ones and minus ones of an index vector
WINDOW = 2
SHAPES = 512
FIT_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40           # at least, and as many as LEAST_STEPS batches need
LEAST_STEPS = 1200
THRESHOLD = 0.3
PARTS = 64            # of the table of word vectors, for merging


def index_vectors(rows: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, DIMS), np.float32)
    for r in range(rows):
        at = rng.permutation(DIMS)[:NONZERO]
        out[r, at] = rng.choice([-1.0, 1.0], NONZERO)
    return out


def context_sums(w: Words, index: np.ndarray, sums: np.ndarray) -> None:
    """Add to ``sums`` the index vectors around each word of its own row."""
    at = (w.hash & np.uint64(WORDS - 1)).astype(np.int64)
    if len(at) < 2:
        return
    around = np.zeros((len(at), DIMS), np.float32)
    for step in range(1, WINDOW + 1):
        if len(at) <= step:
            break
        same = (w.row[step:] == w.row[:-step])[:, None]
        around[step:] += index[at[:-step]] * same
        around[:-step] += index[at[step:]] * same
    for d in range(DIMS):
        sums[:, d] += np.bincount(at, weights=around[:, d], minlength=WORDS)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors of a corpus ``docs(text)``, each of unit length."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, index, sums = Splitter(), index_vectors(WORDS, SEED), np.zeros((WORDS, DIMS))
        for batch in batches:
            for w in split.words(batch.column(0)):
                context_sums(w, index, sums)
        values = sums.astype(np.float32).reshape(PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(list(values), pa.list_(pa.float32()))], ["part", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        total = sum(np.asarray(v.values, np.float64) for v in rows["sums"])
        return pa.table([pa.array([rows["task"][0].as_py() // FAN], pa.int32()), pa.array([rows["part"][0].as_py()], pa.int32()),
                         pa.array([total.astype(np.float32)], pa.list_(pa.float32()))], ["task", "part", "sums"])

    partial = docs.select("text").mapInArrow(count, "part int, sums array<float>")
    merged = partial.select(F.spark_partition_id().alias("task"), "part", "sums")
    for _ in range(levels(partial.rdd.getNumPartitions()) + 1):     # a group has FAN rows at most, whatever the tasks
        merged = merged.groupBy("part", F.floor(F.col("task") / FAN).alias("_group")).applyInArrow(add, "task int, part int, sums array<float>")
    table = np.zeros((PARTS, WORDS // PARTS * DIMS))
    for row in merged.collect():  # one table of fixed size
        table[row.part] = row.sums
    table = table.reshape(WORDS, DIMS)
    return (table / np.maximum(1e-9, np.linalg.norm(table, axis=1, keepdims=True))).astype(np.float32)


def shapes(w: Words, lower: np.ndarray) -> np.ndarray:
    """A row of the shape vectors for each word: its first two bytes' case or
    sign, whether it goes on in capitals, and whether it repeats its
    predecessor."""
    first = lower[w.data[w.start]]
    second = lower[w.data[np.minimum(w.start + 1, w.end - 1)]]
    last = lower[w.data[w.end - 1]]
    length = np.minimum(w.end - w.start, 3)
    again = np.zeros(len(first), np.int64)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    # words repeat with a sign between them too
    again[2:] |= (w.hash[2:] == w.hash[:-2]) & (w.row[2:] == w.row[:-2]) & (length[2:] > 2)
    code = (((first.astype(np.int64) * 64 + second) * 64 + last) * 4 + length) * 2 + again
    return (mix(code.astype(np.uint64)) & np.uint64(SHAPES - 1)).astype(np.int64)


def byte_shapes() -> np.ndarray:
    """Letters to one of two values, digits to one, each sign to its own."""
    out = np.zeros(256, np.uint8)
    for c in range(256):
        ch = chr(c)
        out[c] = 0 if c >= 128 else 1 if ch.islower() else 2 if ch.isupper() else 3 if ch.isdigit() else 4 + c % 60
    return out


class Features:
    """Documents' features from a table of word vectors."""

    size = 2 * DIMS + 2

    def __init__(self, vectors: np.ndarray):
        self.split, self.vectors = Splitter(), vectors
        self.shape_vectors, self.lower = index_vectors(SHAPES, SEED + 1) / NONZERO ** 0.5, byte_shapes()

    def of(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), self.size), np.float32)
        for w in self.split.words(column):
            bounds = w.bounds()
            n = np.diff(bounds)
            full = n > 0
            block = out[w.first:w.first + w.rows]
            if len(w.row):
                at = (w.hash & np.uint64(WORDS - 1)).astype(np.int64)
                for to, vectors, rows in ((0, self.vectors, at), (DIMS, self.shape_vectors, shapes(w, self.lower))):
                    sums = np.add.reduceat(vectors[rows], bounds[:-1][full], axis=0)
                    block[full, to:to + DIMS] = sums / n[full, None]
            block[:, -2] = np.log1p(n) / 5
            block[:, -1] = n == 0
        return out


class Network:
    """Two layers; ``fit`` trains by Adam and calibrates by a temperature."""

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        self.mean, self.sd = (x.mean(0), x.std(0) + 1e-6) if len(x) else (0.0, 1.0)
        self.base = float(y.mean()) if len(y) else 0.5
        self.layers = None
        self.temperature = 1.0
        if len(y) < 10 or y.min() == y.max():
            return self
        z = (x - self.mean) / self.sd
        order = rng.permutation(len(z))
        held, fit = order[: len(z) // 5], order[len(z) // 5:]
        p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        p[3][:] = np.log(self.base / (1 - self.base))
        m, v, step = [0 * a for a in p], [0 * a for a in p], 0
        best, best_loss = [a.copy() for a in p], np.inf
        for _ in range(max(EPOCHS, -(-LEAST_STEPS // -(-len(fit) // 256)))):
            for at in range(0, len(fit), 256):
                rows = fit[at:at + 256] if len(fit) > 256 else fit
                a = np.tanh(z[rows] @ p[0] + p[1])
                error = (1 / (1 + np.exp(-np.clip(a @ p[2] + p[3], -30, 30))) - y[rows]) / len(rows)
                back = error[:, None] * p[2] * (1 - a * a)
                grads = [z[rows].T @ back + 1e-4 * p[0], back.sum(0), a.T @ error + 1e-4 * p[2], error.sum(keepdims=True)]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] -= 3e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
            loss = self._loss(np.tanh(z[held] @ p[0] + p[1]) @ p[2] + p[3], y[held], 1.0)
            if loss < best_loss:
                best, best_loss = [a.copy() for a in p], loss
        self.layers = best
        logits = np.tanh(z[held] @ best[0] + best[1]) @ best[2] + best[3]
        grid = np.exp(np.linspace(np.log(0.25), np.log(4), 81))
        self.temperature = float(grid[np.argmin([self._loss(logits, y[held], t) for t in grid])])
        return self

    @staticmethod
    def _loss(logits, y, t) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - y * logits / t))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.base)
        w, b, u, c = self.layers
        logits = (np.tanh((x.astype(np.float64) - self.mean) / self.sd @ w + b) @ u + c) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs(doc_id, text)`` and a network from at
    most ``fit_rows`` rows of ``labels(doc_id, quality)`` that aren't held out."""
    vectors = word_vectors(docs)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = known.orderBy(seeded(SEED, "doc_id"), "doc_id").limit(fit_rows).collect()  # at most fit_rows pairs
    spark = docs.sparkSession
    sample = spark.createDataFrame([(r.doc_id, r.y) for r in known], "_id long, y double")
    chosen = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(vectors)
        for batch in batches:
            x = features.of(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float32()))], ["doc_id", "y", "x"])

    rows = chosen.mapInArrow(run, "doc_id long, y double, x array<float>").toArrow()
    rows = rows.sort_by("doc_id")
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(len(rows), Features.size)
    return vectors, Network().fit(x, rows["y"].to_numpy())


def score(docs: DataFrame, vectors: np.ndarray, network: Network, name: str = "score") -> DataFrame:
    """Adds (or replaces) a column, the score, in every row of ``docs``, which
    has a column ``text``."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop(name)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(vectors)
        for batch in batches:
            x = features.of(batch.column(names.index("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(network.score(x))], [*names, name])

    return docs.mapInArrow(run, ", ".join([f"`{c}` {t}" for c, t in docs.dtypes] + [f"`{name}` double"]))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    vectors, network = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs, vectors, network)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
