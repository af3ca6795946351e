"""Language-model scores: masked pseudo-likelihood of a window network.

Every word (a run of letters, digits or other signs) has one of ``CODES``
codes: the corpus's most frequent words one each, all others one of
``RARE`` by hash. A small network sees the codes of two words on either side,
never the word itself, and predicts its code in two factors, group and member.
A word that shares its code has a share of the code's probability, by the
counts of all words in the corpus: ``(n + 1) / (n of the code + its words + 1)``,
where the last 1 is the share of words that the corpus doesn't hold. A document's
score is the sum over its words of the log-probability given both sides.

The network is trained in numpy by the tasks: in each epoch every task goes
once through its documents, each word of which is a target, and the tasks'
parameters are averaged by the number of their targets, in levels. Word counts
and training both cover the whole corpus. Counts stay in a written table that
meets the documents' words by a join; such a word is no more than one in
``CODES - RARE`` of all, so no key of that join is hot.

Defined results. Null and empty texts have no words: log-probability 0.0 and
null per word. Every input row gives one result row; equal texts get equal
scores up to single precision's rounding; extra columns are ignored; an empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, bounded_batches, cut, documents
from quillspark.llm.tokens import Splitter, Words
from quillspark.operators.merge import merged

GROUPS = 32
MEMBERS = 32
CODES = GROUPS * MEMBERS
RARE = 256
BESIDE = (-2, -1, 1, 2)
EMBED = 8
HIDDEN = 16
EPOCHS = 1
BATCH = 2048
RATE = 0.08
SCALE = 1 << 30        # logarithms are summed as integers, in any order
SHAPES = {
    "embed": (CODES + 1, EMBED), "w1": (len(BESIDE) * EMBED, HIDDEN), "b1": (HIDDEN,),
    "wg": (HIDDEN, GROUPS), "bg": (GROUPS,), "wm": (HIDDEN, MEMBERS), "bm": (GROUPS, MEMBERS),
}


class Codes:
    """Words' codes: rank for the frequent ones, a hashed code for the rest."""

    def __init__(self, frequent: np.ndarray):
        order = np.argsort(frequent)
        self.known, self.rank = frequent[order], order
        first = np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)
        self.first = np.minimum(np.searchsorted(self.known, first), max(0, len(order) - 1))      # by a hash's first bits
        self.several = np.bincount((self.known >> np.uint64(48)).astype(np.int64), minlength=1 << 16).max(initial=0)

    def of(self, w: Words) -> np.ndarray:
        rare = CODES - RARE + (w.hash & np.uint64(RARE - 1)).astype(np.int64)
        if not len(self.known):
            return rare
        first = self.first.take((w.hash >> np.uint64(48)).astype(np.int64))
        for k in range(self.several):
            at = np.minimum(first + k, len(self.known) - 1) if k else first
            hit = np.flatnonzero(self.known.take(at) == w.hash)
            rare[hit] = self.rank.take(at.take(hit))
        return rare


def contexts(codes: np.ndarray, row: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Codes beside each target; ``CODES`` beyond its text's ends."""
    out = np.full((len(targets), len(BESIDE)), CODES, np.int64)
    own = row.take(targets)
    for c, step in enumerate(BESIDE):
        at = targets + step
        near = np.minimum(np.maximum(at, 0), len(codes) - 1)
        np.copyto(out[:, c], codes.take(near), where=(at == near) & (row.take(near) == own))
    return out


def column_sums(values: np.ndarray) -> np.ndarray:
    """Sums of columns, added up in the order in which numpy adds a row of up
    to 128 numbers that stand together, eight at a time."""
    if len(values) % 8 or not 8 <= len(values) <= 128:
        return np.ascontiguousarray(values.T).sum(1)
    s = values[:8].copy()
    for at in range(8, len(values), 8):
        s += values[at:at + 8]
    return ((s[0] + s[1]) + (s[2] + s[3])) + ((s[4] + s[5]) + (s[6] + s[7]))


class Network:
    def __init__(self, flat: np.ndarray | None = None, seed: int = SEED):
        sizes = [int(np.prod(s)) for s in SHAPES.values()]
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = np.concatenate([rng.normal(0, 0.3 if k == "embed" else s[0] ** -0.5, n) if k[0] != "b" else np.zeros(n)
                                   for (k, s), n in zip(SHAPES.items(), sizes)])
        self.flat = np.array(flat, np.float32)
        self.p, at = {}, 0
        for (k, s), n in zip(SHAPES.items(), sizes):
            self.p[k] = self.flat[at:at + n].reshape(s)
            at += n

    def forward(self, beside: np.ndarray, target: np.ndarray, training: bool = True):
        """Inputs, hidden units, factors of the targets, both factors'
        probabilities (when ``training``), and log-probabilities. What has a row
        for each member of a factor has a column for each target: numpy goes
        along whole rows, several times as fast as across them."""
        p = self.p
        x = p["embed"].take(beside, axis=0).reshape(len(beside), -1)
        h = np.tanh(x @ p["w1"] + p["b1"])
        group, member = target // MEMBERS, target % MEMBERS
        each, out = np.arange(len(target)), []
        of_group = p["wg"].T @ h.T
        of_group += p["bg"][:, None]
        of_member = p["wm"].T @ h.T
        of_member += np.take(np.ascontiguousarray(p["bm"].T), group, axis=1)
        for logits, hit in ((of_group, group), (of_member, member)):
            logits -= logits.max(0)
            chosen = logits[hit, each]
            e = np.exp(logits, out=logits)
            total = column_sums(e)
            if training:
                e /= total
            out += [e, chosen - np.log(total)]
        return x, h, group, member, out[0], out[2], out[1] + out[3]

    def log_probabilities(self, beside: np.ndarray, target: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(beside[at:at + 4096], target[at:at + 4096], False)[-1] for at in range(0, len(target), 4096)] or [np.zeros(0)])

    def gradients(self, beside: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of a batch's mean loss."""
        p, n = self.p, np.float32(len(target))
        x, h, group, member, pg, pm, _ = self.forward(beside, target)
        each = np.arange(len(target))
        pg[group, each] -= 1
        pm[member, each] -= 1
        pg /= n
        pm /= n
        back = (pg.T @ p["wg"].T + pm.T @ p["wm"].T) * (1 - h * h)
        dx = (back @ p["w1"].T).reshape(-1, EMBED)
        flat, dx = beside.reshape(-1), np.ascontiguousarray(dx.T, np.float64)
        rows = pg.T.copy()
        return {
            "wg": h.T @ rows, "bg": rows.sum(0), "wm": h.T @ pm.T, "w1": x.T @ back, "b1": back.sum(0),
            "bm": np.bincount((np.arange(MEMBERS)[:, None] * GROUPS + group).reshape(-1), pm.reshape(-1), GROUPS * MEMBERS).reshape(MEMBERS, GROUPS).T,
            "embed": np.stack([np.bincount(flat, weights=w, minlength=CODES + 1) for w in dx], 1),
        }

    def step(self, beside: np.ndarray, target: np.ndarray, squares: dict[str, np.ndarray]) -> None:
        """One Adagrad step on a batch."""
        for k, g in self.gradients(beside, target).items():
            squares[k] += (g * g).astype(np.float32)
            self.p[k] -= RATE * (g / (np.sqrt(squares[k]) + 1e-6)).astype(np.float32)


@dataclass
class Model:
    """The frequent words in order of their codes, the network's parameters, the
    mass of each shared code (its words' counts, its words and 1), and the
    counts of all words, a written table ``(word, n)``."""

    frequent: np.ndarray
    flat: np.ndarray
    mass: np.ndarray
    words: DataFrame


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: how often each word's hash occurs in ``docs(text)``."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter()
        for batch in batches:
            found = [w.hash for w in split.words(batch.column(0))]
            hashes, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return cut(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, epochs: int = EPOCHS) -> Model:
    """A model of ``docs(text)``."""
    words = word_counts(docs)
    top = words.orderBy(F.col("n").desc(), "word").limit(CODES - RARE).collect()
    mass = np.ones(RARE)
    for r in words.groupBy(F.col("word").bitwiseAND(RARE - 1).alias("code")).agg(F.sum(F.col("n") + 1).alias("mass")).collect():  # RARE rows
        mass[r.code] += r.mass
    for r in top:
        mass[r.word & (RARE - 1)] -= r.n + 1
    frequent = np.array([r.word for r in top], np.int64).view(np.uint64)
    flat = Network().flat
    for _ in range(epochs):
        flat = _epoch(docs, frequent, flat)
    return Model(frequent, flat, mass, words)


def _epoch(docs: DataFrame, frequent: np.ndarray, flat: np.ndarray) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, codes, net = Splitter(), Codes(frequent), Network(flat)
        squares = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
        seen = 0
        for batch in batches:
            for w in split.words(batch.column(0)):
                c = codes.of(w)
                for at in range(0, len(c), BATCH):
                    targets = np.arange(at, min(len(c), at + BATCH))
                    net.step(contexts(c, w.row, targets), c[targets], squares)
                seen += len(c)
        yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([net.flat.astype(np.float64) * seen], pa.list_(pa.float64()))], ["seen", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = sum(np.asarray(v.values, np.float64) for v in table["sums"])
        return pa.table({"seen": pa.array([sum(table["seen"].to_pylist())]), "sums": pa.array([sums], pa.list_(pa.float64()))})

    row = merged(docs.select("text").mapInArrow(run, "seen double, sums array<double>"), add).to_pylist()
    return np.array(row[0]["sums"]) / row[0]["seen"] if row and row[0]["seen"] else flat


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_words, log_prob, log_prob_per_word)`` of ``docs(doc_id, text)``."""
    bounded_batches(docs.sparkSession)
    frequent, flat, mass = model.frequent, model.flat, np.log(model.mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, codes, net = Splitter(), Codes(frequent), Network(flat)
        for batch in batches:
            n, total, shared = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            words = [np.zeros(0, np.int64)]
            for w in split.words(batch.column(1)):
                c = codes.of(w)
                each = np.zeros(len(c))
                for at in range(0, len(c), 1 << 16):
                    targets = np.arange(at, min(len(c), at + (1 << 16)))
                    each[targets] = net.log_probabilities(contexts(c, w.row, targets), c[targets])
                rare = np.flatnonzero(c >= CODES - RARE)
                each[rare] -= mass[c[rare] - (CODES - RARE)]
                words.append(w.hash[rare].view(np.int64))
                rows = slice(w.first, w.first + w.rows)
                n[rows] = np.diff(w.bounds())
                total[rows] = np.bincount(w.row, weights=each, minlength=w.rows)
                shared[rows] = np.bincount(w.row[rare], minlength=w.rows)
            ends = np.append(0, np.cumsum(shared)).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(total), words], ["doc_id", "n_words", "log_prob", "words"])

    kind = dict(docs.dtypes)["doc_id"]
    coded = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, log_prob double, words array<long>")
    coded = cut(coded.withColumn("row", F.monotonically_increasing_id()))
    counts = model.words.select(F.col("word").alias("_word"), F.round(F.log(F.col("n") + 1) * SCALE).cast("long").alias("_log"))
    logs = (coded.select(F.col("row").alias("_row"), F.explode("words").alias("word")).join(counts, F.col("word") == F.col("_word"))
            .groupBy("_row").agg((F.sum("_log") / SCALE).alias("_logs")))
    both = coded.drop("words").join(logs, F.col("row") == F.col("_row"), "left")
    total = F.col("log_prob") + F.coalesce(F.col("_logs"), F.lit(0.0))
    return both.select("doc_id", "n_words", total.alias("log_prob"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("log_prob_per_word"))


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs))
