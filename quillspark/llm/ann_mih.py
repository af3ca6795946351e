"""Nearest neighbours by inner product through multi-index hashing.

Vectors get one more component that turns largest inner product into smallest
angle (the slack to the largest norm; a query's is 0). Binary codes are signs
after ``ROTATIONS`` learned rotations: each is fitted on at most ``FIT_ROWS``
vectors (those of least hash of the id) by alternating between signs and the
rotation that brings the data nearest to them. A code is split into
substrings of 16 bits and each substring is indexed. By the pigeonhole
principle a code within Hamming radius r of the query's has a substring within
``r // substrings`` bits of the query's; probing those buckets retrieves every
code within r, whose vectors are then ranked by the inner product in double
precision. The radius is fitted on the same sample to reach ``RECALL``; queries
that have too few codes within it go again with a larger one, up to all bits.

All vectors are indexed, in shards of ``SHARD_ROWS``; queries meet each shard
in blocks, and a block returns its nearest only. Of equal vectors only the
``k + 1`` smallest ids can be among the nearest, and equal queries are searched
once, so a vector that a third of the rows share costs no more than others.

Defined results. Vectors that are null, zero, or hold null or non-finite
components take no part, as queries or candidates; nor do vectors of another
length than most (ties to the shorter). Repeated ids are candidates of their
own. Ties go to the smaller vec_id. Fewer candidates than ``k`` give fewer
rows; an empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, cut, seeded
from quillspark.sources.tables import read_table

NEAREST = 20
EVERY = 20               # queries: ids divisible by this
ROTATIONS = 2
SUBSTRING = 16
FIT_ROWS = 8192
FIT_QUERIES = 256
FIT_STEPS = 20
RECALL = 0.98
WIDER = 16               # a wider radius has this part of all bits more
SHARD_ROWS = 16_384
QUERY_ROWS = 1024
BITS = np.array([bin(v).count("1") for v in range(1 << SUBSTRING)], np.uint8)


def taking_part(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` in doubles, of those that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    sound = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    lengths = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").limit(1).collect()
    return sound.where(F.size("v") == (lengths[0].d if lengths else 0))


class Hasher:
    """Codes of vectors: learned rotations of the data with its norm's slack."""

    def __init__(self, sample: np.ndarray, norm: float, rotations: int = ROTATIONS, seed: int = SEED):
        self.norm = norm
        x = self.lift(sample)
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        self.rotations = []
        for _ in range(rotations):
            r = np.linalg.qr(rng.normal(size=(d, d)))[0]
            for _ in range(FIT_STEPS):
                u, _, w = np.linalg.svd(np.sign(x @ r).T @ x)
                r = (u @ w).T
            self.rotations.append(r)
        pad = -(d * rotations) % SUBSTRING
        self.bits, self.pad = d * rotations + pad, pad

    def lift(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        if query:
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            return np.concatenate([x, np.zeros((len(x), 1))], 1)
        x = x / self.norm
        slack = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1)))
        return np.concatenate([x, slack[:, None]], 1)

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """A row of 16-bit substrings for each vector."""
        lifted = self.lift(x, query)
        signs = np.concatenate([lifted @ r > 0 for r in self.rotations] + [np.zeros((len(x), self.pad), bool)], 1)
        return np.packbits(signs, axis=1).view(np.uint16).reshape(len(x), -1)


class Index:
    """A shard: per substring, the values that occur and the rows that have them."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, begin = np.unique(column[order], return_index=True)
            self.tables.append((order, values, np.append(begin, len(order))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius of ``code``, every one."""
        m = self.codes.shape[1]
        hit = np.zeros(len(self.codes), bool)
        for part, (order, values, begin) in zip(code, self.tables):
            near = np.flatnonzero(BITS[values ^ part] <= radius // m)
            size = begin[near + 1] - begin[near]
            at = np.arange(int(size.sum())) + np.repeat(begin[near] - (np.cumsum(size) - size), size)
            hit[order[at]] = True
        rows = np.flatnonzero(hit)
        distance = BITS[self.codes[rows] ^ code].sum(1, dtype=np.int32)
        return rows[distance <= radius]


def ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))][:k]
    return np.lexsort((ids, -scores))[:k]


def fit_radius(hasher: Hasher, sample: np.ndarray, k: int, recall: float = RECALL) -> int:
    """The radius within which the sample's own nearest ones are found. A
    sample's neighbours are farther than those in the whole, so it is ample."""
    queries = sample[:FIT_QUERIES]
    base, asked = hasher.codes(sample), hasher.codes(queries, query=True)
    distances = []
    for q, (x, code) in enumerate(zip(queries, asked)):
        scores = sample @ x
        scores[q] = -np.inf
        best = ranked(scores, np.arange(len(scores)), min(k, len(sample) - 1))
        distances.append(BITS[base[best] ^ code].sum(1, dtype=np.int32))
    found = np.concatenate(distances) if distances else np.zeros(0)
    return int(np.quantile(found, recall, method="higher")) if len(found) else hasher.bits


def search(vectors: DataFrame, is_query: Column, k: int = NEAREST) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows of ``vectors(vec_id,
    embedding)`` where ``is_query``, over all rows but the query's own."""
    spark = vectors.sparkSession
    sound = cut(taking_part(vectors))
    # of equal vectors, the k + 1 smallest ids can be among the nearest of any
    # query; ranking stops there before the shuffle too
    same = Window.partitionBy("v").orderBy("vec_id")
    base = cut(sound.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    facts = base.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"), F.count(F.lit(1)).alias("n"),
                     F.sum(F.size("ids")).alias("ids")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts.n:
        return spark.createDataFrame([], schema)
    sample = base.select("v", F.element_at("ids", 1).alias("id")).orderBy(seeded(SEED, "id"), "id").limit(FIT_ROWS).collect()
    sample = np.array([r.v for r in sample])
    hasher = Hasher(sample, facts.norm)
    radius = fit_radius(hasher, sample, k)

    asked = cut(sound.where(is_query).groupBy("v").agg(F.min("vec_id").alias("q")))
    # a query's own row is among what it finds; fewer rows than that are all there are
    wanted = min(k + 1, facts.ids)
    found, left = None, asked
    while True:
        some = cut(_nearest(base, left, facts.n, hasher, radius, k))
        full = some.where(F.size("hits") >= wanted) if radius < hasher.bits else some
        found = full if found is None else found.unionByName(full)
        if radius >= hasher.bits:
            break
        left = cut(left.join(full.select(F.col("_q")), F.col("q") == F.col("_q"), "left_anti"))
        if left.isEmpty():
            break
        radius = min(hasher.bits, radius + max(1, hasher.bits // WIDER))
    each = sound.where(is_query).select("vec_id", "v").join(cut(asked.select(F.col("v").alias("_v"), "q")), F.col("v") == F.col("_v")).select(F.col("vec_id").alias("query_id"), "q")
    own = F.filter("hits", lambda h: h["hit"]["ids"] != F.col("query_id"))
    rows = each.join(found, F.col("q") == F.col("_q")).select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "h"))
    return rows.select("query_id", (F.col("at") + 1).alias("rank"), F.col("h.hit.ids").alias("vec_id"), F.col("h.hit.scores").alias("score"))


def _nearest(base: DataFrame, asked: DataFrame, n: int, hasher: Hasher, radius: int, k: int) -> DataFrame:
    """``(_q, hits)``: the ``k + 1`` best rows of ``base(v, ids)``, ``n`` vectors,
    within the radius of each of ``asked(v, q)``, best first; queries with none
    are left out."""
    shards = max(1, round(n / SHARD_ROWS))
    groups = max(1, -(-asked.count() // QUERY_ROWS))
    dealt = base.withColumn("shard", F.pmod(seeded(SEED, F.element_at("ids", 1)), F.lit(shards)))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("block", F.pmod(seeded(SEED + 1, "q"), F.lit(groups)).cast("int"))
    blocks = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def array(column: pa.ChunkedArray) -> np.ndarray:
        column = column.combine_chunks()
        return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)

    def find(here: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if here.num_rows and queries.num_rows:
            x, q = array(here["v"]), array(queries["v"])
            ids = here["ids"].to_pylist()
            least = np.array([i[0] for i in ids])
            index, codes = Index(hasher.codes(x)), hasher.codes(q, query=True)
            for query, v, code in zip(queries["q"].to_pylist(), q, codes):
                rows = index.within(code, radius)
                scores = x[rows] @ v
                best = ranked(scores, least[rows], k + 1)
                hits = sorted((-s, i) for s, r in zip(scores[best].tolist(), rows[best].tolist()) for i in ids[r])[:k + 1]
                out[0].append(query)
                out[1].append([i for _, i in hits])
                out[2].append([-s for s, _ in hits])
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.float64()))], ["q", "ids", "scores"])

    found = dealt.groupBy("shard", "block").cogroup(blocks.groupBy("shard", "block")).applyInArrow(find, "q long, ids array<long>, scores array<double>")
    hit = F.explode(F.arrays_zip("ids", "scores")).alias("hit")
    best = Window.partitionBy("q").orderBy(F.col("hit.scores").desc(), F.col("hit.ids"))
    found = found.select("q", hit).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    return found.groupBy(F.col("q").alias("_q")).agg(F.sort_array(F.collect_list(F.struct("n", "hit"))).alias("hits"))


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % EVERY == 0)
