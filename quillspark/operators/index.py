"""A kept inverted index of a corpus, and exact top-k retrieval from it.

``build`` reads the texts once and writes three tables under a folder: the
fitted vocabulary, ``documents`` (id, 200-character snippet, sparse TF-IDF
vector; sorted by id) and ``postings``: for each word its documents by falling
weight, cut into blocks of up to ``BLOCK`` with the block's largest weight. A
word in every document is a posting list as long as the corpus, so the lists
are dealt out by ranges of (word, weight, id), never by word alone.

``top_k`` finds, for many query texts at once, the ``k`` documents of largest
dot product, exactly, without scoring every document for every query:

1. *Seeds.* Each query word's first block gives documents with partial scores;
   the best k of them are scored in full. The k-th of those scores is a floor:
   nothing below it can be in the result.
2. *Level.* A query's contributions u (weight in the query x largest weight in
   the index) are cut at the level where the cut ones add up to the floor. A
   document that reaches the level in no word can't reach the floor.
3. *Candidates.* Only blocks whose largest weight reaches the level are read,
   joined with the queries by word, and added up by (query, document). What
   the unread rest could still add is known, so a candidate whose bound is
   below the floor goes; so does one whose bound is below the k-th sum.
4. *Scores.* The others meet their vectors by id and are scored in full.

Step 3 is an equi-join on the word; no document meets a query with which it has
no heavy word in common. Queries with fewer than k hits are filled with
documents of score 0 by id, as every document has a score.

Defined results. Rows without a text or without an id aren't documents; ids are
taken to be unique. Queries without a text have no hits; a query without a known
word gets the first k ids with score 0. Ties go to the smaller id."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.columns import snippet
from quillspark.operators.blocks import ENTRIES, blocks, bound_batches
from quillspark.operators.text import RULE_NOT_ALL, Vocabulary, features, fit_vocabulary, tokenised
from quillspark.session import pin

BLOCK = 1024
#: Rows of a task where postings are sorted and (query, document) pairs added up: tasks grow with the rows, not the tasks' memory.
TASK_ROWS = 1 << 19
#: Up to so many documents are fetched by their ids, which the scan can skip by; more are joined.
LOOKUP = 1000
#: Levels lie at this part of where the cut ones add up to the floor: more blocks are read, bounds are closer.
DEPTH = 0.25
#: Scores are compared after rounding to ``digits`` decimals: bounds give way by this much.
SLACK = 2e-9


def tasks_for(rows: int | None) -> int:
    return max(1, -(-(rows or 0) // TASK_ROWS))


def posting_blocks(entries: DataFrame, block: int = BLOCK, tasks: int | None = None) -> DataFrame:
    """``(idx, top, n, ids, weights)`` of ``entries(idx, doc_id, w)``: runs of a
    word's documents by falling weight, ``top`` the first one's. Dealt out by
    range, so that a frequent word's list lies in several tasks; ``tasks``: in
    how many ranges, where the caller knows."""
    order = [F.col("idx"), F.col("w").desc(), F.col("doc_id")]
    dealt = entries.select("idx", "doc_id", "w").repartitionByRange(*([tasks] if tasks else []), *order).sortWithinPartitions(*order)
    id_type = dict(entries.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            word = b.column(0).to_numpy(zero_copy_only=False)
            if not len(word):
                continue
            new = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            run_of = np.repeat(new, np.diff(np.append(new, len(word))))
            starts = np.flatnonzero((np.arange(len(word)) - run_of) % block == 0)
            ends = pa.array(np.append(starts, len(word)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(starts)), b.column(2).take(pa.array(starts)), pa.array(np.diff(ends.to_numpy())),
                 pa.ListArray.from_arrays(ends, b.column(1)), pa.ListArray.from_arrays(ends, b.column(2))],
                names=["idx", "top", "n", "ids", "weights"])

    return dealt.mapInArrow(run, f"idx int, top double, n int, ids array<{id_type}>, weights array<double>")


@dataclass
class TextIndex:
    """A kept index: its folder, and the vocabulary it was built with."""

    spark: SparkSession
    path: str
    vocab: Vocabulary

    @staticmethod
    def build(docs: DataFrame, path: str, dim: int = 2000, rule: str = RULE_NOT_ALL, id_col: str = "doc_id",
              text_col: str = "text", block: int = BLOCK) -> TextIndex:
        """Index ``docs`` under the folder ``path``."""
        spark = docs.sparkSession
        rows = docs.where(F.col(id_col).isNotNull()).select(
            F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), snippet(text_col).alias("snippet"))
        tokens = pin(tokenised(rows, keep=["snippet"]))
        vocab = fit_vocabulary(tokens, dim, rule=rule)
        vocab.save(f"{path}/vocabulary")
        vectors = features(tokens, vocab, keep=["snippet"])
        vectors.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.parquet(f"{path}/documents")
        made = TextIndex(spark, path, vocab)
        entry = F.explode(F.arrays_zip("i", "v")).alias("e")
        entries = made.documents().select("doc_id", entry).select(F.col("e.i").alias("idx"), "doc_id", F.col("e.v").alias("w"))
        n = made.documents().agg(F.sum(F.size("i")).alias("n")).first()["n"]
        # small pages and row groups: a lookup reads those of its words
        posting_blocks(entries.where("w > 0"), block, tasks_for(n)).write.option("parquet.page.size", str(64 << 10)).option(
            "parquet.block.size", str(8 << 20)).parquet(f"{path}/postings")
        heads = made.postings().groupBy("idx").agg(F.max_by(F.struct("top", "ids", "weights"), "top").alias("h"))
        heads.select("idx", "h.*").write.parquet(f"{path}/heads")        # a block for each word at most
        return made

    @staticmethod
    def open(spark: SparkSession, path: str, dim: int = 2000) -> TextIndex:
        return TextIndex(spark, path, Vocabulary.load(spark, f"{path}/vocabulary", dim))

    def documents(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/documents")

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    def heads(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/heads")

    # ------------------------------------------------------------- retrieval

    def query_vectors(self, queries: DataFrame) -> DataFrame:
        """``(query, qi, qv)`` of ``queries(query, text)``, pinned."""
        vectors = features(queries.select(F.col("query").alias("doc_id"), "text"), self.vocab)
        return pin(vectors.select(F.col("doc_id").alias("query"), F.col("i").alias("qi"), F.col("v").alias("qv")))

    def top_k(self, queries: DataFrame, k: int = 20, digits: int = 9) -> DataFrame:
        """``(query, rank, doc_id, score, snippet)``: the ``k`` best documents of
        each row of ``queries(query, text)``, best first."""
        vectors = self.query_vectors(queries)
        entry = F.explode(F.arrays_zip("qi", "qv")).alias("e")
        terms = pin(vectors.select("query", entry).select("query", F.col("e.qi").alias("idx"), F.col("e.qv").alias("q")).where("q > 0"))
        floors = self._floors(terms, vectors, k)
        levels = pin(self._levels(terms, floors))
        found = self._candidates(levels, k)
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("doc_id"))
        scored = self._scored(found, vectors).withColumn("score", F.round("score", digits))
        hits = pin(scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
        return self._filled(vectors.select("query"), hits, k)

    def _floors(self, terms: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
        """``(query, floor)``: the k-th best full score among the seeds, less
        the slack; no row for queries with fewer seeds."""
        seeds = terms.join(self.heads(), "idx").select("query", "q", F.explode(F.arrays_zip("ids", "weights")).alias("e"))
        seeds = seeds.groupBy("query", F.col("e.ids").alias("doc_id")).agg(F.sum(F.col("q") * F.col("e.weights")).alias("part"))
        best = Window.partitionBy("query").orderBy(F.desc("part"), F.asc("doc_id"))
        seeds = seeds.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).select("query", "doc_id")
        full = self._scored(seeds, vectors)
        return full.groupBy("query").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(
            F.col("n") >= k).select("query", (F.col("floor") - F.lit(SLACK)).alias("floor"))

    def _levels(self, terms: DataFrame, floors: DataFrame) -> DataFrame:
        """Adds to each query word ``floor``, ``cut`` (what an unread block can
        still add), ``cuts`` (their sum over the query) and ``least``, the
        weight that a block must reach to be read; null: none of the word's
        blocks. The level fills up like water: words below it count in full,
        the others share what is left of the floor."""
        u = terms.join(self.heads().select("idx", "top"), "idx").join(floors, "query", "left").withColumn(
            "floor", F.coalesce("floor", F.lit(0.0))).withColumn("u", F.col("q") * F.col("top"))
        up = Window.partitionBy("query").orderBy("u", "idx")
        every = Window.partitionBy("query")
        below = F.coalesce(F.sum("u").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        share = (F.col("floor") - below) / (F.count(F.lit(1)).over(every) - F.row_number().over(up) + 1)
        u = u.withColumn("share", F.greatest(share, F.lit(0.0)))
        fits = F.min(F.when(F.col("share") <= F.col("u"), F.struct("u", "idx", "share"))).over(every)
        u = u.withColumn("level", F.coalesce(fits["share"], F.col("u")) * DEPTH)
        u = u.withColumn("cut", F.least("u", "level"))
        return u.select("query", "idx", "q", "floor", "cut", F.sum("cut").over(every).alias("cuts"),
                        F.when(F.col("u") >= F.col("level"), F.col("level") / F.col("q")).alias("least"))

    def _candidates(self, levels: DataFrame, k: int) -> DataFrame:
        """``(query, doc_id)`` whose bound reaches the query's floor."""
        read = levels.where("least is not null")
        # what the scan can skip by: the words asked for (of at most dim) and the least weight of all
        asked = read.groupBy("idx").agg(F.min("least").alias("least")).collect()
        postings = self.postings().where(F.col("idx").isin([r["idx"] for r in asked])).where(
            F.col("top") >= F.lit(min([r["least"] for r in asked], default=0.0)))
        blocks = postings.join(read, "idx").where(F.col("top") >= F.col("least"))
        each = blocks.select("query", "floor", "cuts", "q", "cut", F.explode(F.arrays_zip("ids", "weights")).alias("e"))
        # as many tasks as the rows call for, dealt out before they are added up: hardly any two of a task's are of one pair
        each = each.select("query", F.col("e.ids").alias("doc_id"), "floor", "cuts", "cut", (F.col("q") * F.col("e.weights")).alias("w"))
        each = each.repartition(tasks_for(blocks.agg(F.sum("n").alias("n")).first()["n"]), "query", "doc_id")
        part, seen = F.sum("w"), F.sum("cut")
        sums = pin(each.groupBy("query", "doc_id").agg(
            part.alias("part"), (part - seen + F.first("cuts")).alias("bound"), F.first("floor").alias("floor")))
        # the k-th of the sums is a floor as well, as no score is below its sum
        best = Window.partitionBy("query").orderBy(F.desc("part"), F.asc("doc_id"))
        kth = sums.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("query").agg(
            F.min("part").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("query", "kth")
        floor = F.greatest(F.col("floor"), F.coalesce("kth", F.lit(0.0))) - F.lit(SLACK)
        return sums.join(kth, "query", "left").where(F.col("bound") >= floor).select("query", "doc_id")

    def _fetched(self, ids: DataFrame) -> DataFrame:
        """The documents of ``ids(doc_id)``, perhaps with others: few are looked
        up in the id-sorted table, many scan it."""
        wanted = [r["doc_id"] for r in ids.select("doc_id").distinct().limit(LOOKUP + 1).collect()]
        return self.documents().where(F.col("doc_id").isin(wanted)) if len(wanted) <= LOOKUP else self.documents()

    def _scored(self, pairs: DataFrame, vectors: DataFrame) -> DataFrame:
        """``(query, doc_id, snippet, score)``: the full dot products of
        ``pairs(query, doc_id)``."""
        dim = self.vocab.dim
        bound_batches(self.spark)
        pairs = pin(pairs)
        both = pairs.join(self._fetched(pairs), "doc_id").join(vectors, "query").select("query", "doc_id", "snippet", "i", "v", "qi", "qv")
        kinds = dict(both.dtypes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "i", ENTRIES):
                key, value = _by_row(b.column("i"), b.column("v"), dim)
                q_key, q_value = _by_row(b.column("qi"), b.column("qv"), dim)
                at = np.minimum(np.searchsorted(q_key, key), max(len(q_key) - 1, 0))
                both = (q_key[at] == key) if len(q_key) else np.zeros(len(key), bool)
                score = np.bincount(key[both] // dim, weights=value[both] * q_value[at[both]], minlength=b.num_rows) if both.any() else np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(score.astype(np.float64))], names=["query", "doc_id", "snippet", "score"])

        return both.mapInArrow(run, f"query {kinds['query']}, doc_id {kinds['doc_id']}, snippet string, score double")

    def _filled(self, queries: DataFrame, hits: DataFrame, k: int) -> DataFrame:
        """The hits, and where a query has fewer than k of positive score, the
        first ids of the others with score 0. Of any 2 k ids at most k are hits."""
        some = hits.where("score > 0").select("query", "rank", "doc_id", "score", "snippet")
        count = some.groupBy("query").agg(F.count(F.lit(1)).alias("n"))
        few = queries.join(count, "query", "left").select("query", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") < k)
        if not few.limit(1).count():
            return some
        ids = [r["doc_id"] for r in self.documents().select("doc_id").orderBy("doc_id").limit(2 * k).collect()]
        first = self.documents().where(F.col("doc_id").isin(ids)).select("doc_id", "snippet")
        spare = first.agg(F.collect_list(F.struct("doc_id", "snippet")).alias("spare"))        # one row of 2 k ids
        fill = few.join(F.broadcast(spare)).select("query", "n", F.explode("spare").alias("s")).select("query", "n", "s.doc_id", "s.snippet")
        fill = fill.join(some.select("query", "doc_id"), ["query", "doc_id"], "left_anti")
        after = Window.partitionBy("query").orderBy("doc_id")
        fill = fill.withColumn("rank", F.col("n").cast("int") + F.row_number().over(after)).where(F.col("rank") <= k).select(
            "query", "rank", "doc_id", F.lit(0.0).alias("score"), "snippet")
        return some.unionByName(fill)


def _by_row(idx: pa.ListArray, values: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys row * dim + idx of a batch's sparse vectors, and the values."""
    row = np.repeat(np.arange(len(idx), dtype=np.int64), np.diff(idx.offsets.to_numpy()))
    return row * dim + idx.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)
