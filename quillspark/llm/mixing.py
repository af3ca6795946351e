"""Mixing sources to target weights by Sainte-Lague apportionment. [native]

Sources get shares of all words by weight, held to ``MAX_REPEAT`` times their
own words. The shares are allocated in blocks of ``BLOCK`` words: first to
sources, then within each source to its groups of ``GROUP_SHARDS`` shards, then
within each group to its shards, each time to the highest quotients
``weight / (2 seats + 1)``. That gives every (source, shard) cell an integer
quota of blocks, and no ranking has more than a group's rows or a source's
groups. A cell is a seeded order of documents whose words are cut into
near-equal blocks; the quota takes every block ``quota / blocks`` times and, of
the rest, a seeded permutation's first ones once more. A quota beyond
``MAX_REPEAT`` times its cell's blocks is held to it: that is all the words the
cell may give.

Defined results. Null text has size 0, takes nothing and stays in the result.
Null source is a source of its own, after all others. Rows are dealt to shards
by id and text, so rows without an id, or that share one, go to many shards.
Documents of equal id and text (repeated rows) each count. An empty table gives
no rows. Extra columns are ignored by :func:`mix`, which keeps only the columns
it names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import SEED, cut, documents, seeded

BLOCK = 32          # words of a block
SHARD_DOCS = 256    # documents of a shard, over all sources
GROUP_SHARDS = 1024 # shards of a group
MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
WORD = r"[^\x20\x09-\x0D]+"
#: Prime above any number of blocks in a cell: stepping by it permutes them.
STEP = 2147483647


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to rows ``(source, source_size)``: the share of all words
    by weight, where nothing exceeds ``MAX_REPEAT`` times its source's words and
    the excess is shared again by weight. That fixed point is reached by filling
    sources in the order of ``cap / weight``: those below the level keep their
    cap, the others share what is left. One row per source."""
    # By code point is by UTF-8 bytes, Spark's order of strings; null comes last.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))
    rated = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (k + 1).cast("int")).cast("double"))
    rated = rated.withColumn("cap", (F.col("source_size") * MAX_REPEAT).cast("double"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything).cast("double")
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # The level a source would see if all before it were capped; capped ones come first.
    rated = rated.withColumn("level", left / weight_left)
    holds = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(holds, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rated.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))).drop("cap", "level", "weight")


def sainte_lague(df: DataFrame, group: list[str], key: list[str], weight: str, seats: str) -> DataFrame:
    """Adds ``quota``: the ``seats`` of a group (a column, the same for all its
    rows) go one by one to the row with the highest ``weight / (2 quota + 1)``,
    ties to the smaller key. Rounding ``weight * seats / total`` gives all but a
    few seats; only the quotients next to that are listed and ranked, and no
    row can gain or lose more of them than are listed."""
    g = Window.partitionBy(*[F.col(c) for c in group]) if group else Window.partitionBy(F.lit(0))
    w = F.col(weight).cast("double")
    a = df.withColumn("_total", F.sum(w).over(g)).withColumn("_n", F.count(F.lit(1)).over(g))
    a = a.withColumn("_quota", F.when(F.col("_total") > 0, F.floor(w * F.col(seats) / F.col("_total") + 0.5)).otherwise(0).cast("long"))
    a = a.withColumn("_diff", F.when(F.col("_total") > 0, F.col(seats) - F.sum("_quota").over(g)).otherwise(0).cast("long"))
    most = (F.ceil(w / F.col("_total") * (F.abs("_diff") + F.col("_n"))) + 1).cast("long")
    many = F.least(most, F.abs("_diff"), F.when(F.col("_diff") < 0, F.col("_quota")).otherwise(most))
    row = [F.col(c) for c in dict.fromkeys([*group, *key])]
    near = a.where((F.col("_diff") != 0) & (many > 0) & (w > 0)).select(
        *row, w.alias("_w"), "_quota", "_diff", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("_j"))
    more = F.col("_diff") > 0
    quotient = F.when(more, F.col("_w") / (2 * (F.col("_quota") + F.col("_j")) + 1)).otherwise(
        -F.col("_w") / (2 * (F.col("_quota") - F.col("_j")) - 1))
    order = Window.partitionBy(*[F.col(c) for c in group] or [F.lit(0)]).orderBy(
        F.col("_quotient").desc(), *[F.col(c).asc_nulls_last() for c in key], F.col("_j"))
    step = near.withColumn("_quotient", quotient).withColumn("_rank", F.row_number().over(order))
    step = step.where(F.col("_rank") <= F.abs("_diff")).groupBy(*row).agg(
        F.sum(F.signum(F.col("_diff")).cast("long")).alias("_change"))
    keys = list(dict.fromkeys([*group, *key]))
    step = step.select(*[F.col(c).alias(f"_of_{c}") for c in keys], "_change")
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return a.join(step, on, "left").select(
        *df.columns, (F.col("_quota") + F.coalesce("_change", F.lit(0).cast("long"))).alias("quota"))


def mix(docs: DataFrame, block: int = BLOCK, shard_docs: int = SHARD_DOCS, seed: int = SEED, shards_too: bool = False,
        group_shards: int = GROUP_SHARDS) -> DataFrame:
    """Rows ``(doc_id, size, source, source_size, target, taken)``, one per row
    of ``docs(doc_id, text, source)``: ``taken`` words of the mix come from it.
    With ``shards_too``, also the ``shard``."""
    sized = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), seeded(seed, "doc_id", "text").alias("_row")))
    shards = max(1, -(-sized.count() // shard_docs))
    sized = sized.withColumn("shard", F.pmod("_row", F.lit(shards)))
    cells = cut(sized.groupBy("source", "shard").agg(F.sum("size").alias("cell_size")))
    sources = capped_targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")))
    sources = sources.withColumn("_seats", F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block).cast("long"))
    sources = sainte_lague(sources, [], ["source"], "target", "_seats").select(
        F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("_source_quota"))
    sources = cut(sources)
    cells = cells.withColumn("_group", F.floor(F.col("shard") / group_shards).cast("long"))
    groups = cells.groupBy("source", "_group").agg(F.sum("cell_size").alias("_group_size"))
    groups = groups.join(F.broadcast(sources) if _small(sources) else sources, F.col("source").eqNullSafe(F.col("_source")))
    groups = cut(sainte_lague(groups, ["source"], ["_group"], "_group_size", "_source_quota").select(
        "_source", F.col("_group").alias("_of_group"), "source_size", "target", F.col("quota").alias("_group_quota")))
    cell = cells.join(F.broadcast(groups) if _small(groups) else groups.hint("merge"),
                      F.col("source").eqNullSafe(F.col("_source")) & (F.col("_group") == F.col("_of_group")))
    cell = sainte_lague(cell, ["source", "_group"], ["shard"], "cell_size", "_group_quota")
    blocks = F.greatest(F.lit(1).cast("long"), F.round(F.col("cell_size") / block).cast("long"))
    cell = cell.withColumn("blocks", F.when(F.col("cell_size") > 0, blocks).otherwise(0))
    cell = cut(cell.select(_cell().alias("_of_cell"), "source_size", "target", "cell_size", "blocks",
                           F.least("quota", F.col("blocks") * MAX_REPEAT).alias("quota")))
    # Documents of a cell in a seeded order; the cell's words in that order are its stream.
    in_cell = Window.partitionBy("_cell").orderBy(seeded(seed + 1, "_row"), "doc_id", "size")
    stream = sized.withColumn("_cell", _cell()).withColumn("_end", F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, 0)))
    at = stream.join(cell.hint("merge"), F.col("_cell") == F.col("_of_cell"))    # one cell for some 256 documents: they grow with them
    n, quota, size = F.col("blocks"), F.col("quota"), F.col("cell_size")
    start, end = F.col("_end") - F.col("size"), F.col("_end")
    first = F.floor(start * n / size).cast("long")
    last = F.least(n - 1, F.floor((end - 1) * n / size).cast("long") + 1)
    edge = lambda b: F.ceil(b * size / n).cast("long")  # noqa: E731  first word of block b
    rank = lambda b: F.pmod(b * F.lit(STEP) + F.pmod(seeded(seed + 2, F.col("shard"), F.col("source")), n), n)
    overlap = lambda b: F.greatest(F.lit(0).cast("long"), F.least(end, edge(b + 1)) - F.greatest(start, edge(b)))
    once_more = F.aggregate(
        F.sequence(F.greatest(F.lit(0).cast("long"), first - 1), last), F.lit(0).cast("long"),
        lambda acc, b: acc + F.when(rank(b) < quota % n, overlap(b)).otherwise(0))
    taken = F.when(F.col("size") > 0, F.floor(quota / n) * F.col("size") + F.when(quota % n > 0, once_more).otherwise(0)).otherwise(0)
    return at.select("doc_id", "size", "source", "source_size", "target", taken.cast("long").alias("taken"), *(["shard"] if shards_too else []))


def whole_copies(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """``(doc_id, copies)`` for each row of ``mixed(doc_id, size, source, taken,
    shard)``: whole copies that add up to the words taken from its (source,
    shard) cell. A document is copied ``taken / size`` times, rounded down, and
    once more where the running sum of the parts left over, along the cell,
    passes a whole number. The order is by size, so that those copied once more
    are spread evenly over long and short ones and their words come to the sum
    of the parts. The sums of a source's shards start at places that are spread
    evenly too (steps of the golden section from a seeded one), so that what a
    cell has too much of its longest document, another has too little."""
    one = 1 << 20                                    # parts are whole numbers of this unit: sums are exact
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0).cast("long"))
    part = F.when(F.col("size") > 0, F.floor((F.col("taken") % F.col("size")) * one / F.col("size"))).otherwise(0).cast("long")
    step = round(one * (5 ** 0.5 - 1) / 2)
    start = F.pmod(F.pmod(seeded(seed + 3, "source"), F.lit(one)) + F.col("shard") * step, F.lit(one))
    along = Window.partitionBy("source", "shard").orderBy(F.col("size").desc(), F.col("doc_id").asc_nulls_last(), F.col("taken"))
    rows = mixed.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source", "taken", "shard", whole.alias("whole"), part.alias("part"), start.alias("start"))
    through = F.col("start") + F.sum("part").over(along.rowsBetween(Window.unboundedPreceding, 0))
    more = F.floor(through / one) - F.floor((through - F.col("part")) / one)
    return rows.select("doc_id", (F.col("whole") + more).cast("int").alias("copies"))


def _cell() -> Column:
    """Names a (source, shard) cell; structs with a null source are equal too, so
    rows ranked within cells meet their cell without another shuffle."""
    return F.struct("source", "shard")


def _small(df: DataFrame, most: int = 100_000) -> bool:
    """Whether a frame that is already written has at most so many rows."""
    return df.count() <= most


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir, "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")
