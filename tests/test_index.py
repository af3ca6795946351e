import math
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import index as ix
from quillspark.operators import text as tx


def corpus(seed=4, docs=400):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(60)]
    p = 1 / np.arange(1, 61) ** 0.8
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 40)), p=p / p.sum())) for _ in range(docs)]
    texts += ["w7", "w7", "", "zz zz", texts[3], "w1 " * 300 + "w59"]
    return texts


def best(texts, query, words, idf, k):
    """Every document scored by plain counting."""
    q = Counter(query.split(" "))
    n_q = len(query.split(" "))
    scores = []
    for d, t in texts:
        c, n = Counter(t.split(" ")), len(t.split(" "))
        scores.append((-round(sum(c[w] / n * idf[w] * q[w] / n_q * idf[w] for w in words if c[w] and q[w]), 9), d))
    return [(r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]


QUERIES = {0: "w1 w2 w2 w30 nope", 1: "w59", 2: "nothing known", 3: "", 4: " ".join(f"w{k}" for k in range(60)), 5: "w7 w7 w7", 6: "w40 w41 w42 w55"}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    texts = list(enumerate(corpus()))
    docs = spark.createDataFrame([*texts, (900, None), (None, "w1 w2")], "doc_id long, text string").repartition(5)
    return texts, ix.TextIndex.build(docs, str(tmp_path_factory.mktemp("index") / "kept"), 40, block=16)


def weights(index):
    return {r.word: r.idf for r in index.vocab.table.collect()}


@pytest.mark.parametrize("k", [1, 20, 600])
def test_top_k_is_that_of_all_scores(spark, index, k):
    texts, made = index
    idf = weights(made)
    queries = spark.createDataFrame([*QUERIES.items(), (7, None)], "query long, text string").repartition(3)
    got = {}
    for r in made.top_k(queries, k).collect():
        got.setdefault(r.query, []).append((r["rank"], r.doc_id, r.score))
        assert r.snippet == dict(texts)[r.doc_id][:200]
    assert set(got) == set(QUERIES)                      # a query without a text has no hits
    for q, text in QUERIES.items():
        want = best(texts, text, idf, idf, k)
        assert sorted((r, d) for r, d, _ in got[q]) == [(r, d) for r, d, _ in want], q
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([s for _, _, s in want], abs=2e-9)


def test_a_kept_index_is_opened(spark, index):
    _, made = index
    again = ix.TextIndex.open(spark, made.path, 40)
    queries = spark.createDataFrame(list(QUERIES.items()), "query long, text string")
    assert sorted(again.top_k(queries, 5).collect()) == sorted(made.top_k(queries, 5).collect())


def test_postings_are_blocks_by_falling_weight(index):
    texts, made = index
    seen = Counter()
    for r in made.postings().collect():
        assert r.n == len(r.ids) == len(r.weights) <= 16 and r.top == r.weights[0]
        assert r.weights == sorted(r.weights, reverse=True)
        seen[r.idx] += r.n
    df = {r.idx: r.df for r in made.vocab.table.collect()}
    assert seen == {i: n for i, n in df.items()}
    heads = {r.idx: r.top for r in made.heads().collect()}
    assert heads == {i: max(r.top for r in made.postings().collect() if r.idx == i) for i in df}


def test_scans_are_bounded(spark, index, monkeypatch):
    """The postings' scan gets the words and the least weight; documents are
    looked up by id; candidates are fewer than documents."""
    _, made = index
    read = {}
    monkeypatch.setattr(ix.TextIndex, "_candidates", lambda self, levels, k, f=ix.TextIndex._candidates: read.setdefault("candidates", f(self, levels, k)))
    monkeypatch.setattr(ix, "pin", lambda df, f=ix.pin: (read.setdefault("plans", []).append(df._jdf.queryExecution().executedPlan().toString()), f(df))[1])
    made.top_k(spark.createDataFrame([(0, "w7 w40")], "query long, text string"), 3).collect()
    plan = next(p for p in read["plans"] if "GreaterThanOrEqual(top" in p)
    assert "In(idx, [" in plan
    assert read["candidates"].count() < made.documents().count() / 4


def test_a_frequent_words_list_lies_in_several_tasks(spark):
    entries = spark.range(5000).select(F.lit(3).alias("idx"), F.col("id").alias("doc_id"), (F.col("id") % 997 / 1000.0).alias("w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    blocks = ix.posting_blocks(entries.repartition(6), 64)
    parts = blocks.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n").alias("n"))
    try:
        with_rows = [r.n for r in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(with_rows) == 5000 and max(with_rows) < 5000 / 2


def test_empty_corpus(spark, tmpdir_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    made = ix.TextIndex.build(none, os.path.join(tmpdir_path, "none"), 10)
    assert made.top_k(spark.createDataFrame([(1, "a b")], "query long, text string"), 3).collect() == []
    assert math.isclose(tx.fit_vocabulary(none, 10).size(), 0)


def test_pairs_are_added_up_in_tasks_of_bounded_rows(spark, tmpdir_path, monkeypatch):
    """More rows give more tasks, not larger ones (before, the tasks' number didn't follow the rows)."""
    docs = spark.createDataFrame([(k, " ".join(f"w{(k * j) % 29}" for j in range(1 + k % 19))) for k in range(400)], "doc_id long, text string")
    queries = spark.createDataFrame([(q, " ".join(f"w{(q * j) % 29}" for j in range(9))) for q in range(12)], "query long, text string")
    want = sorted(map(tuple, ix.TextIndex.build(docs, f"{tmpdir_path}/one", 25).top_k(queries, 7).collect()))
    monkeypatch.setattr(ix, "TASK_ROWS", 50)
    pinned, pin = [], ix.pin
    monkeypatch.setattr(ix, "pin", lambda df: pinned.append(pin(df)) or pinned[-1])
    index = ix.TextIndex.build(docs, f"{tmpdir_path}/two", 25)
    assert sorted(map(tuple, index.top_k(queries, 7).collect())) == want
    entries = index.postings().agg(F.sum("n")).first()[0]
    parts = index.postings().count() and len({r.file for r in index.postings().select(F.input_file_name().alias("file")).distinct().collect()})
    assert parts >= entries // 50 // 2
    sums = next(p for p in pinned if "bound" in p.columns)
    assert sums.rdd.getNumPartitions() >= sums.count() // 50
