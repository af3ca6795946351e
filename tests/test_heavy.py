from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.operators import heavy as hv
from quillspark.operators import merge as mg
from quillspark.operators import text as tx


def texts(seed=2, n=300):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, 401) ** 1.1
    out = [" ".join(f"w{k}" for k in rng.choice(400, int(rng.integers(1, 30)), p=p / p.sum())) + " all" for _ in range(n)]
    return [*out, "all", "all  court", out[0]]


@pytest.fixture(scope="module")
def tokens(spark):
    docs = spark.createDataFrame([*enumerate(texts()), (999, None)], "doc_id long, text string").repartition(13)
    return tx.tokenised(docs).cache()


RULES = [tx.RULE_NOT_ALL, tx.RULE_FORCED, tx.RULE_MAX_DF]


@pytest.mark.parametrize("rule", RULES)
def test_same_rows_as_by_counting_all(tokens, rule):
    for dim, size, fan, proven in ((20, 200, 3, True), (20, 5000, 32, True), (2000, 5000, 2, True), (300, 40, 3, False), (30, 2, 3, False)):
        vocab, proof = hv.fit_vocabulary(tokens, dim, rule=rule, forced_words=["all", "w399"], size=size, fan=fan)
        want = tx.fit_vocabulary(tokens, dim, rule=rule, forced_words=["all", "w399"])
        assert sorted(vocab.table.collect()) == sorted(want.table.collect())
        assert proof.proven == proven and proof.candidates <= size, (proof, dim, size)
        assert proof.error == 0 or proof.least > proof.error or not proven


def test_the_fallback_counts_all_words(tokens, monkeypatch):
    """Where the proof fails, the candidates alone would give other words."""
    called = []
    fit = tx.fit_vocabulary
    monkeypatch.setattr(tx, "fit_vocabulary", lambda *a, **b: called.append(1) or fit(*a, **b))
    vocab, proof = hv.fit_vocabulary(tokens, 150, size=60, fan=3)
    assert not proof.proven and called == [1] and proof.least <= proof.error and proof.candidates < 150
    assert vocab.size() == 150
    hv.fit_vocabulary(tokens, 10, size=200, fan=3)
    assert called == [1]


def test_rows_of_the_shuffle_are_summaries(tokens):
    """A row per task and level, none longer than the summary's size."""
    size = 25
    parts = hv.summaries(tokens, size)
    rows = parts.collect()
    assert len(rows) == tokens.rdd.getNumPartitions() and all(len(r.words) <= size for r in rows)
    left = mg.merged_rows(parts, lambda t: hv.add_summaries(t, size), fan=3).collect()
    assert len(left) <= 3 and all(len(r.words) == len(r.counts) <= size for r in left)


def test_counters_bound_the_counts(tokens):
    true = Counter(w for t in texts() for w in set(t.split(" ")))
    for size in (3, 30, 100, 1000):
        words, counts, error = hv.summary(tokens, size, fan=4)
        got = dict(zip(words.to_pylist(), counts.tolist()))
        assert all(got.get(w, 0) <= n <= got.get(w, 0) + error for w, n in true.items()), size
        exact = hv.exact_counts(tokens, words, fan=4)
        assert exact.tolist() == [*[true[w] for w in words.to_pylist()], len(texts())]
    assert error == 0 and len(got) == len(true)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefghijkl"), max_size=30), max_size=6), st.integers(1, 8))
def test_summaries_add_up(groups, size):
    rows = []
    for g in groups:
        c = Counter(g)
        rows.append(hv._packed(*hv.cut_down(pa.array(list(c), pa.string()), np.array(list(c.values()), np.int64), 0, size)))
    if not rows:
        return
    table = pa.concat_tables(pa.table(r, ["words", "counts", "error"]) for r in rows)
    one = hv.add_summaries(table, size)
    got = dict(zip(one.column("words")[0].as_py(), one.column("counts")[0].as_py()))
    error = one.column("error")[0].as_py()
    true = Counter(w for g in groups for w in g)
    assert len(got) <= size and all(got.get(w, 0) <= n <= got.get(w, 0) + error for w, n in true.items())
    assert error * (size + 1) <= sum(true.values())       # the known bound of such summaries


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    vocab, proof = hv.fit_vocabulary(none, 5)
    assert vocab.size() == 0 and proof.proven
