import pytest

import __spark_entry__ as se
from oracle_check import check, duck
from quillspark.plans.catalog import QUERIES
from quillspark.plans.oracle import ORACLES

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == ["rank", "doc_id", "score", "snippet"]
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [(-r.score, r.doc_id) for r in rows] == sorted((-r.score, r.doc_id) for r in rows)


def test_registry_consistent():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    # every query of the core has its SQL, but for a trained library model's scores (tests/test_certify.py)
    assert set(QUERIES) - set(ORACLES) == {"svc_certified"} and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in ORACLES if not n.endswith("_full")])
def test_oracle_small(spark, name):
    res = check(spark, duck(SMALL), SMALL, name, QUERIES[name], ORACLES[name])
    assert res["status"].startswith("MATCH"), res


def test_early_stop_matches_sql(spark):
    """Force the stop rules to fire (a high rate floor) and compare the
    driver loops with the unrolled SQL at the smallest scale."""
    from quillspark.functions.columns import sig_round
    from quillspark.plans import catalog as c
    from quillspark.plans import classify as cl
    from quillspark.plans import oracle as o

    con = duck(SMALL)

    def rows(df):
        return sorted(tuple(r) for r in df.select(
            "step", sig_round("loss", 9).alias("loss"),
            sig_round("learning_rate", 9).alias("learning_rate")).collect())

    vocab, feats = c.model_inputs(spark, SMALL, "forced")
    fit = cl.train_logistic(c.train_part(feats), vocab.size() + 1, max_iter=5, min_rate=0.2)
    assert len(fit.trace) == 2                       # initial row + the step that stopped
    sql = con.execute(o._logistic_trace_sql(5, min_rate=0.2)).fetchall()
    assert rows(fit.trace_frame(spark)) == sorted(sql)

    vocab, feats = c.model_inputs(spark, SMALL, "max_df")
    fit = cl.train_hinge(c.train_part(feats), vocab.size() + 1, c.DIM, max_iter=5, min_rate=0.0105)
    assert len(fit.trace) == 1
    sql = con.execute(o._hinge_trace_sql("hinge", 5, min_rate=0.0105)).fetchall()
    assert rows(fit.trace_frame(spark)) == sorted(sql)
