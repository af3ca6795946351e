import os

import numpy as np
import pyarrow as pa
import pytest

from quillspark.operators import gradient as gr
from quillspark.operators import merge as mg
from quillspark.plans import classify as cl
from quillspark.plans.state import StateMismatch, Step, StepLog


def sparse_rows(spark, rows=120, dim=9, seed=3):
    rng = np.random.default_rng(seed)
    data = []
    for k in range(rows):
        i = sorted(int(x) for x in rng.choice(dim, int(rng.integers(0, 5)), replace=False))
        data.append((float(k % 3 == 0), i, [float(x) for x in rng.normal(size=len(i))]))
    return spark.createDataFrame(data, "label double, i array<int>, v array<double>")


def test_levels():
    assert [mg.levels(n, 4) for n in (0, 1, 4, 5, 16, 17, 64, 65)] == [0, 0, 0, 1, 1, 2, 2, 3]


def test_merged_in_levels(spark):
    """The same sums however many levels there are; a level's task reads ``fan`` rows."""
    feats = sparse_rows(spark).repartition(23).cache()
    theta = np.linspace(-1, 1, 10)
    parts = gr.partial_sums(feats, theta)
    assert parts.count() == 23
    whole = np.sum([r.g for r in parts.collect()], axis=0)
    sizes = spark.sparkContext.accumulator(0)

    def add_up(rows):
        assert 1 <= rows.num_rows <= 3
        sizes.add(1)
        return gr.add_up(rows)

    left = mg.merged_rows(parts, add_up, fan=3)
    assert left.count() <= 3 and sizes.value == 8 + 3
    for fan in (2, 3, 32):
        got = mg.merged(parts, gr.add_up, fan=fan)
        assert np.allclose(got.column("g")[0].as_py(), whole, rtol=1e-12)
        again = mg.merged(parts, gr.add_up, fan=fan)
        assert got.equals(again)                                   # bit for bit
    feats.unpersist()


def test_no_shuffle_for_few_tasks(spark):
    parts = gr.partial_sums(sparse_rows(spark).coalesce(2), np.zeros(10))
    assert "Exchange" not in mg.merged_rows(parts, gr.add_up)._jdf.queryExecution().toString()


def test_gradient_of_no_rows(spark):
    g, loss, n = gr.gradient_and_loss(sparse_rows(spark).where("label > 5"), np.full(10, 0.1))
    assert not g.any() and (loss, n) == (0.0, 0)


@pytest.mark.parametrize("kind", ["logistic", "hinge", "weighted", "observed"])
@pytest.mark.parametrize("broken_after", [1, 7])
def test_a_broken_run_goes_on(spark, tmpdir_path, kind, broken_after, monkeypatch):
    feats = sparse_rows(spark).repartition(3).cache()

    def train(log=None):
        if kind == "logistic":
            return cl.train_logistic(feats, 10, log=log)
        shares = {1.0: 0.3, 0.0: 0.7} if kind == "weighted" else None
        return cl.train_hinge(feats, 10, 9, "observed" if kind == "observed" else "exact", shares=shares, log=log)

    log = StepLog(spark, os.path.join(tmpdir_path, "run"), {"kind": kind})
    unbroken = train()
    save = StepLog.save

    class Lost(Exception):
        pass

    def dies(self, state, *more):
        save(self, state, *more)
        if state.step == broken_after:
            raise Lost

    monkeypatch.setattr(StepLog, "save", dies)
    with pytest.raises(Lost):
        train(log)
    monkeypatch.setattr(StepLog, "save", save)
    os.makedirs(os.path.join(tmpdir_path, "run", f"step={broken_after + 1}", "_temporary"))     # a write that didn't end
    resumed = train(StepLog(spark, os.path.join(tmpdir_path, "run"), {"kind": kind}))
    assert resumed.trace == unbroken.trace and np.array_equal(resumed.theta, unbroken.theta)
    # a run that is over starts nothing again
    monkeypatch.setattr(cl, "gradient_and_loss", None)
    whole = train(StepLog(spark, os.path.join(tmpdir_path, "run"), {"kind": kind}))
    assert whole.trace == unbroken.trace
    feats.unpersist()


def test_another_configuration_is_refused(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "run")
    log = StepLog(spark, path, {"kind": "logistic", "p": 10})
    assert log.last() is None
    log.save(Step(0, np.zeros(3), np.ones(3), float("nan"), 0.1, {"s": 0.25}), 1.5, 0.1)
    back = log.last()
    assert back.step == 0 and np.isnan(back.loss) and back.rule == {"s": 0.25} and back.theta_old.tolist() == [1, 1, 1]
    assert log.trace(0) == [(0, 1.5, 0.1)] and log.trace(-1) == []
    with pytest.raises(StateMismatch):
        StepLog(spark, path, {"kind": "logistic", "p": 11}).last()


def test_arrow_rows_in_the_order_of_their_tasks():
    rows = pa.table([pa.array([[1.0, 2.0], [3.0, 4.0]])], ["g"])
    assert gr.add_up(rows).column("g").to_pylist() == [[4.0, 6.0]]
