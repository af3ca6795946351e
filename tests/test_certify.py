import numpy as np
import pytest

from quillspark.operators import metrics as mt
from quillspark.plans import catalog as c
from quillspark.plans import classify as cl
from quillspark.plans.certify import certificate

DIM = 5


def rows(n=150, seed=1):
    rng = np.random.default_rng(seed)
    w = rng.normal(size=DIM)
    out = []
    for _ in range(n):
        i = sorted(rng.choice(DIM, int(rng.integers(0, 4)), replace=False).tolist())
        x = np.zeros(DIM)
        x[i] = rng.normal(size=len(i))
        out.append((float(x @ w + rng.normal() > 0.3), [int(k) for k in i], x[i].tolist()))
    return out


def dense(data):
    X = np.zeros((len(data), DIM))
    for k, (_, i, v) in enumerate(data):
        X[k, i] = v
    return X, np.array([2 * r[0] - 1 for r in data])


def least(X, s, reg, steps=40_000):
    """An independent solver: averaged subgradient steps."""
    t, mean, best = np.zeros(DIM + 1), np.zeros(DIM + 1), np.inf
    X1 = np.column_stack([X, np.ones(len(X))])
    value = lambda t: np.maximum(0, 1 - s * (X1 @ t)).mean() + reg / 2 * t[:-1] @ t[:-1]
    for k in range(1, steps + 1):
        g = -((s * (s * (X1 @ t) < 1))[:, None] * X1).mean(0)
        g[:-1] += reg * t[:-1]
        t = t - g / (reg * (k + 10) + 0.02)
        mean += (t - mean) * 2 / (k + 1)
        if k % 500 == 0:
            best = min(best, value(mean))
    return best, value


@pytest.mark.parametrize("reg", [0.3, 0.05])
def test_the_bound_holds_and_is_close(spark, reg):
    data = rows()
    X, s = dense(data)
    feats = spark.createDataFrame(data, "label double, i array<int>, v array<double>").repartition(4).cache()
    best, value = least(X, s, reg)
    _, theta = cl.linear_svc(cl.sparse_vectors(feats, DIM, keep=("label",)), max_iter=200, reg_param=reg, standardize=False)
    fit = certificate(feats, theta, reg)
    assert fit.n == len(data) and fit.primal == pytest.approx(value(theta), rel=1e-9)
    assert fit.dual <= best + 1e-9 and fit.dual <= fit.primal       # no fit is below the bound
    assert fit.within(0.03) and fit.primal <= best * 1.005
    for bad in (np.zeros(DIM + 1), theta + 0.5, -theta):            # any other point's bound holds, and its gap shows
        other = certificate(feats, bad, reg)
        assert other.dual <= best + 1e-9 and other.primal == pytest.approx(value(bad), rel=1e-9)
        assert other.gap > 3 * fit.gap and not other.within(0.03)
    got = cl.evaluate(feats, theta, mt.LOGISTIC_THRESHOLD).first()
    p = np.column_stack([X, np.ones(len(X))]) @ theta >= 0.5
    assert (got.tp, got.fn, got.fp, got.tn) == tuple(int(x.sum()) for x in (p & (s > 0), ~p & (s > 0), p & (s < 0), ~p & (s < 0)))
    feats.unpersist()


def test_edges(spark):
    none = spark.createDataFrame([], "label double, i array<int>, v array<double>")
    assert not certificate(none, np.zeros(3), 0.1).within(1.0)
    one_class = spark.createDataFrame([(1.0, [0], [1.0])], "label double, i array<int>, v array<double>")
    assert certificate(one_class, np.array([0.0, 1.0]), 0.1).primal == 0.0
    with pytest.raises(ValueError):
        certificate(none, np.zeros(3), 0.0)


def test_registered(spark):
    got = {r.split: r for r in c.q_svc_certified(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {"train", "test"} and got["train"].certified is True and got["test"].certified is None
    counts = {r.split: r for r in c.QUERIES["linear_svc_tfidf"](spark, "/root/testdata/sf0.001").collect()}
    for split, r in got.items():
        assert (r.tp + r.fn, r.fp + r.tn) == (counts[split].positives, counts[split].negatives)
