import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import gradient as gr
from quillspark.operators import metrics as mt
from quillspark.operators import profile as pf
from quillspark.plans import classify as cl
from quillspark.plans import descent as ds

P = 6  # 5 features + bias
SHARES = {1.0: 0.25, 0.0: 0.75}


def sparse_rows(seed=0, n=40):
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(n):
        k = int(rng.integers(0, 4))
        idx = sorted(rng.choice(P - 1, size=k, replace=False).tolist())
        vals = rng.uniform(0, 1, k).round(3).tolist()
        rows.append((d, float(d % 3 == 0), idx, vals, 0.25 if d % 3 == 0 else 0.75))
    return rows


def feats(spark, seed=0, parts=3):
    return spark.createDataFrame(sparse_rows(seed),
                                 "doc_id long, label double, i array<int>, v array<double>, share double"
                                 ).repartition(parts)


def dense(rows):
    X = np.zeros((len(rows), P))
    for r, (_, _, idx, vals, _) in enumerate(rows):
        X[r, idx] = vals
        X[r, -1] = 1.0
    y = np.array([r[1] for r in rows])
    w = np.array([r[4] for r in rows])
    return X, y, w


def brute(kind, variant, theta, rows):
    X, y, w = dense(rows)
    m = X @ theta
    if kind == "logistic":
        h = 1 / (1 + np.exp(-m))
        loss = -y * np.log(h) - (1 - y) * np.log(1 - h)
        g = ((h - y)[:, None] * X).sum(0) if variant == "exact" else (h[:, None] - X * y[:, None]).sum(0)
    else:
        s = 2 * y - 1
        loss = np.maximum(0, 1 - s * m)
        act = (s * m < 1) if variant == "exact" else (m < 1)
        c = np.where(act, -s, 0.0)
        if kind == "weighted_hinge":
            loss, c = loss / w, c / w
        g = (c[:, None] * X).sum(0)
    return g, loss.sum()


@pytest.mark.parametrize("kind", ["logistic", "hinge", "weighted_hinge"])
@pytest.mark.parametrize("variant", ["exact", "observed"])
def test_arrow_gradient_matches_dense(spark, kind, variant):
    theta = np.linspace(-0.5, 0.7, P)
    rows = sparse_rows()
    g, lsum, n = gr.gradient_and_loss(feats(spark), theta, kind, variant,
                                      shares=SHARES if kind == "weighted_hinge" else None)
    gb, lb = brute(kind, variant, theta, rows)
    assert n == len(rows)
    assert np.allclose(g, gb, atol=1e-10) and lsum == pytest.approx(lb, rel=1e-12)


def test_logistic_gradient_is_numeric_derivative(spark):
    theta = np.linspace(-0.3, 0.4, P)
    rows = sparse_rows(2)
    f = feats(spark, 2)
    g, _, _ = gr.gradient_and_loss(f, theta, "logistic", "exact")
    eps = 1e-6
    for j in range(P):
        e = np.zeros(P)
        e[j] = eps
        num = (brute("logistic", "exact", theta + e, rows)[1]
               - brute("logistic", "exact", theta - e, rows)[1]) / (2 * eps)
        assert g[j] == pytest.approx(num, rel=1e-5, abs=1e-7)


def test_column_form_loss_matches(spark):
    theta = np.linspace(-0.5, 0.7, P)
    m = mt.with_margin(feats(spark), theta)
    got = m.agg(F.sum(gr.loss_col("logistic", F.col("margin"), F.col("label")))).first()[0]
    assert got == pytest.approx(brute("logistic", "exact", theta, sparse_rows())[1], rel=1e-12)


def test_confusion_and_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)],
                               "label double, prediction double")
    r = mt.accuracy_f1(mt.confusion(df)).first()
    assert (r.tp, r.fn, r.fp, r.tn) == (1, 1, 1, 2)
    assert r.tp + r.fn + r.fp + r.tn == 5
    assert r.accuracy == pytest.approx(3 / 5) and r.f1 == pytest.approx(2 / 4)
    none = spark.createDataFrame([(0.0, 0.0)], "label double, prediction double")
    assert mt.accuracy_f1(mt.confusion(none)).first().f1 is None
    assert mt.accuracy(df).first().accuracy == pytest.approx(3 / 5)


def test_split_weights_and_profile(spark):
    df = spark.createDataFrame([(i, float(i % 4 == 0)) for i in range(100)], "doc_id long, label double")
    tr, te = pf.stable_split(df)
    tr2, te2 = pf.stable_split(df.repartition(9))
    assert sorted(r.doc_id for r in te.collect()) == list(range(0, 100, 10))
    assert sorted(r.doc_id for r in te2.collect()) == list(range(0, 100, 10))
    assert pf.class_shares(df) == {1.0: 0.25, 0.0: 0.75}
    assert {r.label: (r.n, r.share) for r in pf.class_weights(df).collect()} == {1.0: (25, 0.25), 0.0: (75, 0.75)}
    for f in (pf.class_shares, pf.class_weights):
        with pytest.raises(ValueError):
            f(df.where("label = 0"))
    # ids that aren't numbers are hashed
    named = df.selectExpr("concat('d', doc_id) AS doc_id", "label")
    tests = [sorted(r.doc_id for r in pf.stable_split(d)[1].collect()) for d in (named, named.repartition(7))]
    assert tests[0] == tests[1] and 2 <= len(tests[0]) <= 25
    first = pf.first_per_class(df, 3).collect()
    assert sorted((r.label, r.doc_id) for r in first) == [
        (0.0, 1), (0.0, 2), (0.0, 3), (1.0, 0), (1.0, 4), (1.0, 8)]


def test_class_mean_tf_by_hand(spark):
    from quillspark.operators import text as tx
    docs = spark.createDataFrame(
        [(0, "and court x", 1.0), (1, "and and y z", 1.0), (2, "q w e", 0.0), (3, "court", 0.0),
         (4, "and", 1.0)], "doc_id long, text string, label double")
    vocab = tx.fit_vocabulary(docs, 50, rule=tx.RULE_FORCED)
    got = {(r.label, r.word): (r.avg_tf, r.n_docs)
           for r in pf.class_mean_tf(docs, vocab, n=2, words=["and", "court", "zzz"]).collect()}
    assert got[(1.0, "and")] == (pytest.approx((1 / 3 + 2 / 4) / 2), 2)
    assert got[(1.0, "court")] == (pytest.approx((1 / 3) / 2), 2)
    assert got[(0.0, "court")] == (pytest.approx(1 / 2), 2)
    assert got[(0.0, "zzz")] == (0.0, 2)


def test_step_rules():
    b = ds.BoldDriver(0.5, 1.05)
    assert b.next_rate(2.0, 1.0, 1.0) == 0.5 and b.next_rate(1.0, 1.0, 1.0) == 1.05
    s = ds.StopRule(1e-5, 3, 1e-5)
    assert [s.should_stop(l, 1.0, 1.0) for l in (0.5, 2.0, 0.9, 0.8)] == [False, False, False, True]


NAN = float("nan")


@pytest.mark.parametrize("loss, before, exact, observed, kept", [
    (1.0, NAN, 1.0, 1 / 0.1, True),       # the first step settles
    (1.2, 1.0, 0.5, 0.5, False),          # up by more than 5 %
    (1.0500001, 1.0, 0.5, 0.5, False),
    (1.05, 1.0, 0.75, 0.75, True),        # up by at most 5 %
    (1.0 + 1e-9, 1.0, 0.75, 0.75, True),
    (1.0, 1.0, 1.1, 1.1, True),           # equal
    (1.0 + 1e-15, 1.0, 1.1, 1.1, True),   # equal at 12 digits
    (0.9900001, 1.0, 1.1, 1.1, True),     # down by less than 1 %
    (0.98, 1.0, 1.0, 1 / 0.1, True),      # down further: settles
    (1.0, 0.0, 0.5, 0.5, False),          # from nothing
    (0.0, 0.0, 1.1, 1.1, True),
])
def test_adaptive_rate(loss, before, exact, observed, kept):
    g = np.ones(4)
    for variant, rate in (("exact", exact), ("observed", observed)):
        rule = ds.AdaptiveRate(dim=4, variant=variant)
        got = rule.update(g, 1.0, loss, before)
        assert got == (pytest.approx(rate, rel=1e-6), kept)
        assert rule.s == pytest.approx(0.1 if variant == "exact" else 0.0)
    assert ds.AdaptiveRate(dim=4, variant="exact", s=0.25).step_size(1.0) == pytest.approx(2.0)


def test_adaptive_rate_compounds():
    rule = ds.AdaptiveRate(dim=4, variant="observed")
    g, p0, rate = np.full(4, 2.0), 0.0, 1.0
    for loss, before in ((4.0, NAN), (3.0, 4.0), (2.0, 3.0)):
        p0 += 0.9 * p0 + 0.1 * 2.0 + 1e-8
        rate, _ = rule.update(g, rate, loss, before)
        assert rule.p0 == pytest.approx(p0)
    assert rate == pytest.approx(1 / 0.2 / 0.58 / (1.9 * 0.58 + 0.2), rel=1e-6)


def regression_frame(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 2)) * [2.0, 5.0] + [1.0, -3.0]
    y = 40.0 + X @ [0.7, -0.2] + rng.normal(size=300)
    return X, y, spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)], "x1 double, x2 double, y double")


def test_descent_in_data_units(spark):
    X, y, df = regression_frame(spark)
    mo = ds.moments(df, ["x1", "x2"], "y")
    mse = lambda slopes, const: np.mean((y - X @ slopes - const) ** 2)
    for variant, rate in (("exact", 0.1), ("observed", 0.0005)):
        for _, loss, _, theta in ds.descend_multi(mo, variant, rate=rate, max_iter=60):
            assert loss == pytest.approx(mse(theta[:2], theta[2]), rel=1e-8)
    one = ds.moments(df, ["x1"], "y")
    slope, const = np.polyfit(X[:, 0], y, 1)
    for variant, rate in (("exact", 0.1), ("observed", 1e-3)):
        rows = ds.descend_simple(one, variant, rate=rate)
        assert rows[0][3] == pytest.approx([slope, const], rel=1e-9)
        assert rows[0][1] == pytest.approx(np.mean((y - slope * X[:, 0] - const) ** 2), rel=1e-9)
        for _, loss, _, (m, b) in rows:
            assert loss == pytest.approx(np.mean((y - m * X[:, 0] - b) ** 2), rel=1e-6)
    last = ds.descend_simple(one, "exact", rate=0.1)[-1]
    assert last[3] == pytest.approx([slope, const], abs=1e-4)     # nears the closed form
    with pytest.raises(ValueError):
        ds.moments(df.selectExpr("1.0 AS x1", "y"), ["x1"], "y")


def test_observed_rules_as_written(spark):
    """Both observed traces against loops over the rows."""
    X, y, df = regression_frame(spark)
    m, b, rate = 0.1, 0.1, 1e-3
    rows = ds.descend_simple(ds.moments(df, ["x1"], "y"), "observed", rate=rate, max_iter=12)
    loss = np.mean((y - m * X[:, 0] - b) ** 2)
    for _, got, used, theta in rows[2:]:
        r = y - (m * X[:, 0] + b)
        m, b = m + (r * X[:, 0]).sum() * rate, b + r.sum() * rate
        assert used == pytest.approx(rate) and theta == pytest.approx([m, b], rel=1e-6)
        loss, old = np.mean((y - m * X[:, 0] - b) ** 2), loss
        assert got == pytest.approx(loss, rel=1e-6)
        rate = rate * 0.5 if loss > old else rate * 1.05
    theta, rate = np.full(3, 0.1), 0.0005
    X1 = np.column_stack([X, np.ones(len(X))])
    for _, _, _, got in ds.descend_multi(ds.moments(df, ["x1", "x2"], "y"), "observed", rate=rate, max_iter=5)[1:]:
        loss, theta = np.mean((y - X1 @ theta) ** 2), theta + theta * (y - X1 @ theta).sum() * 2 / len(y) * rate
        rate *= 0.5 if np.mean((y - X1 @ theta) ** 2) > loss else 1.05
        assert got == pytest.approx(theta.tolist(), rel=1e-9)


def test_training_loops(spark):
    f = feats(spark, 4)
    fit = cl.train_logistic(f, P, max_iter=8, rate=0.5)
    losses = [t[1] for t in fit.trace]
    assert losses[-1] < losses[0]
    h = cl.train_hinge(f, P, dim=P - 1, max_iter=8)
    assert len(h.trace) == 8 and h.trace[-1][1] <= h.trace[0][1]
    wh = cl.train_hinge(f, P, dim=P - 1, shares=SHARES, max_iter=4, variant="observed")
    assert all(math.isfinite(t[1]) for t in wh.trace)
    ev = cl.evaluate(f, fit.theta, mt.LOGISTIC_THRESHOLD).first()
    assert ev.tp + ev.fn + ev.fp + ev.tn == 40
    split = f.withColumn("is_test", F.col("doc_id") < 10)
    both = {r.is_test: r for r in cl.evaluate(split, fit.theta, mt.LOGISTIC_THRESHOLD, by=("is_test",)).collect()}
    assert both[True].tp + both[False].tp == ev.tp and both[True].tn + both[False].tn == ev.tn


def test_library_svc_on_sparse_vectors(spark):
    rows = sparse_rows(6, 200)
    f = spark.createDataFrame(rows, "doc_id long, label double, i array<int>, v array<double>, share double").repartition(3)
    X, y, _ = dense(rows)
    got = {r.doc_id: r.features for r in cl.sparse_vectors(f, P - 1).collect()}
    for d, vec in got.items():
        assert type(vec).__name__ == "SparseVector" and vec.toArray().tolist() == X[d, :-1].tolist()
    reg = 0.05
    _, theta = cl.linear_svc(cl.sparse_vectors(f, P - 1), max_iter=200, reg_param=reg)
    sd = X[:, :-1].std(0, ddof=1)
    objective = lambda t: np.maximum(0, 1 - (2 * y - 1) * (X @ t)).mean() + reg / 2 * ((t[:-1] * sd) ** 2).sum()
    # an independent solver: subgradient steps with averaging on the same objective
    t, mean = np.zeros(P), np.zeros(P)
    for k in range(1, 20001):
        s = 2 * y - 1
        g = -((s * (s * (X @ t) < 1))[:, None] * X).mean(0)
        g[:-1] += reg * t[:-1] * sd * sd
        t = t - g / (1 + 0.05 * k)
        mean += (t - mean) * 2 / (k + 1)
    assert objective(theta) <= objective(mean) + 5e-3 and objective(theta) < objective(np.zeros(P))
