import numpy as np
from pyspark.sql import functions as F

from quillspark.operators.linear import closed_form, fit_sample, line_points, mse_at, regr


def data(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(1, 10, 200)
    y = 2.35 * x + 3.28 + rng.normal(0, 0.5, 200)
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                                 "id long, x double, y double"), x, y


def test_closed_form_matches_polyfit(spark):
    df, x, y = data(spark)
    m, b = np.polyfit(x, y, 1)
    r = closed_form(df, "x", "y").first()
    assert r.n == 200
    assert abs(r.slope - m) < 1e-9 and abs(r.intercept - b) < 1e-9
    q = regr(df, "x", "y").first()
    assert abs(q.slope - m) < 1e-9 and abs(q.intercept - b) < 1e-9


def test_constant_x_gives_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    r = closed_form(df, "x", "y").first()
    assert r.slope is None and r.intercept is None


def test_mse(spark):
    df, x, y = data(spark)
    got = df.agg(mse_at("x", "y", 2.0, 1.0)).first()[0]
    assert abs(got - np.mean((y - (2.0 * x + 1.0)) ** 2)) < 1e-9


def test_line_points_are_linspace(spark):
    df, x, y = data(spark)
    sample = fit_sample(df, ["id"], 1001)
    params = regr(df, "x", "y")
    pts = line_points(sample, params, "x", 0.1).orderBy("i").collect()
    k = int((x.max() - x.min()) / 0.1)
    ref = np.linspace(x.min(), x.max(), num=k)
    m, b = np.polyfit(x, y, 1)
    assert len(pts) == k
    assert np.allclose([p.x for p in pts], ref, rtol=0, atol=1e-12)
    assert np.allclose([p.y for p in pts], m * ref + b, atol=1e-8)
    assert pts[-1].x == x.max()


def test_line_points_one_and_none(spark):
    p = spark.createDataFrame([(2.0, 1.0)], "slope double, intercept double")
    one = spark.createDataFrame([(1.0,), (1.15,)], "x double")
    assert [r.x for r in line_points(one, p, "x").collect()] == [1.0]
    none = spark.createDataFrame([(1.0,), (1.05,)], "x double")
    assert line_points(none, p, "x").count() == 0


def test_fit_sample_is_ordered_top_n(spark):
    df, _, _ = data(spark)
    got = [r.id for r in fit_sample(df.repartition(7), ["id"], 5).collect()]
    assert got == [0, 1, 2, 3, 4]
    assert df.select(F.count("*")).first()[0] == 200


def test_moments_do_not_cancel(spark):
    """Far from the origin sums of squares lose every digit of the slope."""
    from quillspark.operators.linear import moments_mse

    rng = np.random.default_rng(1)
    x = 1e8 + rng.uniform(0, 1, 500)
    y = 3.0 * (x - 1e8) + 7.0
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, None)], "x double, y double")
    r = closed_form(df, "x", "y").first()
    assert r.n == 500 and abs(r.slope - 3.0) < 1e-6 and r.mse < 1e-9
    df, x, y = data(spark)
    fit = closed_form(df, "x", "y").select("*", moments_mse(2.0, 1.0).alias("at"), moments_mse(F.col("slope"), F.col("intercept")).alias("own")).first()
    assert abs(fit["at"] - np.mean((y - 2.0 * x - 1.0) ** 2)) < 1e-9
    assert abs(fit.mse - np.mean((y - fit.slope * x - fit.intercept) ** 2)) < 1e-9 and abs(fit.own - fit.mse) < 1e-9


def test_view_and_helpers(spark):
    from quillspark.operators.linear import preview, regr_view, with_previous_loss
    df, x, y = data(spark)
    m, b = np.polyfit(x, y, 1)
    r = regr_view(df, "x", "y").first()
    r2 = regr_view(df, "x", "y").first()       # the view is replaced, not an error
    assert abs(r.slope - m) < 1e-9 and abs(r.intercept - b) < 1e-9 and r2.n == 200
    assert preview(df, 3).count() == 3
    tr = spark.createDataFrame([(0, 3.0), (1, 2.0), (2, 2.5)], "step int, loss double")
    got = [r.loss_old for r in with_previous_loss(tr).orderBy("step").collect()]
    assert got == [None, 3.0, 2.0]


def test_sig_round_special_values(spark):
    from quillspark.functions.columns import sig_round
    vals = [0.0, None, float("nan"), float("inf"), float("-inf"), 123456.789, -1.23456789e-30, 9.9999999999e22]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(sig_round("x", 6)).collect()]
    assert got[0] == 0.0 and got[1] is None and got[2] != got[2]
    assert got[3] == float("inf") and got[4] == float("-inf")
    assert got[5] == 123457.0 and got[6] == -1.23457e-30 and got[7] == 1e23
