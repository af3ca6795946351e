"""Closed-form simple regression, mean squared error, fit-line plot data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _num(c) -> Column:
    return c if isinstance(c, Column) else F.lit(float(c))


def centred_moments(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``(n, x_mean, y_mean, x_var, xy_cov, y_var)`` over the rows that
    have both: one aggregation pass whose partial moments are centred, so
    nothing cancels however many rows there are. Everything below follows from
    this row."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    X, Y = F.when(both, F.col(x)), F.when(both, F.col(y))
    return df.agg(
        F.count_if(both).alias("n"),
        F.avg(X).alias("x_mean"), F.avg(Y).alias("y_mean"),
        F.var_pop(X).alias("x_var"), F.covar_pop(X, Y).alias("xy_cov"), F.var_pop(Y).alias("y_var"))


def closed_form(df: DataFrame, x: str, y: str) -> DataFrame:
    """The least-squares line: the moments' row with ``slope``, ``intercept``
    and ``mse``, its mean squared error. A constant x gives null for them
    instead of a division error."""
    slope = F.try_divide(F.col("xy_cov"), F.col("x_var"))
    fit = centred_moments(df, x, y).withColumn("slope", slope)
    fit = fit.withColumn("intercept", F.col("y_mean") - F.col("slope") * F.col("x_mean"))
    return fit.withColumn("mse", F.greatest(F.lit(0.0), F.col("y_var") - F.col("slope") * F.col("xy_cov")))


def moments_mse(slope, intercept) -> Column:
    """Mean of (y - (slope x + intercept))² from the moments' row."""
    m, off = _num(slope), F.col("y_mean") - _num(slope) * F.col("x_mean") - _num(intercept)
    return F.col("y_var") - 2.0 * m * F.col("xy_cov") + m * m * F.col("x_var") + off * off


def regr(df: DataFrame, x: str, y: str) -> DataFrame:
    """The same fit with the built-in (numerically stable) regression
    aggregates."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )


def mse_at(x: str, y: str, slope, intercept) -> Column:
    """Aggregate expression: mean of (y - (slope x + intercept))²."""
    r = F.col(y) - (_num(slope) * F.col(x) + _num(intercept))
    return F.avg(r * r)


def fit_sample(df: DataFrame, order_by: Sequence[str], n: int = 1001) -> DataFrame:
    """The first ``n`` rows in a stated order (the plot sample): a top-n, not
    a full sort."""
    return df.orderBy(*order_by).limit(n)


def line_points(sample: DataFrame, params: DataFrame, x: str, step: float = 0.1,
                slope: str = "slope", intercept: str = "intercept") -> DataFrame:
    """Points of the fitted line across the sample's x range.

    ``k = floor((max - min) / step)`` points spaced evenly from min to max,
    both ends included (one point when k = 1, none when k = 0);
    ``y = slope x + intercept``. ``params`` is a one-row frame."""
    bounds = sample.agg(F.min(x).alias("x_min"), F.max(x).alias("x_max"))
    k = F.floor((F.col("x_max") - F.col("x_min")) / F.lit(step)).cast("bigint")
    grid = (
        bounds.crossJoin(params.select(slope, intercept))
        .withColumn("k", k)
        .where(F.col("k") >= 1)
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("i"))
    )
    span = F.col("x_max") - F.col("x_min")
    xv = (
        F.when(F.col("k") == 1, F.col("x_min"))
        .when(F.col("i") == F.col("k") - 1, F.col("x_max"))
        .otherwise(F.col("i").cast("double") * (span / (F.col("k") - 1).cast("double"))
                   + F.col("x_min"))
    )
    return grid.select("i", xv.alias("x"), slope, intercept).select(
        "i", "x", (F.col(slope) * F.col("x") + F.col(intercept)).alias("y"))


def regr_view(df: DataFrame, x: str, y: str, view: str = "rides") -> DataFrame:
    """The fit as SQL over a temporary view (replaced if it exists)."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(
        f"SELECT count(*) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept FROM {view}")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows as a frame (instead of printing them)."""
    return df.limit(n)


def with_previous_loss(trace: DataFrame, step: str = "step", loss: str = "loss") -> DataFrame:
    """Adds ``loss_old``: the loss of the previous step (a trace has at most
    max_iter + 2 rows, so the single-partition window is bounded)."""
    return trace.withColumn("loss_old", F.lag(loss).over(Window.orderBy(step)))
