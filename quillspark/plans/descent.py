"""Gradient descent for linear regression over one-pass sufficient statistics.

The data are read ONCE: one aggregation gives the row count, the means and the
covariance matrix of features and target (Spark merges centred partial moments
per task). Every sum the update rules need is a function of those moments, so
the 100 descent steps run on the driver over a handful of numbers whose count
does not grow with the data (features² + 2 features + 3).

``exact`` follows the textbook gradient in standardised units, where one step
size suits every feature:
    loss(θ, b) = 1 - 2 θ·c + θᵀ C θ + b²   (C, c: correlations)
and maps each step back, so parameters and losses are in the data's units.
``observed`` follows the reference's update formulas as written, on the raw
inputs: the summed gradient without the factor 2 for the simple model, the
residual times θ instead of times x for the multiple model. Step and stop
rules are small driver objects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRACE_SCHEMA = "step int, loss double, learning_rate double, theta array<double>"


# ---------------------------------------------------------------- step rules

@dataclass
class BoldDriver:
    """Loss rose -> rate x down; otherwise (equal too) -> rate x up."""

    down: float = 0.5
    up: float = 1.05

    def next_rate(self, loss: float, loss_old: float, rate: float) -> float:
        return rate * self.down if loss > loss_old else rate * self.up


@dataclass
class StopRule:
    """Stop when the rate falls below ``min_rate`` or after ``max_hits`` steps
    whose loss change is below ``tol`` (any decrease counts; never reset)."""

    min_rate: float = 1e-5
    max_hits: int | None = 10
    tol: float = 1e-5
    hits: int = 0

    def should_stop(self, loss: float, loss_old: float, rate: float) -> bool:
        if loss - loss_old < self.tol:
            self.hits += 1
        return rate < self.min_rate or (self.max_hits is not None and self.hits >= self.max_hits)


def sig_round_value(x: float, digits: int = 12) -> float:
    """``x`` rounded to ``digits`` significant digits, half away from zero,
    scaling by exact powers of ten: the same arithmetic as the SQL oracle's
    rounding, so both give the same double."""
    if x == 0 or math.isnan(x) or math.isinf(x):
        return x
    k = digits - 1 - math.floor(math.log10(abs(x)))
    pa, pb = 10.0 ** min(abs(k), 22), 10.0 ** max(abs(k) - 22, 0)
    if k >= 0:
        y = Decimal(x * pa * pb).quantize(Decimal(1), rounding=ROUND_HALF_UP)
        return float(y) / pb / pa
    y = Decimal(x / pa / pb).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    return float(y) * pb * pa


@dataclass
class AdaptiveRate:
    """The hinge models' step rule, on the relative change of the loss.

    The change falls into one of ``bands``: those above ``limit`` take its
    factor, and a step is kept or rolled back. A loss that fell further than
    the last band, and the first step, which has none to compare with, settle:
    ``observed`` compounds p0 by 0.9 p0 + 0.1 sqrt(g·g/dim) + 1e-8 and divides
    the rate by it (on summed gradients); ``exact`` leaves the rate. ``exact``
    also keeps s = 0.9 s + 0.1 g·g/dim on every step; the step size is then
    rate / (sqrt(s) + 1e-8) (RMSprop scaling of a mean gradient).

    Losses are compared at ``tie_digits`` significant digits: a rolled-back
    step re-evaluates the same θ, whose loss equals the accepted one in exact
    arithmetic, and a different summation order must not turn that tie into
    a rise."""

    dim: int
    variant: str = "exact"
    p0: float = 0.0
    s: float = 0.0
    tie_digits: int = 12
    #: (limit that the change must exceed, factor of the rate, keep the step)
    bands: tuple[tuple[float, float, bool], ...] = ((0.05, 0.5, False), (0.0, 0.75, True), (-0.01, 1.1, True))

    def change(self, loss: float, loss_old: float) -> float | None:
        """Relative change of the loss; none at the first step."""
        if math.isnan(loss_old):
            return None
        now, before = (sig_round_value(v, self.tie_digits) for v in (loss, loss_old))
        if before == 0:
            return 0.0 if now == 0 else math.inf
        return round((now - before) / before, self.tie_digits)

    def update(self, grad: np.ndarray, rate: float, loss: float, loss_old: float):
        """The next rate, and whether the step is kept."""
        energy = float(grad @ grad) / self.dim
        if self.variant == "exact":
            self.s += 0.1 * (energy - self.s)
        change = self.change(loss, loss_old)
        for limit, factor, kept in self.bands if change is not None else ():
            if change > limit:
                return rate * factor, kept
        if self.variant == "observed":
            self.p0 = 1.9 * self.p0 + 0.1 * math.sqrt(energy) + 1e-8
            return rate / self.p0, True
        return rate, True

    def step_size(self, rate: float) -> float:
        if self.variant == "exact":
            return rate / (math.sqrt(self.s) + 1e-8)
        return rate


# ---------------------------------------------------------------- statistics

@dataclass
class Moments:
    n: int
    x_mean: np.ndarray           # k means of the features
    y_mean: float
    x_sd: np.ndarray             # k standard deviations
    y_sd: float
    cov_xx: np.ndarray           # k x k covariances of the features
    cov_xy: np.ndarray           # k covariances feature / target
    names: list[str] = field(default_factory=list)

    @property
    def corr_xx(self) -> np.ndarray:
        out = self.cov_xx / np.outer(self.x_sd, self.x_sd)
        np.fill_diagonal(out, 1.0)
        return out

    @property
    def corr_xy(self) -> np.ndarray:
        return self.cov_xy / (self.x_sd * self.y_sd)

    def data_units(self, theta, bias: float) -> tuple[list[float], float]:
        """Slopes and intercept that stand for θ and bias in standardised units."""
        slopes = [float(t * self.y_sd / sd) for t, sd in zip(theta, self.x_sd)]
        return slopes, self.y_mean + self.y_sd * float(bias) - _dot(slopes, self.x_mean)


def moments(df: DataFrame, xs: list[str], y: str) -> Moments:
    """One aggregation pass: count, means, variances, pairwise covariances.
    Raises on a constant feature or target, which has no standardised unit."""
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("m_y"), F.var_pop(y).alias("v_y")]
    for a, x in enumerate(xs):
        aggs += [F.avg(x).alias(f"m_{a}"), F.var_pop(x).alias(f"c_{a}_{a}"), F.covar_pop(x, y).alias(f"c_{a}_y")]
        aggs += [F.covar_pop(x, xs[b]).alias(f"c_{a}_{b}") for b in range(a + 1, len(xs))]
    r = df.agg(*aggs).first()
    k = range(len(xs))
    cov = np.array([[r[f"c_{min(a, b)}_{max(a, b)}"] or 0.0 for b in k] for a in k], dtype=float)
    if not r["n"] or not r["v_y"] or not np.diag(cov).all():
        raise ValueError("descent needs rows, and features and a target that vary")
    return Moments(int(r["n"]), np.array([r[f"m_{a}"] for a in k]), r["m_y"], np.sqrt(np.diag(cov)), math.sqrt(r["v_y"]),
                   cov, np.array([r[f"c_{a}_y"] for a in k], dtype=float), list(xs))


def _dot(a, b) -> float:
    """Left-to-right sum of products (a fixed evaluation order, so the SQL
    oracle can repeat it bit for bit)."""
    out = float(a[0]) * float(b[0])
    for x, y in zip(a[1:], b[1:]):
        out = out + float(x) * float(y)
    return out


def _matvec(c: np.ndarray, t) -> np.ndarray:
    return np.array([_dot(row, t) for row in c])


def std_loss(mo: Moments, theta, bias: float) -> float:
    """Mean squared error in standardised units."""
    t = [float(v) for v in theta]
    return 1.0 - 2.0 * _dot(t, mo.corr_xy) + _dot(t, _matvec(mo.corr_xx, t)) + bias * bias


# ---------------------------------------------------------------- descent

def _trace_frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, TRACE_SCHEMA)


def descend_simple(mo: Moments, variant: str = "exact", m0: float = 0.1, b0: float = 0.1,
                   rate: float = 0.01, max_iter: int = 100,
                   rule: BoldDriver | None = None):
    """Simple regression (one feature), fixed number of steps, bold driver
    (0.5, 1.05). Rows in data units: step -1 = closed-form baseline, step 0 =
    start, then one row per step with the rate used.

    Both variants follow the distance from the least-squares line along the
    principal axes of the loss, where each axis has its own factor per step:
    no axis' rounding reaches another's. The step rule compares the excess
    over the baseline loss: the same decision in exact arithmetic, with full
    relative precision near the optimum."""
    rule = rule or BoldDriver(0.5, 1.05)
    var, cov = float(mo.cov_xx[0, 0]), float(mo.cov_xy[0])
    x_mean, y_var = float(mo.x_mean[0]), mo.y_sd * mo.y_sd
    best_m = cov / var
    best_b = mo.y_mean - best_m * x_mean
    base = y_var - best_m * cov
    if variant == "exact":
        # standardised units: the axes are slope and intercept themselves
        r = float(mo.corr_xy[0])
        e1, e2, speed, scale = m0 - r, b0, (2.0, 2.0), (y_var, y_var)
        unit = mo.y_sd / math.sqrt(var)

        def line(e1, e2):
            m = (r + e1) * unit
            return m, mo.y_mean + mo.y_sd * e2 - m * x_mean
    else:
        # raw units: the loss' matrix [[x² mean, x mean], [x mean, 1]]
        square = var + x_mean * x_mean
        l1 = (square + 1.0) / 2.0 + math.sqrt((square - 1.0) * (square - 1.0) / 4.0 + x_mean * x_mean)
        l2 = var / l1
        c, s = ((l1 - 1.0) / math.sqrt((l1 - 1.0) * (l1 - 1.0) + x_mean * x_mean), x_mean / math.sqrt((l1 - 1.0) * (l1 - 1.0) + x_mean * x_mean))
        dm, db = m0 - best_m, b0 - best_b
        e1, e2 = c * dm + s * db, c * db - s * dm
        speed, scale = (mo.n * l1, mo.n * l2), (l1, l2)

        def line(e1, e2):
            return best_m + c * e1 - s * e2, best_b + s * e1 + c * e2

    def excess(e1, e2):
        return scale[0] * e1 * e1 + scale[1] * e2 * e2

    rows = [(-1, base, None, [best_m, best_b])]
    cur = excess(e1, e2)
    rows.append((0, base + cur, rate, [*line(e1, e2)]))
    for step in range(1, max_iter + 1):
        e1, e2 = e1 * (1.0 - speed[0] * rate), e2 * (1.0 - speed[1] * rate)
        cur, old = excess(e1, e2), cur
        rows.append((step, base + cur, rate, [*line(e1, e2)]))
        rate = rule.next_rate(cur, old, rate)
    return rows


def descend_multi(mo: Moments, variant: str = "exact", theta0: float = 0.1,
                  rate: float = 0.001, max_iter: int = 100,
                  rule: BoldDriver | None = None, stop: StopRule | None = None):
    """Multiple regression, θ = (features..., constant), bold driver
    (0.5, 1.05), early stop (rate < 1e-5 or 10 small-change steps). Rows in
    data units. The stop rule sees the loss in the units that are descended in
    (standardised for ``exact``)."""
    rule = rule or BoldDriver(0.5, 1.05)
    stop = stop or StopRule(1e-5, 10, 1e-5)
    exact = variant == "exact"
    y_var = mo.y_sd * mo.y_sd
    th, bias = np.full(len(mo.cov_xy), theta0), theta0

    def loss(th, bias):
        if exact:
            return std_loss(mo, th, bias)
        off = mo.y_mean - _dot(th, mo.x_mean) - bias
        return y_var - 2.0 * _dot(th, mo.cov_xy) + _dot(th, _matvec(mo.cov_xx, th)) + off * off

    def row(step, cur, rate):
        if not exact:
            return step, cur, rate, [*th.tolist(), bias]
        slopes, const = mo.data_units(th, bias)
        return step, cur * y_var, rate, [*slopes, const]

    cur = loss(th, bias)
    rows = [row(0, cur, rate)]
    for step in range(1, max_iter + 1):
        if exact:
            g, gb = -2.0 * (mo.corr_xy - _matvec(mo.corr_xx, th)), 2.0 * bias
        else:
            # -θ_j · mean residual · 2
            off = mo.y_mean - _dot(th, mo.x_mean) - bias
            g, gb = -2.0 * th * off, -2.0 * bias * off
        th, bias = th - g * rate, bias - gb * rate
        cur, old = loss(th, bias), cur
        rows.append(row(step, cur, rate))
        rate = rule.next_rate(cur, old, rate)
        if stop.should_stop(cur, old, rate):
            break
    return rows


def simple_trace(df: DataFrame, x: str, y: str, variant: str = "exact", **kw) -> DataFrame:
    mo = moments(df, [x], y)
    return _trace_frame(df.sparkSession, descend_simple(mo, variant, **kw))


def multi_trace(df: DataFrame, xs: list[str], y: str, variant: str = "exact", **kw) -> DataFrame:
    mo = moments(df, xs, y)
    return _trace_frame(df.sparkSession, descend_multi(mo, variant, **kw))
