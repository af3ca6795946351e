"""Classifier training loops: logistic (bold driver), hinge and class-weighted
hinge (adaptive accept/reject rule), and Spark ML's LinearSVC.

Each step is ONE Spark job over the pinned sparse features: the fused Arrow
pass returns gradient and loss at the current θ together, so the loss that
decides the next rate comes with the gradient for the next step. θ lives on
the driver (vocabulary size + 1 doubles); no plan is chained across steps, so
the lineage does not grow with the number of steps.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import metrics as mt
from quillspark.operators.gradient import gradient_and_loss
from quillspark.plans.descent import AdaptiveRate, BoldDriver
from quillspark.plans.state import Step, StepLog

TRACE_SCHEMA = "step int, loss double, learning_rate double"


@dataclass
class Fit:
    theta: np.ndarray
    trace: list = field(default_factory=list)   # (step, loss, learning_rate)

    def trace_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(int(s), float(l), float(r)) for s, l, r in self.trace],
                                     TRACE_SCHEMA)

    def theta_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(i, float(w)) for i, w in enumerate(self.theta)],
                                     "idx int, weight double")


def _resumed(log: StepLog | None) -> Step | None:
    return log.last() if log is not None else None


def train_logistic(feats: DataFrame, p: int, variant: str = "exact", max_iter: int = 20,
                   rate: float = 0.1, lam: float = 0.01, min_rate: float = 0.01,
                   theta0: float = 0.1, rule: BoldDriver | None = None,
                   label_col: str = "label", log: StepLog | None = None) -> Fit:
    """L2 logistic regression by gradient descent. Mean gradient plus
    (λ/n)θ; loss mean log-loss plus λ/(2n)‖θ‖² (bias included). Bold driver
    (0.75, 1.1); stop when the rate falls below ``min_rate``. With a ``log``
    each step is kept there, and a run goes on from the last one kept."""
    rule = rule or BoldDriver(0.75, 1.1)
    tasks = feats.rdd.getNumPartitions()

    def at(theta):
        g, lsum, n = gradient_and_loss(feats, theta, "logistic", variant, label_col, tasks=tasks)
        return g / n + lam / n * theta, lsum / n + float(theta @ theta) * lam / 2.0 / n

    before = _resumed(log)
    if before is None:
        theta, first = np.full(p, theta0), 1
        grad, loss = at(theta)
        fit = Fit(theta, [(0, loss, rate)])
        if log is not None:
            log.save(Step(0, theta, theta, loss, rate, {}), loss, rate)
    else:
        theta, rate, loss, first = before.theta, before.rate, before.loss, before.step + 1
        fit = Fit(theta, log.trace(before.step))
        if before.finished or first > max_iter:
            return fit
        grad, _ = at(theta)
    for step in range(first, max_iter + 1):
        theta = theta - rate * grad
        old = loss
        grad, loss = at(theta)
        fit.trace.append((step, loss, rate))
        used, rate = rate, rule.next_rate(loss, old, rate)
        if log is not None:
            log.save(Step(step, theta, theta, loss, rate, {}, rate < min_rate), loss, used)
        if rate < min_rate:
            break
    fit.theta = theta
    return fit


def train_hinge(feats: DataFrame, p: int, dim: int, variant: str = "exact",
                shares: dict[float, float] | None = None, max_iter: int = 20, rate: float = 0.01,
                min_rate: float = 1e-6, theta0: float = 0.1, label_col: str = "label",
                log: StepLog | None = None) -> Fit:
    """Linear SVM by (sub)gradient descent on the hinge loss, optionally
    divided by the row's class share (``shares``). A step whose loss rose
    by more than 5 % is rolled back. ``observed`` uses summed gradients and
    the reference's compounding rate rule; ``exact`` uses mean gradients with
    RMSprop step scaling. With a ``log`` each step is kept there, and a run
    goes on from the last one kept."""
    kind = "weighted_hinge" if shares else "hinge"
    rule = AdaptiveRate(dim, variant)
    theta = np.full(p, theta0)
    theta_old = theta.copy()
    loss, first = float("nan"), 1
    fit = Fit(theta)
    before = _resumed(log)
    if before is not None:
        theta, theta_old, loss, rate, first = before.theta, before.theta_old, before.loss, before.rate, before.step + 1
        rule.p0, rule.s = before.rule["p0"], before.rule["s"]
        fit = Fit(theta, log.trace(before.step))
        if before.finished:
            return fit
    tasks = feats.rdd.getNumPartitions()
    for step in range(first, max_iter + 1):
        g, lsum, n = gradient_and_loss(feats, theta, kind, variant, label_col, shares, tasks)
        cur = lsum / n
        grad = g if variant == "observed" else g / n
        used = rate
        fit.trace.append((step, cur, used))
        rate, accept = rule.update(grad, rate, cur, loss)
        stop = rate < min_rate
        if not stop and accept:
            loss = cur
            theta, theta_old = theta - rule.step_size(rate) * grad, theta
        elif not stop:
            theta = theta_old
        if log is not None:
            log.save(Step(step, theta, theta_old, loss, rate, {"p0": rule.p0, "s": rule.s}, stop), cur, used)
        if stop:
            break
    fit.theta = theta
    return fit


def evaluate(feats: DataFrame, theta, threshold: float, label_col: str = "label",
             by: tuple[str, ...] = ()) -> DataFrame:
    """tp, fn, fp, tn, accuracy, f1 at a margin threshold: one row, or one for
    each value of ``by`` (as the split), in one pass."""
    pred = mt.predict(feats, theta, threshold)
    return mt.accuracy_f1(mt.confusion(pred, label_col, by=by))


def linear_svc(train: DataFrame, features_col: str = "features", label_col: str = "label",
               max_iter: int = 100, reg_param: float = 0.0, standardize: bool = True):
    """Spark ML's LinearSVC (threshold 0); returns θ = coefficients + [intercept].
    With ``standardize`` the penalty is on features in units of their deviation."""
    from pyspark.ml.classification import LinearSVC

    model = LinearSVC(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                      regParam=reg_param, threshold=0.0, standardization=standardize).fit(train)
    return model, np.append(model.coefficients.toArray(), model.intercept)


def dense_features(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """ARRAY<FLOAT|DOUBLE> -> ML dense vector, JVM-side."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def sparse_vectors(feats: DataFrame, size: int, out: str = "features",
                   keep: tuple[str, ...] = ("doc_id", "label")) -> DataFrame:
    """Sparse ``(i, v)`` -> ML sparse vectors of length ``size``, map-only: a
    row costs its non-zeros."""
    import pyarrow as pa
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    keep = tuple(keep)

    def run(batches):
        for b in batches:
            n = b.num_rows
            vector = pa.StructArray.from_arrays(
                [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), b.column("i"), b.column("v")],
                names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), vector], names=[*keep, out])

    schema = StructType([*(feats.schema[k] for k in keep), StructField(out, VectorUDT())])
    return feats.select(*keep, "i", "v").mapInArrow(run, schema)
