"""Threshold prediction, confusion counts, accuracy and F1.

Everything is one aggregation pass: four conditional counts, then arithmetic
on the one-row result."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.blocks import ENTRIES, blocks, bound_batches
from quillspark.operators.gradient import margins

# Margin thresholds of the reference's prediction rules.
LOGISTIC_THRESHOLD = 0.5   # logistic and the library SVC (compared on the margin)
HINGE_THRESHOLD = 0.0      # hand-written hinge models


def with_margin(feats: DataFrame, theta) -> DataFrame:
    """Add ``margin = x·θ + θ[last]``, map-only: θ (a driver vector of length
    p) travels in the task closure."""
    theta = np.asarray(theta, dtype=np.float64)
    bound_batches(feats.sparkSession)
    names = [c for c in feats.columns if c != "margin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "i", ENTRIES):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(margins(b, theta))], names=[*names, "margin"])

    kinds = dict(feats.dtypes)
    return feats.select(*names).mapInArrow(run, "".join(f"`{c}` {kinds[c]}, " for c in names) + "margin double")


def predict(feats: DataFrame, theta, threshold: float) -> DataFrame:
    m = with_margin(feats, theta)
    return m.withColumn("prediction", F.when(F.col("margin") >= F.lit(float(threshold)), 1.0)
                        .otherwise(0.0))


def confusion(pred: DataFrame, label_col: str = "label",
              pred_col: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """``(tp, fn, fp, tn)``, one row, or one for each value of ``by``; labels
    compared within 0.001."""
    y, p = F.col(label_col), F.col(pred_col)
    same = F.abs(y - p) < F.lit(0.001)
    return pred.groupBy(*by).agg(
        F.count_if(same & (y == 1.0)).alias("tp"),
        F.count_if(~same & (y == 1.0)).alias("fn"),
        F.count_if(~same & (y == 0.0)).alias("fp"),
        F.count_if(same & (y == 0.0)).alias("tn"),
    )


def accuracy_f1(conf: DataFrame) -> DataFrame:
    """Adds ``accuracy = (tp + tn) / all`` and ``f1 = 2tp / (2tp + fp + fn)``
    (null when a denominator is 0)."""
    tp, fn, fp, tn = (F.col(c).cast("double") for c in ("tp", "fn", "fp", "tn"))
    return conf.select(
        "*",
        F.try_divide(tp + tn, tp + fn + fp + tn).alias("accuracy"),
        F.try_divide(tp * 2.0, tp * 2.0 + fp + fn).alias("f1"),
    )


def accuracy(pred: DataFrame, label_col: str = "label",
             pred_col: str = "prediction") -> DataFrame:
    """One row ``(n, accuracy)``: share of rows with label == prediction."""
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.avg((F.col(label_col) == F.col(pred_col)).cast("double")).alias("accuracy"))
