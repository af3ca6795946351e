"""Fused gradient and loss over sparse features, one pass per step.

Each task walks its Arrow batches with numpy (margins by ``bincount`` over the
flattened sparse entries, gradient by a second ``bincount``) and emits ONE row:
a packed array of ``p + 2`` sums, which are gradient, loss and row count. The
rows are added up in levels (operators.merge), one row per task and level, in
the order of the tasks; at most ``merge.FAN`` rows reach the driver. The model
vector θ travels in the task closure; its size is the vocabulary size + 1,
bounded by ``dim``.

Losses (``y`` in {0, 1}; ``s = 2y - 1`` in {-1, +1}; margin ``m = x·θ + b``):

* ``logistic``: loss log(1 + e^{-|m|}) + max(m, 0) - y m.
  exact gradient (h - y) x; observed gradient h·1 - y x (every slot gets h).
* ``hinge``: loss max(0, 1 - s m). exact subgradient -s x where s m < 1;
  observed where m < 1.
* ``weighted_hinge``: hinge divided by the row's class share.

All gradients are returned as SUMS over rows; the caller scales (mean, 2/n,
regularisation) as its update rule says.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from quillspark.functions.columns import hinge, logistic_loss
from quillspark.operators.blocks import ENTRIES, blocks, bound_batches
from quillspark.operators.merge import merged, one_row_per_task

LOSSES = ("logistic", "hinge", "weighted_hinge")
VARIANTS = ("exact", "observed")


def _flat(list_arr: pa.ListArray):
    """Values and per-row lengths of a (possibly sliced) list array."""
    values = list_arr.flatten().to_numpy(zero_copy_only=False)
    offsets = list_arr.offsets.to_numpy()
    lens = np.diff(offsets)
    return values, lens


def row_terms(kind: str, variant: str, m: np.ndarray, y: np.ndarray,
              w: np.ndarray | None):
    """Per-row loss, coefficient c (gradient = c * x on the sparse slots and
    c on the bias) and a dense term added to every slot (observed logistic)."""
    dense = None
    if kind == "logistic":
        loss = np.log1p(np.exp(-np.abs(m))) + np.maximum(m, 0.0) - y * m
        h = 1.0 / (1.0 + np.exp(-m))
        if variant == "exact":
            c = h - y
        else:
            c = -y
            dense = h
    else:
        s = 2.0 * y - 1.0
        loss = np.maximum(0.0, 1.0 - s * m)
        active = (s * m < 1.0) if variant == "exact" else (m < 1.0)
        c = np.where(active, -s, 0.0)
        if kind == "weighted_hinge":
            loss = loss / w
            c = c / w
    return loss, c, dense


def margins(batch: pa.RecordBatch, theta: np.ndarray) -> np.ndarray:
    """x·θ + θ[last] of each row of a batch with sparse columns i and v."""
    idx, lens = _flat(batch.column("i"))
    vals, _ = _flat(batch.column("v"))
    row = np.repeat(np.arange(batch.num_rows), lens)
    return np.bincount(row, weights=vals * theta[:-1][idx.astype(np.int64)], minlength=batch.num_rows) + theta[-1]


def _partials(theta: np.ndarray, kind: str, variant: str,
              label_col: str, shares: dict[float, float] | None):
    p = theta.shape[0]
    wts, bias = theta[:-1], theta[-1]

    def fn(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        g = np.zeros(p)
        loss_sum = 0.0
        n = 0
        for b in blocks(batches, "i", ENTRIES):
            rows = b.num_rows
            idx, lens = _flat(b.column("i"))
            vals, _ = _flat(b.column("v"))
            idx = idx.astype(np.int64)
            row = np.repeat(np.arange(rows), lens)
            y = b.column(label_col).to_numpy(zero_copy_only=False).astype(np.float64)
            w = np.where(y > 0.5, shares[1.0], shares[0.0]) if shares else None
            m = np.bincount(row, weights=vals * wts[idx], minlength=rows) + bias
            loss, c, dense = row_terms(kind, variant, m, y, w)
            g[:-1] += np.bincount(idx, weights=c[row] * vals, minlength=p - 1)
            g[-1] += c.sum()
            if dense is not None:
                g += dense.sum()
            loss_sum += loss.sum()
            n += rows
        return pa.RecordBatch.from_arrays([pa.array([np.concatenate([g, [loss_sum, float(n)]])], pa.list_(pa.float64()))], names=["g"])

    return one_row_per_task(fn)


def add_up(rows: pa.Table) -> pa.Table:
    """The element-wise sum of the rows' arrays."""
    total = np.zeros(0)
    for row in rows.column("g"):
        total = row.values.to_numpy(zero_copy_only=False) + (total if len(total) else 0.0)
    return pa.table([pa.array([total], pa.list_(pa.float64()))], ["g"])


def partial_sums(feats: DataFrame, theta: np.ndarray, kind: str = "logistic",
                 variant: str = "exact", label_col: str = "label",
                 shares: dict[float, float] | None = None) -> DataFrame:
    """``(g ARRAY<DOUBLE>)``, one row per task: gradient sums, loss sum and row
    count. Lazy."""
    if kind not in LOSSES or variant not in VARIANTS:
        raise ValueError(f"unknown loss {kind!r} / variant {variant!r}")
    if kind == "weighted_hinge" and not shares:
        raise ValueError("weighted_hinge needs the class shares")
    bound_batches(feats.sparkSession)
    fn = _partials(np.asarray(theta, dtype=np.float64), kind, variant, label_col, shares)
    return feats.select("i", "v", label_col).mapInArrow(fn, "g array<double>")


def gradient_and_loss(feats: DataFrame, theta: np.ndarray, kind: str = "logistic",
                      variant: str = "exact", label_col: str = "label",
                      shares: dict[float, float] | None = None, tasks: int | None = None):
    """Run one pass; return (gradient sum ARRAY, loss sum, row count).
    ``tasks``: the frame's number of partitions, where the caller knows it."""
    p = len(theta)
    rows = merged(partial_sums(feats, theta, kind, variant, label_col, shares), add_up, tasks)
    out = np.asarray(rows.column("g")[0].values) if rows.num_rows else np.zeros(p + 2)
    return out[:p], float(out[p]), int(round(out[p + 1]))


# ------------------------------------------------------------ column form
# The loss as a plain column expression over a margin column.

def loss_col(kind: str, m: Column, y: Column, w: Column | None = None) -> Column:
    if kind == "logistic":
        return logistic_loss(m, y)
    s = y * 2.0 - 1.0
    out = hinge(m, s)
    return out / w if kind == "weighted_hinge" else out
