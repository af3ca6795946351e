"""How good a linear support vector fit is, proven by a duality gap.

The fit minimises P(w, b) = mean hinge loss + reg / 2 |w|². Any weights a in
[0, 1] of the rows that add up to the same in both classes give a lower bound
of that minimum, D(a) = mean(a) - reg / 2 |w(a)|² with w(a) = sum a s x / (reg n)
and s = ±1. So P - D bounds what any other (w, b) could gain, without training
again and without knowing how the fit was made.

At the minimum a row's weight is 1 inside its margin and 0 outside. ``a`` is
that step with a slope: several widths and places of it are tried in one pass
over the rows, which sums up each try's vectors by class; the heavier class is
scaled down to the lighter one, then the whole try to its best size. One packed
row per task goes through the levels of ``operators.merge``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.operators.blocks import ENTRIES, blocks, bound_batches
from quillspark.operators.gradient import add_up, margins
from quillspark.operators.merge import merged, one_row_per_task

WIDTHS = (1e-4, 1e-3, 1e-2, 3e-2, 0.1, 0.3)
PLACES = (0.0, 0.5, 1.0)         # weight of a row just on its margin


@dataclass
class Certificate:
    n: int
    primal: float       # the fit's objective
    dual: float         # no fit is below this

    @property
    def gap(self) -> float:
        return self.primal - self.dual

    def within(self, share: float) -> bool:
        """Whether no fit's objective is lower by more than a share of this one's."""
        return self.n > 0 and self.gap <= share * self.primal


def certificate(feats: DataFrame, theta: np.ndarray, reg: float, label_col: str = "label",
                widths: Sequence[float] = WIDTHS, places: Sequence[float] = PLACES, tasks: int | None = None) -> Certificate:
    """The certificate of ``theta`` (bias last, not regularised) over the rows
    ``(label, i, v)``, labels 1 and 0. One pass; ``reg`` must be positive."""
    if reg <= 0:
        raise ValueError("without regularisation there is no such bound")
    bound_batches(feats.sparkSession)
    theta = np.asarray(theta, np.float64)
    dim, tries = len(theta) - 1, [(w, p) for w in widths for p in places]

    def run(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        loss, n = 0.0, 0
        weight, vector = np.zeros((len(tries), 2)), np.zeros((len(tries), 2, dim))
        for b in blocks(batches, "i", ENTRIES):
            y = b.column(label_col).to_numpy(zero_copy_only=False) > 0.5
            short = 1.0 - np.where(y, 1.0, -1.0) * margins(b, theta)
            loss, n = loss + np.maximum(short, 0.0).sum(), n + b.num_rows
            i = b.column("i").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            v = b.column("v").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), np.diff(b.column("i").offsets.to_numpy()))
            for k, (width, place) in enumerate(tries):
                a = np.clip(short / width + place, 0.0, 1.0)
                for c, of in enumerate((y, ~y)):
                    own = a * of
                    weight[k, c] += own.sum()
                    vector[k, c] += np.bincount(i, weights=own[row] * v, minlength=dim)
        packed = np.concatenate([[loss, float(n)], weight.ravel(), vector.ravel()])
        return pa.RecordBatch.from_arrays([pa.array([packed], pa.list_(pa.float64()))], names=["g"])

    rows = merged(feats.select("i", "v", label_col).mapInArrow(one_row_per_task(run), "g array<double>"), add_up, tasks)
    if not rows.num_rows or not rows.column("g")[0].values[1].as_py():
        return Certificate(0, 0.0, 0.0)
    sums = rows.column("g")[0].values.to_numpy()
    n, m = sums[1], len(tries)
    primal = sums[0] / n + reg / 2 * float(theta[:-1] @ theta[:-1])
    weight, vector = sums[2:2 + 2 * m].reshape(m, 2), sums[2 + 2 * m:].reshape(m, 2, dim)
    dual = 0.0                                           # all weights zero
    for (up, down), (x_up, x_down) in zip(weight, vector):
        if up <= 0 or down <= 0:
            continue
        even = min(up, down)
        w = (x_up * (even / up) - x_down * (even / down)) / (reg * n)
        linear, square = 2 * even / n, reg / 2 * float(w @ w)
        size = min(1.0, linear / (2 * square)) if square > 0 else 1.0
        dual = max(dual, size * linear - size * size * square)
    return Certificate(int(n), primal, dual)
