"""How loaded rows are laid out over tasks.

``None`` keeps the scan's splits. ``"auto"`` is a rebalance: Spark measures the
shuffled rows and makes tasks of the advisory size from them, large ones split
and small ones joined, so the number of tasks follows the data. A list of
columns does the same with equal keys side by side (a key too large for one
task is still split). A number is a fixed count, for a caller who knows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

AUTO = "auto"
Layout = None | int | str | Sequence[str]


def laid_out(df: DataFrame, layout: Layout = None) -> DataFrame:
    if layout is None:
        return df
    if isinstance(layout, bool):
        raise ValueError("a layout is a number, 'auto' or column names")
    if isinstance(layout, int):
        if layout < 1:
            raise ValueError("a layout needs one task at least")
        return df.repartition(layout)
    if layout == AUTO:
        return df.hint("rebalance")
    columns = [layout] if isinstance(layout, str) else list(layout)
    missing = [c for c in columns if c not in df.columns]
    if missing or not columns:
        raise ValueError(f"layout columns {missing or columns} not in {df.columns}")
    return df.hint("rebalance", *columns)
