"""Merging what tasks have gathered, in levels.

Each task leaves one packed row (an array of sums, a summary). A level merges
``FAN`` rows that stand next to each other, in a task of its own; levels follow
until ``FAN`` rows are left, which the driver merges. So a task reads ``FAN``
rows at most and the shuffle holds one row per task and level, however long a
row is and however many tasks there are. Up to ``FAN`` tasks need no shuffle.
Rows are merged in the order of their tasks: equal inputs give equal bits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 32

#: Takes the rows of a table, in order, and gives one row of the same columns.
Merge = Callable[[pa.Table], pa.Table]


def levels(tasks: int, fan: int = FAN) -> int:
    """Shuffled levels until at most ``fan`` rows are left."""
    n = 0
    while tasks > fan:
        tasks, n = -(-tasks // fan), n + 1
    return n


def merged_rows(parts: DataFrame, merge: Merge, tasks: int | None = None, fan: int = FAN) -> DataFrame:
    """At most ``fan`` rows ``(task, ...)``, merged from ``parts``, which has one
    row per task. ``tasks``: how many there are, where the caller knows."""
    columns = parts.columns
    if tasks is None:
        tasks = parts.rdd.getNumPartitions()
    out = parts.select(F.spark_partition_id().alias("task"), *columns)
    kinds = dict(out.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["task", *columns])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        one = merge(rows.select(columns))
        return pa.table([pa.array([rows.column("task")[0].as_py() // fan], pa.int32()), *one.columns], ["task", *columns])

    for _ in range(levels(tasks, fan)):
        out = out.groupBy(F.floor(F.col("task") / fan).alias("__group")).applyInArrow(run, schema)
    return out


def merged(parts: DataFrame, merge: Merge, tasks: int | None = None, fan: int = FAN) -> pa.Table:
    """One row: everything merged, the last ``fan`` rows on the driver."""
    table = merged_rows(parts, merge, tasks, fan).toArrow().sort_by("task").select(parts.columns)
    return merge(table) if table.num_rows else table


def one_row_per_task(run: Callable[[Iterator[pa.RecordBatch]], pa.RecordBatch]):
    """For ``mapInArrow``: the function's one row of each task."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield run(batches)

    return packed
