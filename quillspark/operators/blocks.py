"""Arrow batches in blocks of bounded work.

A batch has up to 10,000 rows, however long these are, and a worker that holds
numpy columns of a whole one needs many times its bytes. ``blocks`` hands out
slices with up to ``most`` bytes of text or list entries (a longer row is a
slice of its own), so what a task keeps besides the batch doesn't grow with the
table or the batch; ``bound_batches`` bounds the batches themselves by bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

TEXT_BYTES = 1 << 20
ENTRIES = 1 << 17
BATCH_MB = 8
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, mb: int = BATCH_MB) -> None:
    """Batches of at most ``mb`` MB from now on, if they aren't smaller already."""
    now = re.fullmatch(r"(\d+)([bkm]?)b?", spark.conf.get(BATCH_BYTES).strip().lower())
    size = int(now[1]) << {"k": 10, "m": 20}.get(now[2], 0) if now else 0
    if not 0 < size <= mb << 20:
        spark.conf.set(BATCH_BYTES, str(mb << 20))


def blocks(batches: Iterator[pa.RecordBatch], column: int | str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices whose ``column`` (texts or
    lists) has up to ``most`` bytes or entries, or that have one row. The tasks'
    batches without rows are left out."""
    for batch in batches:
        values = batch.column(column)
        text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
        size = (pc.binary_length if text else pc.list_value_length)(values)
        ends = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(first, last - first)
            first = last
