"""Cut Arrow batches into blocks of bounded text size, so that work memory does not follow batch size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from emberlog.session import setting

BLOCK_BYTES = 1 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, most: int = BLOCK_BYTES):
    """Actions inside get their rows in Arrow batches of about ``most`` bytes, a longer row alone; then the old limit holds again.

    Spark's own limit is 10,000 rows or 64 MB, which the executor and each Python worker hold more than once.
    """
    return setting(spark, BATCH_LIMIT, str(most))


def free_unused() -> None:
    """Give back what earlier tasks of this worker left in the memory pools of Arrow and of numpy."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``block_bytes`` of ``column`` each; a longer text is a block of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + block_bytes, side="right")))
            yield batch.slice(start, end - start)
            start = end
        if not len(sizes):
            yield batch
