"""Arrow batches in pieces, so that a worker holds little at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession


BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Texts and sets are long: few rows per Arrow batch keep executors and their Python workers small.

    The setting is the session's; it changes no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_pieces(batch: pa.Array, size: int) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``size`` bytes together; a longer text stands alone."""
    sums = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(batch):
        before = sums[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sums, before + size, side="right")))
        yield batch.slice(begin, end - begin).to_pylist()
        begin = end
