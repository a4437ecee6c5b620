"""What keeps Python workers small: batches of few bytes, and memory given back when a task ends."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes that go to a Python worker at once, about. Spark's 64 MB are held several times over by each task, in the worker and beside the JVM's heap.
BATCH_BYTES = 4_000_000


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's plans send about BATCH_BYTES to Python at once at most (a longer row alone). Results stay the same."""
    if not 0 < spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def pieces(batch: pa.RecordBatch, most: int = BATCH_BYTES // 4) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `most` bytes, for what makes Python objects of its rows."""
    step = max(1, batch.num_rows * most // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def give_back() -> None:
    """Returns memory that a Python worker no longer uses to the system; else workers that wait for a next task, or are never used again, keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def sparing(run: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives its memory back when its task ends. forget: empties what the worker remembers."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return wrapped
