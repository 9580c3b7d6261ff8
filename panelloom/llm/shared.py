"""Where intermediate tables go, and Arrow columns seen as flat numpy arrays."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelloom.session import fresh_path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and go on from the files.

    What is read twice is computed once, its lineage ends here, and a lost
    executor costs a re-read of files rather than a recomputation.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


Batches = Iterator[pa.RecordBatch]


def trimmed(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, giving freed memory back at the end of each partition.

    Workers are used again by later stages; what an allocator keeps for itself
    would add up beside the executor's heap.
    """

    @functools.wraps(run)
    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each value starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.cast(pa.large_string()).cast(kind) if pa.types.is_string(column.type) else column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def spans_of_rows(starts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose bytes stay within ``limit``; a longer row stands alone."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = int(np.searchsorted(starts, starts[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def binary_array(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(values), [None, pa.py_buffer(values.tobytes())]
    ).cast(pa.binary())
