"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_SLICE_BYTES = 8 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                slice_bytes: int = _SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about 8 MB of text, so that a task's memory is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(_offsets(batch.column(column)))
        ends = np.cumsum(sizes) // slice_bytes
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if stop > start:
                yield batch.slice(start, stop - start)


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    return raw[column.offset:column.offset + len(column) + 1]


@contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python gets at most ``rows`` rows at once from what is executed meanwhile.

    By default a task's texts travel as one batch, which the JVM and the worker both hold.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Return freed memory to the system, at the end of a task or group.

    A Python worker waits for its next task with all that its allocators have kept, beside the workers
    of other stages and the JVM.
    """
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of integers, byte plane by byte plane: sorted values compress well."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return raw[:, :width].T.tobytes()


def unpack(payload: bytes, width: int, kind: type = np.uint64) -> np.ndarray:
    """Inverse of :func:`pack`."""
    planes = np.frombuffer(payload, np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    raw[:, :width] = planes.T
    return raw.view(kind).ravel()
