"""Arrow batches cut to bounded pieces, and text columns as numpy buffers."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step inside a task works on; one longer row is a piece of its own.
PIECE_BYTES = 4 << 20


#: Bytes that Spark sends to a Python worker at once, about.
SENT_BYTES = 4 << 20
_SENT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of this session to a few MB, in Spark and in its Python workers.

    The setting is only ever lowered. It is read when a query runs, so it stays.
    """
    now = int(re.match(r"-?\d+", spark.conf.get(_SENT))[0])
    if now <= 0 or now > SENT_BYTES:
        spark.conf.set(_SENT, f"{SENT_BYTES}b")


def rows_key(row_col: str | None) -> list[Column]:
    """The key of the rows, for a select; nothing where there is none."""
    return [F.col(row_col).cast("string").alias(row_col)] if row_col else []


def rows_schema(row_col: str | None) -> str:
    """The key of the rows, for the end of a schema."""
    return f", `{row_col}` string" if row_col else ""


def give_back() -> None:
    """Return freed memory to the system: a worker is kept for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over a byte buffer."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def fixed(rows: np.ndarray) -> pa.Array:
    """A binary column with one value for each row of a two-dimensional array."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    return binary(rows.view(np.uint8).ravel() if rows.size else np.zeros(0, np.uint8), np.arange(len(rows) + 1, dtype=np.int64) * width)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values of each row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        own = tuple(c[0].as_py() for c in columns)
        if held and own != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(start, stop - start)])
            held = []
        held.append(batch.slice(cuts[-2]))
        last = tuple(c[batch.num_rows - 1].as_py() for c in columns)
    if held:
        yield pa.Table.from_batches(held)
