"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space and upper-case letters, as the contracts state them.
SPACE = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_batch(function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable:
    """A mapInArrow function out of one that turns a batch into batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return tidy(run, keeps)


def give_back() -> None:
    """Return what this worker no longer uses to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


#: How to empty the tables that operators keep in a worker from one task to the next.
TABLES: dict[str, Callable[[], None]] = {}


def tidy(function: Callable[[Iterator], Iterator], keeps: str = "") -> Callable[[Iterator], Iterator]:
    """A mapInArrow function whose task gives memory back when it begins and when
    it ends: a worker serves the tasks of many stages, and each would find the peak
    of those before it still taken. Tables that other operators have left go first; those
    of ``keeps`` stay for its next task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, empty in TABLES.items():
            if name != keeps:
                empty()
        give_back()
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def encoded(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, empty for null, without decoding."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def crc_of_id(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def sliced(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts begin within the same ``size`` bytes; a text over that stands alone or last."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    starts = np.flatnonzero(np.diff(ends // size, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in a row and where each begins and the last ends; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def unflat(data: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of binary or text out of what ``flat`` gives; bytes are not looked at."""
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype("<i4")), pa.py_buffer(np.ascontiguousarray(data))])


def tidy_group(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for an applyInArrow function: memory goes back after each group."""

    def run(group: pa.Table) -> pa.Table:
        try:
            return function(group)
        finally:
            give_back()

    return run
