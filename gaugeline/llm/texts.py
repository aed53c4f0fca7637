"""Whole-text helpers for Arrow batches: byte views, bounded slices, ragged gathers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gaugeline.ship import ship

#: Texts are worked on in slices of whole rows of about so many bytes (a longer text is one slice).
SLICE_BYTES = 6 << 20
#: The same for work that holds many numbers a byte of text, such as statistics: a worker's peak follows the slice, and
#: a worker for each core stands beside the executor's heap.
SMALL_SLICE = 1 << 20

#: What tasks share in a Python worker, such as encoders with the pieces they remember.
shared: dict[str, object] = {}

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def table_of(*names: str) -> np.ndarray:
    """A look-up table over bytes that is true for the characters of the given strings."""
    table = np.zeros(256, bool)
    table[list("".join(names).encode())] = True
    return table


def filled(column: pa.Array) -> pa.Array:
    """The texts as 32-bit strings, null as empty."""
    return pc.fill_null(column.cast(pa.string()), "")


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one entry more at the end)."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of ``values`` over each range between neighbouring offsets."""
    kind = np.result_type(np.asarray(values).dtype, np.int64)
    out = np.zeros(len(offsets) - 1, kind)
    some = offsets[1:] > offsets[:-1]
    if some.any():
        out[some] = np.add.reduceat(values[: offsets[-1]], offsets[:-1][some], dtype=kind)
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all given ranges, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def strings(parts: list[str]) -> pa.Array:
    return pa.array(parts, pa.string())


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that the texts of each part stay near ``limit`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Return memory that is no longer used to the system. Workers outlive their tasks; what the allocators have kept
    would stand beside the next stages' memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def let_go() -> None:
    """Drop what earlier tasks of this worker share."""
    if shared:
        shared.clear()
        give_back()


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema, column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``work`` to bounded slices of whole texts, inside the tasks that read them. What a worker's earlier
    tasks share is let go before."""
    ship(df.sparkSession)
    kind = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for part in slices(batches, column, limit):
            done = work(part)
            if done.num_rows:
                yield done.cast(kind) if done.schema != kind else done
            del done
        give_back()

    return df.mapInArrow(run, schema)


def pa_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(schema if isinstance(schema, StructType) else StructType.fromDDL(schema))


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()], list(columns)
    )
