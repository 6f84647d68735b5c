"""Arrow batches of texts as numpy views, cut into pieces of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Bytes of text that a numpy pass works on at a time. Eight-byte arrays over it stay in the cache,
# and a worker needs a few tens of MB whatever a batch holds. A longer text is a piece by itself.
PIECE_BYTES = 1 << 19


# Bytes of a batch that Spark sends to a Python worker at a time. Its default suits narrow rows; of
# whole texts a JVM would hold several times that outside its heap, for every running task.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of this session's Python operators, unless they are smaller already."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = (int(ends[0]), int(ends[-1])) if len(ends) else (0, 0)
    values = np.frombuffer(data, dtype=np.uint8)[first:last] if data else np.empty(0, np.uint8)
    return values, ends - first


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    rows, begin = len(offsets) - 1, 0
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), rows)
        yield begin, end
        begin = end


def release_memory() -> None:
    """Gives memory that is no longer used back to the system, at the end of a task's batches.

    Workers are used again and outlive their tasks, so what their allocators keep adds up beside the JVM.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def text_pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)`` of bounded slices of the batches."""
    for batch in batches:
        values, offsets = utf8(batch.column(text))
        for begin, end in pieces(offsets, limit):
            ends = offsets[begin : end + 1]
            yield (
                batch.slice(begin, end - begin),
                values[int(ends[0]) : int(ends[-1])],
                ends - ends[0],
            )
    batch = values = offsets = ends = None
    release_memory()


def rows_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            value if isinstance(value, pa.Array) else pa.array(value, type=field.type)
            for field, value in ((field, columns[field.name]) for field in schema)
        ],
        schema=schema,
    )


def plain(df: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """``(doc_id, text)`` and the named columns: whatever else a table holds stays out of the way."""
    from pyspark.sql import functions as F

    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *others)


def strings(column: pa.Array) -> Sequence[str]:
    """Python strings; null counts as empty."""
    return pc.fill_null(column, "").to_pylist()
