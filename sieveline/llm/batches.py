"""Arrow-batch plumbing shared by the operators of this subpackage.

Spark bounds what it puts into a batch by rows and by bytes (64 MB unless the session says otherwise);
workers cut it into slices, so what they make of a text is bounded by SLICE_BYTES or the longest text.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are worked on at a time; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


_LIBC = ctypes.CDLL(None)
#: What this worker remembers between tasks: functions that forget it.
CACHES: list[Callable[[], None]] = []


def forget() -> None:
    """Drop what other operators left in this worker's memory."""
    for clear in CACHES:
        clear()
    trim()


def trim() -> None:
    """Give memory that is free back to the system: workers live on from one stage to the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), offsets - (offsets[0] if len(offsets) else 0)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each."""
    _, offsets = utf8(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def map_text(
    df: DataFrame,
    text: str,
    fn: Callable[[pa.Array], dict[str, pa.Array]],
    fields: list[T.StructField],
    carry: list[str],
    keep_text: bool = False,
) -> DataFrame:
    """Carry columns plus the columns that ``fn`` makes of each slice of the text column, row for row.

    Only the named columns are read. A computed field replaces a carried column of the same name.
    """
    made = {f.name for f in fields}
    carry = [c for c in dict.fromkeys(carry) if c not in made and c != text]
    if keep_text:
        carry = [*carry, text]
    kinds = df.schema
    narrow = df.select(
        F.col(f"`{text}`").cast("string").alias("_t"), *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry) if c != text)
    )
    others = [(i, c) for i, c in enumerate(carry) if c != text]
    names = [f"_{i}" for i, _ in others] + (["_t"] if keep_text else []) + [f.name for f in fields]
    inner = T.StructType(
        [T.StructField(f"_{i}", kinds[c].dataType) for i, c in others]
        + ([T.StructField("_t", T.StringType())] if keep_text else [])
        + fields
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for part in slices(whole, 0):
                out = fn(part.column(0))
                columns = [part.column(k + 1) for k in range(len(others))] + ([part.column(0)] if keep_text else [])
                yield pa.RecordBatch.from_arrays(columns + [out[f.name] for f in fields], names=names)
            pa.default_memory_pool().release_unused()

    out = narrow.mapInArrow(run, inner)
    back = [F.col(f"_{i}").alias(c) for i, c in others] + ([F.col("_t").alias(text)] if keep_text else [])
    return out.select(*back, *(F.col(f"`{f.name}`") for f in fields))


def long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def nested(values: list[np.ndarray] | list[list], kind: pa.DataType) -> pa.Array:
    """A list column from one array or list for each row."""
    sizes = np.fromiter((len(v) for v in values), np.int64, len(values))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([np.asarray(v) for v in values if len(v)]) if sizes.sum() else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat).cast(kind))
