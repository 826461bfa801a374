"""Vectors as fixed-width rows of whole numbers: choosing the usable ones, packing and reading them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Larger whole numbers than this are refused: sums of their squares would leave the 64-bit range.
LARGEST = 1 << 40


def all_finite(vector: Column) -> Column:
    """The vector is there and holds neither NULL nor NaN nor an infinite entry."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def usual_size(vectors: DataFrame, vector_column: str) -> int:
    """The most frequent length of the vectors (ties: the longer one); 0 if there is none."""
    sizes = vectors.groupBy(F.size(vector_column).alias("size")).count().where("size > 0")
    top = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return top[0]["size"] if top else 0


def usable(vectors: DataFrame, id_column: str, vector_column: str, size: int | None) -> tuple[DataFrame, int]:
    """``id bigint, vector array<double>`` of the finite vectors of one length, and that length."""
    kept = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    ).where(all_finite(F.col("vector")))
    size = usual_size(kept, "vector") if size is None else size
    return kept.where((F.size("vector") == size) & (F.size("vector") > 0)), size


def whole_rows(column: pa.Array, size: int, scale: float, plus: int = 0, largest: int = LARGEST) -> np.ndarray:
    """``floor(scale * entry) + plus`` of every entry, one row per vector.

    Raises an error if a number is larger than ``largest`` can tell apart exactly.
    """
    flat = np.asarray(pc.list_flatten(column), np.float64)
    whole = np.floor(flat * scale)
    if len(whole) and np.abs(whole).max() > largest:
        raise ValueError(f"a vector's entry times {scale} exceeds {largest}")
    return whole.astype(np.int64).reshape(-1, size) + plus


def to_binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes, as a binary column."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * rows.shape[1]
    places = np.arange(len(rows) + 1, dtype=np.int64) * width
    large = pa.Array.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(places), pa.py_buffer(rows.tobytes())]
    )
    return large.cast(pa.binary())


def from_binary(column: pa.Array, size: int, kind: str = "<i8") -> np.ndarray:
    """The rows that ``to_binary`` packed."""
    large = column.cast(pa.large_binary())
    if not len(large):
        return np.zeros((0, size), kind)
    places = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = np.frombuffer(large.buffers()[2], np.uint8)[places[0] : places[-1]]
    return data.view(kind).reshape(-1, size)


def packed(kept: DataFrame, size: int, scale: float, plus: int = 0) -> DataFrame:
    """``id, x``: the vectors as 64-bit whole numbers, little end first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_rows(batch.column(1), size, scale, plus).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), to_binary(x)], names=["id", "x"])

    return kept.select("id", "vector").mapInArrow(pack, "id bigint, x binary")
