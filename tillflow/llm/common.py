"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillflow.session import new_folder, stored

__all__ = [
    "filesystem",
    "fresh",
    "let",
    "new_folder",
    "stored",
    "sums_before",
    "word_count",
    "words",
]

#: A word is a run of anything but blanks, tabs, line ends, vertical tabs and form feeds.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Variants of ``names`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds ``uri`` (local, HDFS or an object store) and the path in it."""
    return fs.FileSystem.from_uri(uri)


def sums_before(
    df: DataFrame, order: list[str], values: dict[str, str], rows_per_piece: int = 20_000
) -> DataFrame:
    """Add, per entry ``new: column`` of ``values``, the sum of ``column`` over all rows before.

    ``order`` must be total. The rows are range-partitioned and stored, so that pieces stay as
    they are; within a piece a window sums, and one row per piece carries the sums over. No task
    sees more than a piece, or one row per piece.
    """
    rows = df.count()
    pieces = max(1, -(-rows // rows_per_piece))
    (piece,) = fresh(df, "_piece")
    placed = df.repartitionByRange(pieces, *order).withColumn(piece, F.spark_partition_id())
    placed = stored(placed, "ordered")
    inside = Window.partitionBy(piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(piece).agg(
        *[F.sum(column).alias(f"_all_{new}") for new, column in values.items()]
    )
    carried = totals.select(
        piece, *[F.coalesce(F.sum(f"_all_{new}").over(before), F.lit(0)).alias(f"_up_{new}") for new in values]
    )
    local = placed.withColumns(
        {f"_in_{new}": F.coalesce(F.sum(column).over(inside), F.lit(0)) for new, column in values.items()}
    )
    return local.join(carried, piece).select(
        *df.columns, *[(F.col(f"_in_{new}") + F.col(f"_up_{new}")).alias(new) for new in values]
    )
