"""How rows are laid out in files: even file sizes, work in parts and multi-column clustering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.ordered import attach
from tillflow.session import stored

#: Each column is cut into this many times more ranges than the files alone would need.
FINER = 4
#: Bytes of stored rows that go into one part, and the most parts, since each costs one scan of all rows.
PART_BYTES = 16 << 20
MOST_PARTS = 8


def compact(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Let the runtime merge small and split large output partitions before a write."""
    return df.hint("rebalance", *(columns or []))


def file_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files in ``paths``; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def part_count(stored_bytes: int) -> int:
    return min(MOST_PARTS, max(1, -(-stored_bytes // PART_BYTES)))


def part_of(df: DataFrame, key: str, number: int, count: int) -> DataFrame:
    """One of ``count`` parts of the rows, by a hash of ``key``; equal keys, and all NULL ones, are in one part.

    Work that treats each key alone may take the parts one after the other, so that only one part's
    shuffle lies on disk at a time. ``df`` is read once per part and should be stored.
    """
    return df if count == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(count)) == number)


def rank_bits(files: int, columns: int) -> int:
    """Bits of a column's rank, so that the curve has enough cells for ``files`` slices."""
    return max(2, math.ceil(math.log2(max(2, FINER * files ** (1 / columns)))))


def ranks(df: DataFrame, column: str, bits: int) -> DataFrame:
    """``column`` and ``_rank``: even ranges of its distinct values, in order; stored."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    placed = values.repartitionByRange(1 << bits, column)
    return stored(placed.withColumn("_rank", F.spark_partition_id()), "ranks")


def cluster_by(
    df: DataFrame, columns: list[str], within: list[str] | None = None, files: int | None = None
) -> DataFrame:
    """Order rows along a Z-curve over ``columns``, inside each value of ``within``.

    Each column is replaced by the rank of its value among even ranges of the distinct values, as
    many as the number of files needs, by a join whose kind the sizes decide. The rank keeps the
    order of the column, so the minimum and maximum that files store per column become narrow. The
    columns themselves end the sort key and, with a hash of the other columns, split a curve cell
    that holds many rows. ``files`` fixes the number of slices; by default it is that of the shuffle
    partitions, which the runtime merges by size. ``df`` should be cheap to read several times.
    """
    slices = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = rank_bits(slices, len(columns))
    ranked = df
    for c in columns:
        side = ranks(df, c, bits).withColumnRenamed("_rank", f"_rank_{c}")
        ranked = attach(ranked, side, [c])
    curve = ranked.withColumn(
        "_z", interleave([F.coalesce(F.col(f"_rank_{c}"), F.lit(0)) for c in columns], bits)
    )
    key = [*(within or []), "_z", *columns]
    unhashable = ("map<", "variant")
    others = [c for c, kind in df.dtypes if c not in key and not any(u in kind for u in unhashable)]
    spread = [F.xxhash64(*others)] if others else []
    sliced = curve.repartitionByRange(*([files] if files else []), *key, *spread)
    return sliced.sortWithinPartitions(*key).select(*df.columns)


def file_ranges(stored_rows: DataFrame, columns: list[str]) -> DataFrame:
    """``file, rows`` and per column ``min_c, max_c, nulls_c``: one row per file of a stored table."""
    ends = []
    for c in columns:
        ends += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    return stored_rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *ends)


def files_touched(ranges: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """For each value of ``wanted`` (one column): how many files may hold it, of how many, and their rows.

    A file may hold a value that lies between its smallest and largest one, which is what a reader that
    skips by file statistics has to open. The values are met with the ranges by a join on both ends.
    """
    (value,) = wanted.columns
    total = ranges.agg(F.count("*").alias("n")).scalar()
    inside = F.col(value).between(F.col(f"min_{column}"), F.col(f"max_{column}"))
    met = wanted.distinct().join(ranges, inside, "left")
    return met.groupBy(value).agg(
        F.count("file").alias("touched"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).withColumn("files", total)


def interleave(ranks: list[Column], bits: int) -> Column:
    """Mix the bits of several ranks into one long: the position on the Z-curve."""
    curve = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            curve = curve.bitwiseOR(F.shiftleft(one, bit * len(ranks) + place))
    return curve
