"""Duplicates, newest rows, anti-joins and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tillflow.session import drop_folder, new_folder, shuffles_dropped


def first_rows(df: DataFrame, keys: list[str], order: list[Column | str], count: int = 1) -> DataFrame:
    """The first ``count`` rows of each key along ``order``, which should be total.

    The rank filter lets Spark cut each key before the shuffle, so a frequent key
    sends ``count`` rows per map task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= count).drop("_place")


def one_per_key(df: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """Drop duplicates by key, keeping the first row along ``order`` (default: all other columns).

    NULL keys count as one key.
    """
    return first_rows(df, keys, order or [c for c in df.columns if c not in keys])


#: Share of repeated rows from which moving all of them once is cheaper than picking them out.
MOST_REPEATED = 0.1


def _comparable(kind: T.DataType, value: Column) -> Column:
    """A value as text that differs whenever the value does, with NULL apart from every text."""
    if isinstance(kind, T.StructType):
        parts = [_comparable(f.dataType, value[f.name]) for f in kind.fields]
        whole = F.concat(F.lit("("), *parts, F.lit(")"))
    elif isinstance(kind, T.ArrayType):
        parts = F.transform(value, lambda x: _comparable(kind.elementType, x))
        whole = F.concat(F.lit("["), F.array_join(parts, ""), F.lit("]"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        # Two zeros are one value, and so are all NaN.
        whole = F.when(value == 0, F.lit("0")).otherwise(value.cast("string"))
    elif isinstance(kind, T.BinaryType):
        whole = F.hex(value)
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(value).cast("string")
    else:
        whole = value.cast("string")
    return F.coalesce(F.concat(F.char_length(whole).cast("string"), F.lit(":"), whole), F.lit("-"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates dropped; only rows whose digest occurs again are shuffled.

    Pass one counts 128-bit digests, which are all that it moves. Rows whose digest is alone pass
    straight through; of the others, those that agree in every column are dropped as usual, so a chance
    collision costs nothing but the move. Where more than ``MOST_REPEATED`` of the rows occur again, all
    rows are compared as usual. ``df`` is read twice and should be stored. Maps can't be
    compared, here as in Spark. The digests stay on disk only if the result needs them.
    """
    spark = df.sparkSession
    text = F.concat(*[_comparable(f.dataType, F.col(f"`{f.name}`")) for f in df.schema.fields])
    digest = F.unhex(F.md5(text)) if df.columns else F.lit(None).cast("binary")
    marked = df.withColumn("_digest", digest)
    place = new_folder(spark, "digests")
    with shuffles_dropped(spark):
        marked.groupBy("_digest").agg(F.count("*").alias("_often")).write.parquet(place)
    counted = spark.read.schema("_digest binary, _often bigint").parquet(place)
    again = counted.where("_often > 1")
    total, often = counted.agg(F.sum("_often"), F.sum(F.when(F.col("_often") > 1, F.col("_often")))).first()
    if not often or often > MOST_REPEATED * total:
        drop_folder(spark, place)
        return df.dropDuplicates() if often else df
    again = again.select("_digest")
    alone = marked.join(again, "_digest", "left_anti").select(*df.columns)
    often = marked.join(again, "_digest", "left_semi").select(*df.columns)
    return alone.unionAll(often.dropDuplicates())


def repeated(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Keys that occur more than once, with their ``occurrence``."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrence")).where("occurrence > 1")


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``.

    The other side is reduced to its distinct keys before the join, so that a
    frequent key crosses the network once per task and not once per row.
    """
    seen = other.select(key).where(F.col(key).isNotNull()).distinct()
    return df.join(seen, key, "left_anti")


def streaks(df: DataFrame, key: str, day: str, least: int) -> DataFrame:
    """Runs of at least ``least`` consecutive days: ``key, streak_start, streak_days``.

    After the distinct a key has at most one row per calendar day, which bounds
    the window.
    """
    days = df.select(key, day).where(F.col(day).isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return (
        days.withColumn("_run", F.date_sub(day, place))
        .groupBy(key, "_run")
        .agg(F.min(day).alias("streak_start"), F.count("*").alias("streak_days"))
        .where(F.col("streak_days") >= least)
        .drop("_run")
    )
