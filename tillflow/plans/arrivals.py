"""Feeds that keep growing: every file is taken in once.

``audit.files_taken`` lists the files of each batch by path, size and time; a file that differs in one of
them is a new one. A batch is planned (its files listed), then its rows are written as one partition of
the bronze table, then it is marked as done in ``audit.batches_done``. Both lists are single appends. A run
that was stopped in between is found by its plan without a mark, and the same files are written to the
same partition again before anything new is planned, so rows are neither lost nor doubled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.lakehouse import AUDIT, Lakehouse
from tillflow.plans import layers
from tillflow.session import stored
from tillflow.sources import feeds, quarantine

TAKEN = f"{AUDIT}.files_taken"
DONE = f"{AUDIT}.batches_done"
FILE = ["path", "bytes", "modified"]
TAKEN_KIND = "feed string, batch string, path string, bytes bigint, modified timestamp"


def listing(spark: SparkSession, folder: str, feed: str) -> DataFrame:
    """``path, bytes, modified`` of a feed's files; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/{feed}.csv")
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _known(spark: SparkSession, lake: Lakehouse, table: str, kind: str) -> DataFrame:
    there = spark.catalog.tableExists(lake._full(table))
    return lake.read(table) if there else spark.createDataFrame([], kind)


def new_files(spark: SparkSession, lake: Lakehouse, folder: str, feed: str) -> DataFrame:
    taken = _known(spark, lake, TAKEN, TAKEN_KIND).where(F.col("feed") == feed)
    return listing(spark, folder, feed).join(taken, FILE, "left_anti")


def unfinished(spark: SparkSession, lake: Lakehouse, feed: str) -> list[str]:
    """Batches that were planned and not marked as done."""
    taken = _known(spark, lake, TAKEN, TAKEN_KIND).where(F.col("feed") == feed).select("batch").distinct()
    done = _known(spark, lake, DONE, "feed string, batch string").where(F.col("feed") == feed)
    return sorted(r.batch for r in taken.join(done, "batch", "left_anti").collect())


def plan_batch(spark: SparkSession, lake: Lakehouse, folder: str, feed: str) -> str | None:
    """List the new files as a batch; its name, or None if there are none."""
    batch = uuid.uuid4().hex[:12]
    files = stored(new_files(spark, lake, folder, feed), "arrived")
    if files.isEmpty():
        return None
    lines = files.select(F.lit(feed).alias("feed"), F.lit(batch).alias("batch"), *FILE)
    lake.write(lines.coalesce(1), TAKEN, mode="append")
    return batch


def write_batch(spark: SparkSession, lake: Lakehouse, folder: str, feed: str, batch: str, multi_line: bool) -> int:
    """Write a planned batch's rows, and the values lost in them, and mark it as done; the rows written."""
    listed = lake.read(TAKEN).where((F.col("feed") == feed) & (F.col("batch") == batch))
    files = [r.path for r in listed.select("path").collect()]  # as a reader of files needs them
    rows = feeds.checked(spark, folder, feed, multi_line, files).withColumn("batch", F.lit(batch))
    table, rules = f"bronze.{feed}", layers.RULES[f"bronze_{feed}"]
    place = {"mode": "partitions", "partition_by": ["batch"]}
    lake.write(rows, table, rules=rules, helpers=[quarantine.LOST], **place)
    last = lake.history(table).orderBy(F.desc("version")).first()
    if last.violations[layers.VALUES_FIT.name]:
        lost = feeds.quarantined(spark, folder, feed, multi_line, files).withColumn("batch", F.lit(batch))
        lake.write(lost, f"quarantine.{feed}", **place)
    mark = spark.range(1).select(F.lit(feed).alias("feed"), F.lit(batch).alias("batch"))
    lake.write(mark.coalesce(1), DONE, mode="append")
    return last.rows


def take_in(spark: SparkSession, lake: Lakehouse, folder: str, feed: str, multi_line: bool = True) -> int:
    """Add the files that were not taken in yet to ``bronze.<feed>``; how many rows were written."""
    rows = sum(
        write_batch(spark, lake, folder, feed, batch, multi_line) for batch in unfinished(spark, lake, feed)
    )
    batch = plan_batch(spark, lake, folder, feed)
    return rows + (write_batch(spark, lake, folder, feed, batch, multi_line) if batch else 0)
