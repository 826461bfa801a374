"""Session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort where every shuffled partition is known to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tillflow")
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` or ``local[...]`` session may fall back to a temporary folder: elsewhere,
    ``local-cluster`` included, such a folder would exist on one machine and be lost with it.
    A path without a scheme lies there in the default file system, as for Spark's own checkpoints, and
    is given with its scheme; a ``file:`` path is taken as named, for a mount that all machines share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    alone = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        if not alone and ":" not in folder:
            # Spark has resolved the path, and added a folder of its own at the end.
            folder = spark.sparkContext.getCheckpointDir().rpartition("/")[0]
        return folder.rstrip("/")
    if not alone:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tillflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Makes Spark remove a query's shuffle files when it ends, and not when its plan is collected as garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run in here leave no shuffle files behind; a frame that runs again computes them again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, below one folder per application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tillflow-{app}/{name}-{uuid.uuid4().hex[:12]}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: short lineage, known size."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
