"""Files taken in once, file skipping, and duplicates by digest."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tillflow.lakehouse import Lakehouse
from tillflow.operators import layout, rows
from tillflow.plans import arrivals, layers


@pytest.fixture
def lake(spark):
    made = Lakehouse(spark)
    yield made
    made.drop()


def deliver(folder, name: str, *items: tuple):
    place = folder / "products.csv"
    place.mkdir(exist_ok=True)
    (place / name).write_text("item_id,name,price\n" + "".join(f'{i},"{n}",{p}\n' for i, n, p in items))


def ids(lake):
    return sorted(r.item_id for r in lake.read("bronze.products").collect())


def test_files_are_taken_once(spark, lake, tmp_path):
    folder = str(tmp_path)
    deliver(tmp_path, "one.csv", ("a", "A", 1.5), ("b", "B\nb", 2.5))
    assert arrivals.take_in(spark, lake, folder, "products") == 2
    assert arrivals.take_in(spark, lake, folder, "products") == 0
    deliver(tmp_path, "two.csv", ("c", "C", "cheap"))
    deliver(tmp_path, "three.csv", ("d", "D", 4))
    assert arrivals.take_in(spark, lake, folder, "products") == 2
    assert ids(lake) == ["a", "b", "c", "d"]
    log = lake.history("bronze.products").orderBy("version").collect()
    assert [(r.mode, r.rows, r.violations) for r in log] == [
        ("partitions", 2, {"values_fit": 0}), ("partitions", 2, {"values_fit": 1}),
    ]
    assert [(r.column, r.raw) for r in lake.read("quarantine.products").collect()] == [("price", "cheap")]
    assert lake.read(arrivals.TAKEN).count() == 3
    deliver(tmp_path, "three.csv", ("d", "D", 4), ("e", "E", 5))  # changed: a new file
    assert arrivals.take_in(spark, lake, folder, "products") == 2
    assert ids(lake) == ["a", "b", "c", "d", "d", "e"]


def test_stopped_runs_are_finished_first(spark, lake, tmp_path, monkeypatch):
    """Stopped after the plan, and after the rows were written: nothing is lost or doubled."""
    folder, write = str(tmp_path), Lakehouse.write
    deliver(tmp_path, "one.csv", ("a", "A", 1))
    for stop_at in ("bronze.products", arrivals.DONE):

        def stopping(self, df, table, **options):
            if table == stop_at:
                raise RuntimeError("stopped")
            return write(self, df, table, **options)

        monkeypatch.setattr(Lakehouse, "write", stopping)
        with pytest.raises(RuntimeError, match="stopped"):
            arrivals.take_in(spark, lake, folder, "products")
        monkeypatch.undo()
    assert len(arrivals.unfinished(spark, lake, "products")) == 1
    deliver(tmp_path, "two.csv", ("b", "B", 2))
    assert arrivals.take_in(spark, lake, folder, "products") == 2
    assert ids(lake) == ["a", "b"] and arrivals.unfinished(spark, lake, "products") == []


def test_clustering_lets_filters_skip_files(spark, lake):
    """Before clustering every file may hold a value; after it, a share near the curve's promise."""
    df = spark.range(60_000).select(
        F.concat(F.lit("i"), F.pmod(F.hash("id"), F.lit(400))).alias("item"),
        F.concat(F.lit("c"), F.pmod(F.hash("id", F.lit(1)), F.lit(300))).alias("city"),
        "id",
    )
    plain = lake.write(df, "gold.plain", rows_per_file=4000)
    laid = layout.cluster_by(df, ["item", "city"], files=16)
    path = f"{lake.root}/clustered"
    laid.write.parquet(path)
    clustered = spark.read.parquet(path)
    for column in ("item", "city"):
        wanted = df.select(column).distinct().limit(50)

        def share(stored_rows):
            found = layout.files_touched(layout.file_ranges(stored_rows, ["item", "city"]), wanted, column)
            return found.agg(F.avg(F.col("touched") / F.col("files"))).first()[0]

        assert share(plain) == 1.0
        assert share(clustered) <= 0.5
    ranges = layout.file_ranges(clustered, ["item"]).collect()
    assert len(ranges) == 16 and sum(r.rows for r in ranges) == 60_000
    none = spark.createDataFrame([("zzz",)], "item string")
    assert layout.files_touched(layout.file_ranges(clustered, ["item"]), none, "item").first()[1:3] == (0, 0)


SCHEMA = "a string, b double, t timestamp, s struct<x:string,y:bigint>, l array<struct<k:string,v:double>>, z binary"


def test_duplicates_by_digest(spark):
    moment = datetime.datetime(2020, 1, 2, 3, 4, 5, 6)
    one = ("a", 1.0, moment, ("x", 1), [("k", 2.0), (None, None)], b"\x00\xff")
    data = [
        one, one, one,
        (None, None, None, None, None, None), (None, None, None, None, None, None),
        ("", 0.0, None, (None, None), [], b""), ("", -0.0, None, (None, None), [], b""),
        ("", 0.0, None, None, [], b""), ("", 0.0, None, (None, None), None, b""),
        ("-", float("nan"), moment, ("", None), [None], None), ("-", float("nan"), moment, ("", None), [None], None),
        ("1:a", 1.5, None, ("1:", 2), [("", None)], None), ("1", 1.5, None, (":1:", 2), [(None, None)], None),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows.distinct_rows(df)
    assert got.schema == df.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.dropDuplicates().collect()))
    assert rows.distinct_rows(df.limit(0)).count() == 0


def test_only_repeated_rows_are_shuffled(spark):
    df = spark.range(5000).select("id", F.repeat(F.lit("x"), 200).alias("text"))
    doubled = df.unionAll(df.where("id < 5"))
    got = rows.distinct_rows(doubled)
    assert got.count() == 5000
    assert "HashAggregate" not in rows.distinct_rows(df)._jdf.queryExecution().optimizedPlan().toString()


def test_silver_events_use_it(spark):
    assert "distinct_rows" in layers.silver_events_checked.__code__.co_names
