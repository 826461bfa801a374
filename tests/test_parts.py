"""Large tables built in parts: the same rows, and little on disk at a time."""

from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillflow import registry
from tillflow.lakehouse import Lakehouse
from tillflow.operators import layout
from tillflow.operators.quality import DROP, FAIL, Expectation
from tillflow.plans import build, layers, shop
from tillflow.schemas import FEEDS
from tillflow.session import shared_dir
from tillflow.sources import feeds, retail

DAY = datetime.datetime(2024, 1, 1)
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def content() -> dict[str, list[tuple]]:
    """Keys that repeat, keys and values that are missing, orders without lines."""
    some = lambda i, step, value: None if i % step == 0 else value
    day = lambda i: DAY + datetime.timedelta(days=i, seconds=i)
    kinds = ["view", "click", "signup", "purchase", "error"]
    lines = [
        (some(i, 19, i % 50), i % 12, i % 3, some(i, 23, i % 4), some(i, 7, 1.0 + i % 9), some(i, 13, 10.25 * (i % 30)),
         (i % 11) / 100, 0.02, "N", "O", some(i, 29, day(i % 90)))
        for i in range(1, 301)
    ]
    orders = [(some(i, 31, i), some(i, 17, i % 25), "O", 100.0 + i, some(i, 11, day(i)), "1-URGENT") for i in range(1, 81)]
    events = [
        (i % 180, some(i, 10, day(i % 60)), some(i, 14, i % 20), some(i, 37, kinds[i % 5]), some(i, 9, i / 4), f'{{"k": {i % 100}}}')
        for i in range(1, 201)
    ]
    return {
        "region": [(0, "ASIA"), (1, "EUROPE")],
        "nation": [(i, f"NATION {i}", i % 2) for i in range(25)],
        "customer": [(i, f"Customer {i % 22}", i % 25, 1.0, "M") for i in range(25)] + [(None, None, None, None, None)],
        "part": [(i, f'"large" ring, {i}', "B", "T", 1, 900.0 + i) for i in range(10)] + [(10, None, None, None, None, None)],
        "orders": orders + orders[:3],
        "lineitem": lines + lines[:5],
        "events": events + events[:5],
    }


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("supplied")
    for name, rows in content().items():
        spark.createDataFrame(rows, TABLES[name]).coalesce(2).write.parquet(f"{top}/{name}.parquet")
    return str(top)


@pytest.fixture
def lake(spark):
    made = Lakehouse(spark)
    yield made
    made.drop()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shuffles(spark) -> set[str]:
    """The shuffle blocks on this machine's disk."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = manager.getAllBlocks().iterator()
    found = set()
    while blocks.hasNext():
        found.add(blocks.next().name())
    return {name for name in found if name.startswith("shuffle_")}


def test_the_number_of_parts_follows_the_size():
    counts = [layout.part_count(n) for n in (0, 1, layout.PART_BYTES, layout.PART_BYTES + 1, 1 << 40)]
    assert counts == [1, 1, 1, 2, layout.MOST_PARTS]


@pytest.mark.parametrize("name", list(FEEDS))
def test_parts_make_up_the_whole_feed(spark, folder, name):
    whole = rows_of(retail.feed(spark, folder, name))
    parts = [rows_of(retail.feed(spark, folder, name, (k, 3))) for k in range(3)]
    assert sorted((r for part in parts for r in part), key=repr) == whole
    assert sum(bool(part) for part in parts) > 1


def test_writes_in_parts(spark, lake):
    rows = spark.range(100).select("id", F.lit("x").alias("text"))
    even, late = Expectation("even", "id % 2 = 0", DROP), Expectation("early", "id < 90", FAIL)
    parts = (layout.part_of(rows, "id", k, 4) for k in range(4))
    stored = lake.write(parts, "bronze.numbers", rules=[even], helpers=["text"])
    assert rows_of(stored) == sorted(((n,) for n in range(0, 100, 2)), key=repr)
    line = lake.history("bronze.numbers").collect()
    assert [(r.version, r.rows, r.rows_checked, r.violations["even"]) for r in line] == [(0, 50, 100, 50)]
    with pytest.raises(Exception, match="early"):
        lake.write([rows.where("id < 90"), rows.where("id >= 90")], "bronze.numbers", rules=[late])
    assert lake.read("bronze.numbers").count() == 50 and lake.history("bronze.numbers").count() == 1
    for given, message in (([], "no part"), ([rows, rows.drop("text")], "other columns")):
        with pytest.raises(ValueError, match=message):
            lake.write(given, "bronze.numbers")
    with pytest.raises(ValueError, match="in parts"):
        lake.write([rows], "bronze.numbers", mode="append")


def test_writes_leave_no_shuffle_files_and_compress(spark, lake):
    before = shuffles(spark)
    cleanup = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    stored = lake.write(spark.range(50_000), "bronze.numbers")
    assert not shuffles(spark) - before
    assert all(".zstd." in f for f in stored.inputFiles())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == cleanup


def test_the_best_of_parts(spark, folder):
    sales = feeds.bronze(spark, registry.delivered(spark, folder, "sales"), "sales")
    parts = [layout.part_of(sales, "email", k, 4) for k in range(4)]
    whole = shop.best_customers(sales).collect()
    assert len(whole) == 10 and layers.gold_best_customers(parts).collect() == whole


def test_delivered_feeds_are_compressed_except_the_products(spark, folder):
    """The products are also cut into records in parallel, which compressed files don't allow."""
    for name, end in (("sales", ".csv.gz"), ("events", ".csv.gz"), ("products", ".csv")):
        top = Path(f"{registry.delivered(spark, folder, name)}/{name}.csv".removeprefix("file:"))
        assert {"".join(f.suffixes) for f in top.glob("part-*")} == {end}, name


QUERIES = ["dq_report", "gold_conversion_by_traffic_source", "gold_customer_ltv", "gold_top10_customers_by_ltv",
           "gold_monthly_revenue_by_product_city", "silver_events", "silver_sales_enriched", "silver_event_items",
           "audit_table_history", "raw_tables", "catalog_tables"]


def test_layers_built_in_parts_are_the_same(spark, folder, monkeypatch):
    """With every table in two parts; no part of a feed is left, and one lies there at a time."""

    def all_rows():
        monkeypatch.setattr(registry, "_built", {})
        return {name: rows_of(registry.QUERIES[name](spark, folder)) for name in QUERIES}

    whole = all_rows()
    assert all(whole.values())
    top, seen = Path(shared_dir(spark).removeprefix("file:")), []
    write = feeds.write_feed

    def watched(df, target, feed, *args, **options):
        write(df, target, feed, *args, **options)
        seen.append((feed, len(list(top.glob("*/part-of-*")))))

    monkeypatch.setattr(feeds, "write_feed", watched)
    monkeypatch.setattr(layout, "PART_BYTES", 1)
    monkeypatch.setattr(layout, "MOST_PARTS", 2)
    assert all_rows() == whole
    assert {feed for feed, _ in seen} == set(FEEDS) and {count for _, count in seen} == {1}
    assert len(seen) == 2 * len(FEEDS) * layout.MOST_PARTS
    assert not list(top.glob("*/part-of-*"))


def test_raw_tables_take_one_part_at_a_time(spark, folder, lake, tmp_path):
    """A part is stored before the next one is asked for, and each table is written once."""
    stored = []

    def source(feed):
        for number in range(3):
            place = Path(lake.root.removeprefix("file:")) / "files" / "raw" / feed
            stored.append(len([f for f in place.glob("*/*.parquet") if f.stat().st_size]))
            target = f"{tmp_path}/{feed}-{number}"
            feeds.write_feed(retail.feed(spark, folder, feed, (number, 3)), target, feed, compression="gzip")
            yield target

    build.store_raw(spark, lake, source)
    assert all(stored[k] < stored[k + 1] < stored[k + 2] for k in range(0, 3 * len(FEEDS), 3))
    for feed in FEEDS:
        whole = feeds.read_raw(spark, registry.delivered(spark, folder, feed), feed)
        assert rows_of(lake.read(f"raw.{feed}")) == rows_of(whole), feed
    assert {(r.version, r.rows) for r in lake.history("raw.sales").collect()} == {(0, lake.read("raw.sales").count())}


def test_lost_values_of_all_parts_are_kept(spark, folder, lake, tmp_path):
    """A feed with lost values is asked for a second time, and each of its parts read again."""
    asked = []

    def source(feed):
        for number in range(3):
            asked.append(feed)
            rows = retail.feed(spark, folder, feed, (number, 3))
            if feed == "products":
                rows = rows.withColumn("price", F.lit(f"word {number}"))
            target = f"{tmp_path}/{len(asked)}"
            feeds.write_feed(rows, target, feed)
            yield target

    build.store_bronze(spark, lake, source)
    assert asked.count("products") == 6 and asked.count("sales") == 3
    lost = rows_of(lake.read("quarantine.lost_values").select("source", "column", "reason"))
    assert lost == [("products", "price", "not a double")] * 11
    assert len(set(lake.read("quarantine.lost_values").select("raw").collect())) > 1
