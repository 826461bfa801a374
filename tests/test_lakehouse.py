import pytest
from pyspark.sql import functions as F

from tillflow import registry
from tillflow.lakehouse import Lakehouse
from tillflow.operators.layout import cluster_by, interleave
from tillflow.plans.layers import VALID_USER
from tillflow.session import shared_dir


@pytest.fixture
def lake(spark):
    made = Lakehouse(spark)
    yield made
    made.drop()


def test_tables_lie_in_the_shared_folder(spark, lake):
    stored = lake.write(spark.range(10), "bronze.numbers", comment="It's ten numbers")
    assert stored.inputFiles()[0].replace("file://", "file:").startswith("file:" + shared_dir(spark))
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {lake.schema('bronze')}.numbers")
    assert described.where("col_name = 'Comment'").first().data_type == "It's ten numbers"


def test_overwrite_replaces_schema_and_history_grows(spark, lake):
    lake.write(spark.range(10), "bronze.numbers")
    lake.write(spark.range(3).select(F.col("id").cast("string").alias("name")), "bronze.numbers")
    lake.write(spark.range(1).select(F.lit("x").alias("name")), "bronze.numbers", mode="append")
    assert lake.read("bronze.numbers").columns == ["name"]
    assert lake.read("bronze.numbers").count() == 4
    log = lake.history("bronze.numbers").orderBy("version").collect()
    assert [(r.version, r.mode, r.rows) for r in log] == [
        (0, "overwrite", 10),
        (1, "overwrite", 3),
        (2, "append", 1),
    ]
    assert '"name":"name"' in log[1].schema_json


def test_empty_tables(spark, lake):
    empty = spark.range(5).selectExpr("string(id) AS user_id", "'m' AS month").where("user_id = 'none'")
    assert lake.write(empty, "bronze.nobody", rules=[VALID_USER]).count() == 0
    laid = {"partition_by": ["month"], "cluster_by": ["user_id"]}
    assert lake.write(empty, "gold.nobody", rules=[VALID_USER], **laid).count() == 0
    assert {(r.rows, r.violations["valid_user"]) for r in lake.history().collect()} == {(0, 0)}


def test_rows_per_file(spark, lake):
    stored = lake.write(spark.range(100), "bronze.many", rows_per_file=10)
    assert len(stored.inputFiles()) >= 10 and stored.count() == 100


def test_table_listing(spark, lake):
    lake.write(spark.range(2), "bronze.a")
    lake.write(spark.range(2), "gold.b")
    listed = {(r.layer, r.table) for r in lake.tables().collect()}
    assert listed == {("bronze", "a"), ("gold", "b"), ("audit", "table_history")}


def test_interleave(spark):
    row = spark.range(1).select(interleave([F.lit(0b11), F.lit(0b01)], 2).alias("z")).first()
    assert row.z == 0b0111


def grid(spark):
    return spark.range(40_000).select(
        F.lit("2024-01").alias("month"),
        F.concat(F.lit("i"), F.pmod(F.hash("id"), F.lit(300))).alias("item"),
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("c"), F.pmod(F.hash("id", F.lit(1)), F.lit(200)))).alias("city"),
        "id",
    )


def test_clustering_keeps_rows_and_narrows_both_columns(spark):
    df = grid(spark)
    laid = cluster_by(df, ["item", "city"], ["month"], files=8)
    assert laid.exceptAll(df).count() == 0 and laid.count() == df.count()

    def spread(frame):
        """Average share of each column's distinct values that a file-sized slice covers."""
        part = frame.withColumn("p", F.spark_partition_id()).groupBy("p")
        row = part.agg(F.count_distinct("item").alias("i"), F.count_distinct("city").alias("c")).agg(
            F.avg(F.col("i") / 300), F.avg(F.col("c") / 200)
        )
        return row.first()

    item, city = spread(laid)
    assert item < 0.7 and city < 0.7
    assert min(spread(df.repartition(8))) > 0.9


def test_clustered_write(spark, lake):
    stored = lake.write(
        grid(spark), "gold.grid", partition_by=["month"], cluster_by=["item", "city"]
    )
    assert stored.count() == 40_000
    assert lake.history("gold.grid").first().rows == 40_000


def test_reopened_lake_lists_its_tables(spark, lake):
    lake.write(spark.range(2), "bronze.a")
    again = Lakehouse(spark, lake.root, lake.prefix)
    assert ("bronze", "a") in {(r.layer, r.table) for r in again.tables().collect()}
    assert Lakehouse(spark).tables().count() == 0


def test_files_outlive_the_catalog(spark):
    lake = Lakehouse(spark)
    lake.write(spark.range(5), "gold.kept")
    kept = lake.files("gold.kept")
    lake.drop()
    assert kept.count() == 5
    assert spark.sql(f"SHOW SCHEMAS LIKE '{lake.prefix}*'").count() == 0


def test_queries_leave_no_schema_and_see_their_own_folder(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("customer", "orders", "lineitem", "events", "nation", "region", "part"):
        for side, share in (("a", 1.0), ("b", 0.5)):
            rows = spark.read.parquet(f"{source}/{name}.parquet")
            rows = rows if name != "part" else rows.where(F.col("p_partkey") <= 200 * share)
            rows.write.parquet(f"{tmp_path}/{side}/x/{name}.parquet")
    before = spark.sql("SHOW SCHEMAS").count()
    counts = [registry.QUERIES["bronze_products"](spark, f"{tmp_path}/{s}/x").count() for s in "ab"]
    assert counts[0] == 200 and 90 < counts[1] < 110
    listed = registry.QUERIES["catalog_tables"](spark, f"{tmp_path}/b/x").collect()
    assert {r.table: r.rows for r in listed}["products"] == counts[1]
    assert spark.sql("SHOW SCHEMAS").count() == before
