"""Plan shapes that matter for large data."""

import pytest
from pyspark.sql import functions as F

from tillflow import registry, schemas
from tillflow.functions import each_item
from tillflow.plans import company, shop, traffic
from tillflow.sources import retail

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_year_reaches_the_scan(spark):
    text = plan(registry.QUERIES["sql01_customer_revenue"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in text
    assert "LessThan(o_orderdate,1" in text


def test_aggregate_comes_before_the_join(spark, no_broadcast):
    text = plan(registry.QUERIES["sql01_customer_revenue"](spark, FOLDER))
    assert text.index("Join") < text.index("HashAggregate")
    text = plan(registry.QUERIES["sql05_customers_no_orders"](spark, FOLDER))
    assert "LeftAnti" in text and "HashAggregate" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(registry.QUERIES["nb_revenue_per_user"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_rank_is_cut_before_the_shuffle(spark):
    text = plan(company.recent_orders(retail.orders(spark, FOLDER)))
    assert text.count("WindowGroupLimit") == 2
    assert "Partial" in text[text.index("Exchange hashpartitioning(customer_id") :]


def test_growth_reads_sales_once(spark):
    text = plan(registry.QUERIES["sql06_category_growth"](spark, FOLDER))
    assert text.count("lineitem.parquet") == 1


def test_conversion_is_one_pass_without_expand(spark):
    text = plan(traffic.conversion_by_source(retail.events(spark, FOLDER)))
    assert text.count("events.parquet") == 1
    assert "Expand" not in text and "Join" not in text
    assert "hashpartitioning(traffic_source#" in text and "user_id#" in text


def test_distinct_orders_of_a_hot_buyer_are_spread(spark):
    """The first shuffle goes by buyer and order, the second sees one row per buyer and task."""
    text = plan(registry.QUERIES["nb_clv"](spark, FOLDER))
    first = text.rindex("Exchange hashpartitioning")
    assert "order_id" in text[first : first + 120]


def test_places_are_joined_only_when_read(spark):
    for name, joins in {"nb_monthly_events": False, "nb_revenue_per_source": False, "nb_revenue_by_state": True}.items():
        assert ("Join" in plan(registry.QUERIES[name](spark, FOLDER))) is joins, name


def test_top_k(spark):
    assert "TakeOrderedAndProject" in plan(shop.best_customers(retail.sales(spark, FOLDER)))


def test_names_are_joined_after_the_aggregate(spark, no_broadcast):
    text = plan(registry.QUERIES["nb_purchases_per_user"](spark, FOLDER))
    assert text.index("Join") < text.index("HashAggregate")


def test_newest_date_is_a_subquery(spark):
    assert "Subquery" in plan(shop.recency(retail.purchases(spark, FOLDER), retail.BUYER))


def test_one_scan_each(spark):
    text = plan(registry.QUERIES["nb_product_corr"](spark, FOLDER))
    assert text.count("lineitem.parquet") == 1
    text = plan(registry.QUERIES["nb_purchase_frequency"](spark, FOLDER))
    assert "Expand" not in text


def test_no_cross_joins_or_python(spark):
    for name, run in registry.QUERIES.items():
        if name.startswith(("sql", "nb", "silver")):
            text = plan(run(spark, FOLDER))
            for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
                assert word not in text, (name, word)


def test_unpartitioned_windows_see_aggregates_only(spark):
    """A single-partition exchange may only follow an aggregate."""
    for name, run in registry.QUERIES.items():
        if name.startswith(("sql", "nb", "silver")):
            lines = plan(run(spark, FOLDER)).splitlines()
            for at, line in enumerate(lines):
                if "Exchange SinglePartition" in line:
                    assert any("Aggregate" in below for below in lines[at + 1 : at + 3]), name


def test_stored_items_are_read_by_field(spark, tmp_path):
    path = str(tmp_path / "sales")
    retail.baskets(spark, FOLDER).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.schema["items"].dataType.simpleString() == schemas.ITEMS
    text = plan(each_item(stored, ["item_id", "quantity"]).groupBy("item_id").agg(F.sum("quantity")))
    assert "ReadSchema: struct<items:array<struct<item_id:string,quantity:bigint>>>" in text
