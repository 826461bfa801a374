"""Silver and gold tables over the typed feeds, and their expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import item_rows, month_of, sum_of
from tillflow.operators.quality import DROP, FAIL, KEEP, Expectation, enforce
from tillflow.operators.rows import distinct_rows, one_per_key
from tillflow.plans import shop, traffic
from tillflow.schemas import PURCHASE

HAS_ITEMS = Expectation("has_items", "size(items) > 0", KEEP)
VALID_USER = Expectation("valid_user", "user_id IS NOT NULL", DROP)
KNOWN_TIME = Expectation("non_null_ts", "event_timestamp IS NOT NULL", KEEP)
VALID_ORDER = Expectation("valid_order", "order_id IS NOT NULL", DROP)
POSITIVE_VALUE = Expectation("positive_clv", "clv >= 0", FAIL)

#: No value of the row was lost when its text got its type.
VALUES_FIT = Expectation("values_fit", "size(_lost) = 0", KEEP)

RULES = {
    "bronze_users": [VALUES_FIT],
    "bronze_products": [VALUES_FIT],
    "bronze_sales": [VALUES_FIT, HAS_ITEMS],
    "bronze_events": [VALUES_FIT],
    "silver_events": [VALID_USER, KNOWN_TIME],
    "silver_sales_enriched": [VALID_ORDER],
    "gold_customer_ltv": [POSITIVE_VALUE],
}


def silver_events_checked(bronze_events: DataFrame) -> DataFrame:
    """Events without exact repetitions, before the expectations; the input is read twice."""
    return distinct_rows(bronze_events)


def silver_events(bronze_events: DataFrame) -> DataFrame:
    return enforce(silver_events_checked(bronze_events), RULES["silver_events"])


def silver_sales_checked(bronze_sales: DataFrame, bronze_products: DataFrame) -> DataFrame:
    """One sale per order id, at item grain, beside the catalog, before the expectations."""
    details = bronze_products.select(
        "item_id", F.col("name").alias("product_name"), F.col("price").alias("product_price")
    )
    once = one_per_key(bronze_sales, ["order_id"])
    return item_rows(once, *shop.SALE).join(details, "item_id", "left")


def silver_sales_enriched(bronze_sales: DataFrame, bronze_products: DataFrame) -> DataFrame:
    return enforce(
        silver_sales_checked(bronze_sales, bronze_products), RULES["silver_sales_enriched"]
    )


def silver_event_items(silver_events: DataFrame) -> DataFrame:
    """Items of the cleaned events with their city."""
    return item_rows(silver_events, *traffic.EVENT, "geo.city")


def gold_monthly_revenue(event_items: DataFrame) -> DataFrame:
    """Purchase revenue by month, item and city."""
    return (
        event_items.where(F.col("event_name") == PURCHASE)
        .groupBy(month_of("event_timestamp").alias("month"), "item_id", "city")
        .agg(sum_of("item_revenue_in_usd").alias("revenue"))
    )


def gold_best_customers(bronze_sales: DataFrame | list[DataFrame]) -> DataFrame:
    """Of all sales, or of parts that share no buyer."""
    return shop.best_of_parts([bronze_sales] if isinstance(bronze_sales, DataFrame) else bronze_sales)


def gold_conversion(silver_events: DataFrame) -> DataFrame:
    return traffic.conversion_by_source(silver_events)


def gold_customer_ltv(bronze_sales: DataFrame) -> DataFrame:
    return enforce(shop.customer_value(bronze_sales), RULES["gold_customer_ltv"])
