"""The supplied order, part and event tables seen as the retail data model.

An order's lines are not collected into one array, since one order may hold a
large part of all lines. A *sale* is one order line, with an ``items`` array of
one element (NULL for an order without lines); events carry arrays of two, one
or no elements. ``email`` is the customer's name, by a join; reports per buyer group the orders by the
customer's key first and join the names afterwards (``named``).

Times stay ``timestamp_ntz`` as stored, which keeps date ranges on the bare
column and inside the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.operators.layout import part_of
from tillflow.operators.rows import without


BUYER = "customer_id"
#: The columns by which a feed's tables are dealt into parts.
KEYS = {"customer": "c_custkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}
#: A part's number, and how many there are.
Part = tuple[int, int]
ALL: Part = (0, 1)


def table(spark: SparkSession, folder: str, name: str, part: Part = ALL) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return rows if part == ALL else part_of(rows, KEYS[name], *part)


# --- people, orders and payroll ------------------------------------------------


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_amount"),
    )


def departments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("department_name")
    )


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("emp_id"),
        F.col("s_nationkey").alias("department_id"),
        F.col("s_acctbal").alias("salary"),
    )


def line_sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("return_flag"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
    )


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """A sign-up starts a subscription and an error ends it."""
    status = F.when(F.col("event_type") == "signup", "active").otherwise("cancelled")
    return (
        table(spark, folder, "events")
        .where(F.col("event_type").isin("signup", "error"))
        .select("event_id", "user_id", status.alias("status"), F.col("ts").alias("date"))
    )


def logins(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == "view")
        .select("user_id", F.to_date("ts").alias("login_date"))
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_quantity").alias("amount"),
        F.col("l_shipdate").alias("transaction_date"),
    )


# --- shop ------------------------------------------------------------------------


def _line_items() -> Column:
    percent = F.round(F.col("l_discount") * 100).cast("int")
    price = F.col("l_extendedprice")
    line = F.struct(
        F.when(percent > 0, F.concat(F.lit("D"), percent)).alias("coupon"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.concat(F.lit("item "), F.col("l_partkey")).alias("item_name"),
        (price * (100 - percent) / 100).alias("item_revenue_in_usd"),
        price.alias("price_in_usd"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return F.array(line)


def users(spark: SparkSession, folder: str, part: Part = ALL) -> DataFrame:
    """Customers; the first touch is a made-up offset from a fixed day, by key."""
    touch = F.lit("1994-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.pmod("c_custkey", F.lit(365)).cast("int")
    )
    return table(spark, folder, "customer", part).select(
        F.col("c_name").alias("email"), touch.alias("user_first_touch_timestamp")
    )


def products(spark: SparkSession, folder: str, part: Part = ALL) -> DataFrame:
    return table(spark, folder, "part", part).select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Sales without their buyer: order lines alone, no join."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("l_shipdate").alias("transaction_timestamp"),
        _line_items().alias("items"),
    )


def sales(spark: SparkSession, folder: str, part: Part = ALL) -> DataFrame:
    """Order lines with their buyer; an order without lines has no items, id or revenue.

    Some line ids repeat in the data, so there is something to de-duplicate. Lines
    and empty orders are joined apart: Spark can split a key with many lines in an
    inner join, but not on the optional side of an outer join. A part has whole orders.
    """
    lines = table(spark, folder, "lineitem", part)
    buyers = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("_email"))
    heads = table(spark, folder, "orders", part).join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
    buyer = {"email": F.col("_email"), "transaction_timestamp": F.col("o_orderdate")}
    nothing = {**buyer, "purchase_revenue_in_usd": F.lit(0.0)}
    sold = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("order_id"),
        *[column.alias(name) for name, column in buyer.items()],
        F.col("l_extendedprice").alias("purchase_revenue_in_usd"),
        F.col("l_quantity").cast("bigint").alias("total_item_quantity"),
        _line_items().alias("items"),
    )
    empty = without(heads, lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey").select(
        *[
            nothing.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in sold.schema.fields
        ]
    )
    return sold.unionAll(empty)


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Sales at order grain, without items; the buyer is the customer's key."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias(BUYER),
        F.col("o_orderdate").alias("transaction_timestamp"),
        F.col("o_totalprice").alias("purchase_revenue_in_usd"),
    )


def named(spark: SparkSession, folder: str, report: DataFrame) -> DataFrame:
    """A report per customer key with ``email``, the customer's name, in place of the key."""
    names = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("_key"), F.col("c_name").alias("email")
    )
    joined = report.join(names, F.col(BUYER) == F.col("_key"), "left")
    return joined.select("email", *[c for c in report.columns if c != BUYER])


def counted_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the number of pieces bought; NULL for an order without lines."""
    pieces = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").cast("bigint").alias("total_item_quantity"))
    )
    return (
        table(spark, folder, "orders")
        .join(pieces, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(F.col("o_orderkey").alias("order_id"), "total_item_quantity")
    )


def touches(spark: SparkSession, folder: str) -> DataFrame:
    """Visitors' page views, in the form of the users feed."""
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == "view")
        .select(
            F.col("user_id").cast("string").alias("email"),
            F.col("ts").alias("user_first_touch_timestamp"),
        )
    )


def visitor_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Visitors' purchases, in the form of the sales feed."""
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("user_id").cast("string").alias("email"),
            F.col("ts").alias("transaction_timestamp"),
        )
    )


def _event_items() -> Column:
    kind, value, product = F.col("event_type"), F.col("value"), F.col("_product")

    def item(number: Column, quantity: int) -> Column:
        coupon = F.when(number % 4 == 0, F.concat(F.lit("C"), number))
        return F.struct(
            coupon.alias("coupon"),
            number.cast("string").alias("item_id"),
            F.concat(F.lit("item "), number).alias("item_name"),
            (value * quantity).alias("item_revenue_in_usd"),
            value.alias("price_in_usd"),
            F.lit(quantity).cast("bigint").alias("quantity"),
        )

    companion = (product + 37) % 100
    return (
        F.when(kind == "purchase", F.array(item(product, 1), item(companion, 2)))
        .when(kind == "click", F.array(item(product, 1)))
        .when(kind == "signup", F.array().cast(schemas.ITEMS))
    )


def events(spark: SparkSession, folder: str, part: Part = ALL) -> DataFrame:
    """Clickstream: errors have no user, products from 95 on no traffic source.

    Cities are nations and states their regions. Some users have no known place. The places
    are made distinct by key, which lets Spark drop the join where nobody reads them.
    """
    place = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("n_nationkey")
        .agg(F.min("n_name").alias("_city"), F.min("r_name").alias("_state"))
    )
    product = F.from_json("props", "k int").k
    bought = F.col("event_type") == "purchase"
    log = table(spark, folder, "events", part).withColumns(
        {"_product": product, "_place": F.pmod("user_id", F.lit(28)).cast("int")}
    )
    return log.join(place, F.col("_place") == F.col("n_nationkey"), "left").select(
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("user_id"),
        F.when(bought, schemas.PURCHASE).otherwise(F.col("event_type")).alias("event_name"),
        F.when(F.col("_product") < 95, F.concat(F.lit("src_"), "_product")).alias("traffic_source"),
        F.col("ts").alias("event_timestamp"),
        (F.col("ts") - F.expr("make_dt_interval(0, 0, _product)")).alias("event_previous_timestamp"),
        (F.col("ts") - F.expr("make_dt_interval(_product)")).alias("user_first_touch_timestamp"),
        F.struct(F.col("_city").alias("city"), F.col("_state").alias("state")).alias("geo"),
        F.struct(
            F.when(bought, F.col("value")).alias("purchase_revenue_in_usd"),
            F.when(bought, 3).cast("bigint").alias("total_item_quantity"),
            F.when(bought, 2).cast("bigint").alias("unique_items"),
        ).alias("ecommerce"),
        _event_items().alias("items"),
    )


def replayed_events(spark: SparkSession, folder: str, part: Part = ALL) -> DataFrame:
    """An at-least-once feed: every event arrives twice. To be stored before it is cleaned, since
    Spark would not read a table twice only to drop the repeats."""
    log = events(spark, folder, part)
    return log.unionAll(log)


def text_feed(df: DataFrame, nested: list[str], moments: list[str]) -> DataFrame:
    """The CSV form of a typed table: JSON text and epoch microseconds."""
    micros = {m: F.unix_micros(F.col(m).cast("timestamp")) for m in moments}
    return df.withColumns({**{c: F.to_json(c) for c in nested}, **micros})


def feed(spark: SparkSession, folder: str, name: str, part: Part = ALL) -> DataFrame:
    """One of the four shop tables in its CSV form, or a part of it; the parts make up the whole."""
    if name == "users":
        return text_feed(users(spark, folder, part), [], ["user_first_touch_timestamp"])
    if name == "products":
        return products(spark, folder, part)
    if name == "sales":
        return text_feed(sales(spark, folder, part), ["items"], ["transaction_timestamp"])
    moments = ["event_timestamp", "event_previous_timestamp", "user_first_touch_timestamp"]
    return text_feed(replayed_events(spark, folder, part), ["items", "geo", "ecommerce"], moments)
