"""Sales, items and buyers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions import (
    each_item,
    exact_sum,
    item_rows,
    mean_of,
    moments,
    month_of,
    quotient,
    ratio,
    seconds_between,
    sum_of,
    total_of,
)
from tillflow.session import shuffles_dropped, stored

SALE = ["order_id", "email", "transaction_timestamp"]
HALF_YEAR_DAYS = 180
RECENCY_DAYS = (7, 14)


def sales_items(sales: DataFrame) -> DataFrame:
    """One row per item sold."""
    return item_rows(sales, *SALE)


def revenue_per_item(sales: DataFrame) -> DataFrame:
    return (
        each_item(sales, ["item_id", "item_revenue_in_usd"])
        .groupBy("item_id")
        .agg(sum_of("item_revenue_in_usd").alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), "item_id")
    )


def sales_priced(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sold items beside the catalog price; no hint, the size of the catalog decides the join."""
    sold = each_item(sales, ["item_id", "quantity", "price_in_usd"], "order_id")
    price = products.select("item_id", F.col("price").alias("product_price"))
    return sold.join(price, "item_id", "left").select(
        "order_id", "item_id", "quantity", "price_in_usd", "product_price"
    )


def purchases_per_user(sales: DataFrame, buyer: str = "email") -> DataFrame:
    """Distinct orders per buyer. Joining the users would add neither columns nor rows."""
    return (
        sales.groupBy(buyer)
        .agg(F.count_distinct("order_id").alias("num_purchases"))
        .orderBy(F.desc("num_purchases"), buyer)
    )


def revenue_per_user(sales: DataFrame, buyer: str = "email") -> DataFrame:
    return (
        sales.groupBy(buyer)
        .agg(sum_of("purchase_revenue_in_usd").alias("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), buyer)
    )


def top_products(sales: DataFrame, count: int = 10) -> DataFrame:
    return (
        each_item(sales, ["item_id", "quantity"])
        .groupBy("item_id")
        .agg(F.sum("quantity").alias("total_quantity"))
        .orderBy(F.desc_nulls_last("total_quantity"), "item_id")
        .limit(count)
    )


def touch_to_purchase(sales: DataFrame, users: DataFrame) -> DataFrame:
    """Time from first touch to first purchase, for buyers with a known touch."""
    touched = (
        users.where(F.col("email").isNotNull())
        .groupBy("email")
        .agg(F.min("user_first_touch_timestamp").alias("first_touch"))
    )
    bought = (
        sales.where(F.col("email").isNotNull())
        .groupBy("email")
        .agg(F.min("transaction_timestamp").alias("first_purchase"))
    )
    seconds = seconds_between("first_touch", "first_purchase")
    return (
        bought.join(touched, "email")
        .select(
            F.col("email").alias("user"),
            "first_purchase",
            "first_touch",
            (seconds / 3600).alias("hours"),
            ratio(seconds, F.lit(86400), 2).alias("days"),
        )
        .orderBy(F.desc_nulls_last("hours"), "user")
    )


def touch_to_purchase_average(sales: DataFrame, users: DataFrame) -> DataFrame:
    seconds = F.col("_seconds")
    measured = touch_to_purchase(sales, users).withColumn(
        "_seconds", seconds_between("first_touch", "first_purchase")
    )
    return measured.agg(
        ratio(F.sum(seconds), F.count(seconds) * 3600, 2).alias("avg_hours_touch_to_purchase"),
        ratio(F.sum(seconds), F.count(seconds) * 86400, 2).alias("avg_days_touch_to_purchase"),
        F.count("*").alias("users_measured"),
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_of("transaction_timestamp").alias("month"))
        .agg(sum_of("purchase_revenue_in_usd").alias("revenue"))
        .orderBy("month")
    )


def average_items(sales: DataFrame) -> DataFrame:
    """Transactions, pieces sold, and pieces per transaction with a known quantity."""
    pieces = F.col("total_item_quantity")
    return sales.agg(
        F.count("order_id").alias("total_transactions"),
        F.sum(pieces).alias("total_items_sold"),
        ratio(F.sum(pieces), F.count(pieces), 4).alias("avg_items_per_transaction"),
    )


def top_products_detail(sales: DataFrame, products: DataFrame, count: int = 5) -> DataFrame:
    """Best items by revenue beside their catalog entry; the limit keeps the join small."""
    best = (
        each_item(sales, ["item_id", "item_revenue_in_usd"])
        .groupBy("item_id")
        .agg(sum_of("item_revenue_in_usd").alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "item_id")
        .limit(count)
    )
    details = products.select("item_id", "name", "price")
    return (
        best.join(details, "item_id", "left")
        .select("item_id", "name", "price", "revenue")
        .orderBy(F.desc_nulls_last("revenue"), "item_id")
    )


def purchase_frequency(sales: DataFrame, buyer: str = "email") -> DataFrame:
    """Distinct orders per day with an order, and the span from first to last.

    Rows are first grouped by buyer, order and day, which spreads a frequent buyer; the two distinct
    counts then see one row per order and day.
    """
    moment = F.col("transaction_timestamp")
    daily = sales.groupBy(buyer, "order_id", F.to_date(moment).alias("_day")).agg(
        F.min(moment).alias("_first"), F.max(moment).alias("_last")
    )
    by_order = daily.groupBy(buyer, "order_id").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )
    days = daily.where("_day IS NOT NULL").groupBy(buyer, "_day").agg(F.lit(1).alias("_one"))
    counted = (
        by_order.groupBy(buyer)
        .agg(
            F.count("order_id").alias("purchases"),
            F.min("_first").alias("first_purchase"),
            F.max("_last").alias("last_purchase"),
        )
    )
    active = days.groupBy(F.col(buyer).alias("_who")).agg(F.count("*").alias("active_days"))
    return (
        counted.join(active, F.col(buyer).eqNullSafe(F.col("_who")), "left")
        .withColumns(
            {
                "active_days": F.coalesce("active_days", F.lit(0).cast("bigint")),
                "tenure_days": F.datediff("last_purchase", "first_purchase"),
            }
        )
        .withColumn(
            "purchase_frequency", ratio(F.col("purchases"), F.greatest("active_days", F.lit(1)), 4)
        )
        .select(
            buyer,
            "purchases",
            "active_days",
            "first_purchase",
            "last_purchase",
            "tenure_days",
            "purchase_frequency",
        )
        .orderBy(F.desc("purchases"), F.desc("purchase_frequency"), buyer)
    )


def coupon_split(sales: DataFrame) -> DataFrame:
    """Revenue and quantity with and without coupon. Shares refer to the rounded revenue.

    The window without partition sees the two aggregated rows only.
    """
    both = Window.partitionBy()
    sold = each_item(sales, ["coupon", "item_revenue_in_usd", "quantity"])

    def percent(part: Column) -> Column:
        return F.round(F.try_divide(part * 100, F.sum(part).over(both)), 2).cast("double")

    return (
        sold.groupBy(F.when(F.col("coupon").isNull(), "no_coupon").otherwise("coupon").alias("segment"))
        .agg(
            sum_of("item_revenue_in_usd").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.count("*").alias("line_items"),
        )
        .withColumns(
            {
                "pct_revenue": percent(F.col("revenue").cast("decimal(20,2)")),
                "pct_quantity": percent(F.col("quantity").cast("decimal(20,0)")),
            }
        )
        .orderBy(F.desc("revenue"), "segment")
    )


def _per_product(sales: DataFrame) -> DataFrame:
    """One row per item. Names are grouped first: a minimum of text next to the sums
    would sort all lines instead of hashing them."""
    fields = ["item_id", "item_name", "quantity", "item_revenue_in_usd", "price_in_usd"]
    named = (
        each_item(sales, fields)
        .groupBy("item_id", "item_name")
        .agg(
            F.sum("quantity").alias("_qty"),
            exact_sum("item_revenue_in_usd").alias("_rev"),
            exact_sum("price_in_usd").alias("_paid"),
            F.count("price_in_usd").alias("_prices"),
        )
    )
    price = quotient(F.sum("_paid"), F.sum("_prices"))
    return named.groupBy("item_id").agg(
        F.min("item_name").alias("item_name"),
        F.sum("_qty").alias("qty"),
        F.round(F.sum("_rev"), 2).cast("double").alias("rev"),
        F.round(price, 2).cast("double").alias("avg_price"),
    )


def product_stats(sales: DataFrame) -> DataFrame:
    return _per_product(sales).orderBy(F.desc_nulls_last("rev"), "item_id")


def product_correlation(sales: DataFrame) -> DataFrame:
    """Correlation of quantity and revenue over products and over single lines.

    A pair with a NULL is left out. One scan gives the sums per product and, from centred moments that
    Spark merges task by task, the figures over all lines.
    """
    x, y = F.col("quantity"), F.col("item_revenue_in_usd")
    lines = each_item(sales, ["item_id", "quantity", "item_revenue_in_usd"])
    grains = lines.groupingSets([["item_id"], []], "item_id").agg(
        F.grouping_id().alias("_grain"),
        F.sum("quantity").alias("qty"),
        sum_of("item_revenue_in_usd").alias("rev"),
        F.count("*").alias("_lines"),
        *[value.alias(name) for name, value in moments.moments(x, y).items()],
    )
    product, line = F.col("_grain") == 0, F.col("_grain") == 1
    over_lines = moments.correlation(*[F.col(k) for k in (moments.XX, moments.YY, moments.XY)])
    over_products = moments.moments(F.when(product, F.col("qty")), F.when(product, F.col("rev")))
    both_grains = grains.agg(
        F.count_if(product).alias("products"),
        moments.correlation(*[over_products[k] for k in (moments.XX, moments.YY, moments.XY)]).alias("product_corr"),
        F.coalesce(F.max(F.when(line, F.col("_lines"))), F.lit(0)).alias("lines"),
        F.max(F.when(line, over_lines)).alias("line_corr"),
    )
    rows = [
        F.struct(F.lit(g).alias("grain"), F.col(c).cast("bigint").alias("n"), F.col(r).alias("corr"))
        for g, c, r in (("product", "products", "product_corr"), ("line", "lines", "line_corr"))
    ]
    return both_grains.select(F.inline(F.array(*rows)))


def lifetime_value(sales: DataFrame, buyer: str = "email") -> DataFrame:
    """Revenue, orders, average order and active span per buyer."""
    moment = "transaction_timestamp"
    return (
        sales.groupBy(buyer)
        .agg(
            sum_of("purchase_revenue_in_usd").alias("clv"),
            F.count_distinct("order_id").alias("orders"),
            mean_of("purchase_revenue_in_usd").alias("avg_order_value"),
            F.datediff(F.max(moment), F.min(moment)).alias("active_days"),
        )
        .orderBy(F.desc_nulls_last("clv"), buyer)
    )


def recency(sales: DataFrame, buyer: str = "email") -> DataFrame:
    """Days between a buyer's last purchase and the newest one of all."""
    moment = "transaction_timestamp"
    newest = sales.agg(F.max(moment)).scalar()
    return (
        sales.groupBy(buyer)
        .agg(
            F.max(moment).alias("last_purchase"),
            sum_of("purchase_revenue_in_usd").alias("revenue"),
        )
        .withColumn("days_since_last", F.datediff(newest, "last_purchase"))
    )


def churned(
    sales: DataFrame, idle_days: int = HALF_YEAR_DAYS, buyer: str = "email"
) -> DataFrame:
    return recency(sales, buyer).where(F.col("days_since_last") >= idle_days)


def recency_buckets(
    sales: DataFrame, limits: tuple[int, int] = RECENCY_DAYS, buyer: str = "email"
) -> DataFrame:
    """Buyers and average revenue by idle days."""
    short, middle = limits
    idle = F.col("days_since_last")
    bucket = (
        F.when(idle <= short, f"0-{short}d")
        .when(idle <= middle, f"{short + 1}-{middle}d")
        .otherwise(f"{middle + 1}d+")
    )
    return (
        recency(sales, buyer)
        .groupBy(bucket.alias("recency_bucket"))
        .agg(F.count("*").alias("users"), mean_of("revenue").alias("avg_revenue"))
        .orderBy("recency_bucket")
    )


def customer_value(sales: DataFrame) -> DataFrame:
    """Unrounded revenue and orders per buyer.

    The users are not joined: that would only multiply the revenue of an email
    that is listed twice.
    """
    return sales.groupBy("email").agg(
        total_of("purchase_revenue_in_usd").alias("clv"),
        F.count_distinct("order_id").alias("orders"),
    )


def best_customers(sales: DataFrame, count: int = 10) -> DataFrame:
    return (
        sales.groupBy("email")
        .agg(
            sum_of("purchase_revenue_in_usd").alias("clv"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy(F.desc_nulls_last("clv"), "email")
        .limit(count)
    )


def best_of_parts(parts: list[DataFrame], count: int = 10) -> DataFrame:
    """``best_customers`` of sales in parts that share no buyer: the best among the best of each part.

    The parts are worked off one after the other, each with a shuffle of its own.
    """
    if len(parts) == 1:
        return best_customers(parts[0], count)
    with shuffles_dropped(parts[0].sparkSession):
        best = reduce(DataFrame.unionAll, [stored(best_customers(part, count), "best") for part in parts])
    return best.orderBy(F.desc_nulls_last("clv"), "email").limit(count)
