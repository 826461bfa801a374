"""Every query over the supplied tables: name -> function of session and folder.

Results hold plain columns only: exact decimals become doubles and times become
``timestamp_ntz``, as in the supplied tables.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import partial, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions import in_year
from tillflow.lakehouse import AUDIT, Lakehouse
from tillflow.lakehouse import HISTORY as TABLE_HISTORY
from tillflow.operators import layout
from tillflow.plans import arrivals, build, company, layers, overview, shop, traffic
from tillflow.schemas import FEEDS
from tillflow.session import drop_folder, new_folder, shared_dir, stored
from tillflow.sources import feeds, records, retail

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({m: F.col(m).cast("timestamp_ntz") for m in moments}) if moments else df


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(function(spark, folder))

    QUERIES[function.__name__] = run
    return run


# --- SQL set ---------------------------------------------------------------------


@query
def sql01_customer_revenue(spark, folder):
    spent = company.customer_revenue(
        retail.customers(spark, folder), retail.orders(spark, folder), 1997, 1_000_000
    )
    return spent.withColumn("total_order_amount", F.round("total_order_amount", 2))


@query
def sql02_avg_salary_by_dept(spark, folder):
    averages = company.average_salary(
        retail.departments(spark, folder), retail.employees(spark, folder)
    )
    return averages.withColumn("avg_salary", F.round("avg_salary", 4))


@query
def sql03_recent_orders(spark, folder):
    return company.recent_orders(retail.orders(spark, folder))


@query
def sql04_first_purchase(spark, folder):
    return company.first_purchase(retail.orders(spark, folder))


@query
def sql05_customers_no_orders(spark, folder):
    return company.customers_without_orders(
        retail.customers(spark, folder), retail.orders(spark, folder), 1997
    )


@query
def sql06_category_growth(spark, folder):
    return company.category_growth(
        retail.line_sales(spark, folder), retail.catalog(spark, folder), 1997
    )


@query
def sql07_monthly_churn(spark, folder):
    return company.monthly_churn(retail.subscriptions(spark, folder), tie_break="event_id")


@query
def sql08_duplicate_transactions(spark, folder):
    return company.duplicate_transactions(retail.transactions(spark, folder))


@query
def sql09_login_streaks(spark, folder):
    return company.login_streaks(retail.logins(spark, folder))


@query
def sql10_salary_p90(spark, folder):
    staff = retail.employees(spark, folder).withColumnRenamed("department_id", "department")
    marks = company.salary_percentile(staff)
    return marks.withColumn("percentile_salary", F.round("percentile_salary", 4))


@query
def sql11_products_never_sold(spark, folder):
    """Parts without any sale; in the supplied tables every part has one."""
    return company.products_never_sold(
        retail.catalog(spark, folder), retail.line_sales(spark, folder)
    )


@query
def sql11_products_not_returned_1997(spark, folder):
    """Parts without a returned sale in 1997."""
    returned = retail.line_sales(spark, folder).where(
        (F.col("return_flag") == "R") & in_year("sale_date", 1997)
    )
    return company.products_never_sold(retail.catalog(spark, folder), returned)


@query
def sql12_running_total(spark, folder):
    totals = company.running_total(
        retail.orders(spark, folder).withColumnRenamed("order_amount", "amount")
    )
    return totals.withColumn("running_total", F.round("running_total", 2))


# --- notebook set ------------------------------------------------------------------


def _shop_tables(spark, folder):
    return {
        "users": retail.users(spark, folder),
        "sales": retail.sales(spark, folder),
        "products": retail.products(spark, folder),
        "events": retail.events(spark, folder),
    }


@query
def nb_table_counts(spark, folder):
    stored = {"users": "customer", "sales": "orders", "products": "part", "events": "events"}
    return overview.table_counts(
        {name: retail.table(spark, folder, source) for name, source in stored.items()}
    )


@query
def nb_table_schemas(spark, folder):
    return overview.table_schemas(_shop_tables(spark, folder))


@query
def nb_sales_items(spark, folder):
    return shop.sales_items(retail.sales(spark, folder))


@query
def nb_event_items(spark, folder):
    return traffic.event_items(retail.events(spark, folder))


@query
def nb_revenue_per_item(spark, folder):
    return shop.revenue_per_item(retail.baskets(spark, folder))


@query
def nb_sales_priced(spark, folder):
    return shop.sales_priced(retail.baskets(spark, folder), retail.products(spark, folder))


@query
def nb_purchases_per_user(spark, folder):
    report = shop.purchases_per_user(retail.purchases(spark, folder), buyer=retail.BUYER)
    return retail.named(spark, folder, report)


@query
def nb_revenue_per_user(spark, folder):
    report = shop.revenue_per_user(retail.purchases(spark, folder), buyer=retail.BUYER)
    return retail.named(spark, folder, report)


@query
def nb_top10_products(spark, folder):
    return shop.top_products(retail.baskets(spark, folder))


@query
def nb_touch_to_purchase(spark, folder):
    return shop.touch_to_purchase(
        retail.visitor_purchases(spark, folder), retail.touches(spark, folder)
    )


@query
def nb_touch_to_purchase_avg(spark, folder):
    return shop.touch_to_purchase_average(
        retail.visitor_purchases(spark, folder), retail.touches(spark, folder)
    )


@query
def nb_monthly_revenue(spark, folder):
    return shop.monthly_revenue(retail.purchases(spark, folder))


@query
def nb_monthly_events(spark, folder):
    return traffic.monthly_events(retail.events(spark, folder))


@query
def nb_active_users_per_city(spark, folder):
    return traffic.active_users_per_city(retail.events(spark, folder))


@query
def nb_revenue_per_source(spark, folder):
    return traffic.revenue_per_source(retail.events(spark, folder))


@query
def nb_avg_items_per_txn(spark, folder):
    return shop.average_items(retail.counted_purchases(spark, folder))


@query
def nb_top5_products_detail(spark, folder):
    return shop.top_products_detail(
        retail.baskets(spark, folder), retail.products(spark, folder)
    )


@query
def nb_revenue_by_state(spark, folder):
    return traffic.revenue_by_state(retail.events(spark, folder))


@query
def nb_revenue_by_state_top15(spark, folder):
    return traffic.revenue_by_state(retail.events(spark, folder), count=15)


@query
def nb_event_impact(spark, folder):
    return traffic.event_impact(retail.events(spark, folder))


@query
def nb_event_significance(spark, folder):
    """Analysis of variance of revenue by source; only one kind of event has revenue in these tables."""
    tested = traffic.event_significance(retail.events(spark, folder), by="traffic_source")
    return tested.withColumns({c: F.round(c, 6) for c in ("f", "p", "explained")})


@query
def nb_purchase_frequency(spark, folder):
    report = shop.purchase_frequency(retail.purchases(spark, folder), buyer=retail.BUYER)
    return retail.named(spark, folder, report)


@query
def nb_coupon_split(spark, folder):
    return shop.coupon_split(retail.baskets(spark, folder))


@query
def nb_product_stats(spark, folder):
    return shop.product_stats(retail.baskets(spark, folder))


@query
def nb_product_corr(spark, folder):
    grains = shop.product_correlation(retail.baskets(spark, folder))
    return grains.withColumn("corr", F.round("corr", 6))


@query
def nb_clv(spark, folder):
    report = shop.lifetime_value(retail.purchases(spark, folder), buyer=retail.BUYER)
    return retail.named(spark, folder, report)


@query
def nb_conversion_by_source(spark, folder):
    return traffic.conversion_by_source(retail.events(spark, folder))


@query
def nb_recency(spark, folder):
    report = shop.recency(retail.purchases(spark, folder), buyer=retail.BUYER)
    return retail.named(spark, folder, report)


@query
def nb_churned(spark, folder):
    report = shop.churned(retail.purchases(spark, folder), buyer=retail.BUYER)
    return retail.named(spark, folder, report)


@query
def nb_recency_buckets(spark, folder):
    return shop.recency_buckets(retail.purchases(spark, folder), buyer=retail.BUYER)


# --- layered tables ------------------------------------------------------------------


def contents(spark: SparkSession, folder: str, *tables: str) -> str:
    """A text that changes with the folder, or with any file of the supplied tables."""
    marks = [folder]
    for name in tables:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        listed = files.load(f"{folder}/{name}.parquet").select("path", "modificationTime", "length")
        # A sum of hashes does not depend on the order, and one row comes back whatever the files' number.
        both = [F.sum(F.xxhash64(*listed.columns, F.lit(seed)).cast("decimal(20,0)")) for seed in (1, 2)]
        marks.append(str(tuple(listed.agg(F.count("*"), *both).first())))
    return hashlib.sha1("\n".join(marks).encode()).hexdigest()[:16]


SUPPLIED = {
    "users": ["customer"],
    "products": ["part"],
    "sales": ["customer", "lineitem", "orders"],
    "events": ["events", "nation", "region"],
}
#: Codecs of the feeds' files; the products stay plain, since they are also cut into records in parallel.
PACKED = {"users": "gzip", "sales": "gzip", "events": "gzip"}


def delivered(spark: SparkSession, folder: str, *names: str) -> str:
    """A folder of CSV feeds made from the supplied tables, written once per session and content."""
    session = spark.sparkContext.applicationId
    key = contents(spark, folder, *sorted({t for tables in SUPPLIED.values() for t in tables}))
    target = f"{shared_dir(spark)}/tillflow-{session}/feeds-{key}"
    done = _delivered.setdefault(target, set())
    for name in names:
        if name not in done:
            feeds.write_feed(retail.feed(spark, folder, name), target, name, compression=PACKED.get(name))
            done.add(name)
    return target


def arriving(spark: SparkSession, folder: str, name: str) -> Iterator[str]:
    """Folders of a feed's parts, one after the other; a part is removed when the next one is asked for.

    A small feed is one part, and stays for the session (``delivered``).
    """
    count = layout.part_count(layout.file_bytes(spark, *[f"{folder}/{t}.parquet" for t in SUPPLIED[name]]))
    if count == 1:
        yield delivered(spark, folder, name)
        return
    for number in range(count):
        target = new_folder(spark, f"part-of-{name}")
        try:
            rows = retail.feed(spark, folder, name, (number, count))
            feeds.write_feed(rows, target, name, compression=PACKED.get(name))
            yield target
        finally:
            drop_folder(spark, target)


_delivered: dict[str, set[str]] = {}
_built: dict[str, dict[str, DataFrame]] = {}
HISTORY = f"{AUDIT}.{TABLE_HISTORY}"


def layered(spark: SparkSession, folder: str, raw: bool = False) -> dict[str, DataFrame]:
    """All layers built from the CSV feeds, once per session and content: table name -> rows.

    The tables are read from their files, so that the schemas can be dropped again: nothing of the
    build stays in the catalog. Large feeds come in parts, so that they never lie on disk as a whole.
    """
    marks = contents(spark, folder, *sorted({t for tables in SUPPLIED.values() for t in tables}))
    key = f"{spark.sparkContext.applicationId}/{marks}#{raw}"
    if key not in _built:
        lake, source = Lakehouse(spark), partial(arriving, spark, folder)
        try:
            if raw:
                build.store_raw(spark, lake, source)
            else:
                build.build(spark, source, lake)
            listed = lake.tables().collect()
            found = {f"{r.layer}.{r.table}": lake.files(f"{r.layer}.{r.table}") for r in listed}
            found[HISTORY] = stored(lake.history(), "history")
            _built[key] = found
        finally:
            lake.drop()
    return _built[key]


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as plain ones; items read ``coupon|id|name|revenue|price|quantity`` each, with
    money in units of 1/10,000."""

    def money(amount):
        return F.round(amount * 10_000).cast("bigint").cast("string")

    def line(i):
        fields = [i.coupon, i.item_id, i.item_name, money(i.item_revenue_in_usd), money(i.price_in_usd)]
        fields.append(i.quantity.cast("string"))
        return F.concat_ws("|", *[F.coalesce(f, F.lit("")) for f in fields])

    content = F.array_join(F.transform("items", line), ",")
    df = df.withColumns({"basket": content, "basket_size": F.size("items")}).drop("items")
    return df.select(*[f"{c}.*" if c in ("geo", "ecommerce") else c for c in df.columns])


@query
def bronze_products_in_parallel(spark, folder):
    """The products feed cut into records by the way for files of many splits."""
    source = f"{delivered(spark, folder, 'products')}/products.csv"
    text = records.parsed(spark, source, ["item_id", "name", "price"], nullValue=feeds.NULL_TEXT)
    return text.withColumn("price", F.col("price").try_cast("double"))


@query
def quarantined_values(spark, folder):
    """What typing loses of a delivery in which some prices and times are words and some JSON is cut."""
    key = contents(spark, folder, "part", "customer", "lineitem", "orders")
    target = f"{shared_dir(spark)}/tillflow-{spark.sparkContext.applicationId}/faulty-{key}"
    if target not in _delivered:
        item = F.col("item_id").cast("bigint")
        priced = F.when(item % 10 == 3, F.lit("n/a")).otherwise(F.col("price").cast("string"))
        products = retail.feed(spark, folder, "products").withColumn("price", priced)
        feeds.write_feed(products, target, "products")
        line = F.substring_index("order_id", "-", -1).cast("int")
        cut = F.when(line == 6, F.lit('[{"item_id"')).when(line == 7, F.lit('[{"quantity": "many"}]'))
        sales = retail.feed(spark, folder, "sales")
        sales = sales.withColumn("items", F.when(cut.isNotNull(), cut).otherwise(F.col("items")))
        when = F.when(line == 5, F.lit("yesterday")).otherwise(F.col("transaction_timestamp").cast("string"))
        feeds.write_feed(sales.withColumn("transaction_timestamp", when), target, "sales")
        _delivered[target] = {"products", "sales"}
    lost = [feeds.quarantined(spark, target, feed) for feed in ("products", "sales")]
    rows = reduce(DataFrame.unionAll, lost)
    key = F.coalesce(F.get_json_object("record", "$.item_id"), F.get_json_object("record", "$.order_id"))
    return rows.select("source", "column", "raw", "reason", key.alias("key"))


@query
def incremental_users(spark, folder):
    """A feed delivered in two parts: what each of three runs takes in, and the rows then stored."""
    key = contents(spark, folder, "customer")
    target = f"{shared_dir(spark)}/tillflow-{spark.sparkContext.applicationId}/parts-{key}-{uuid.uuid4().hex[:8]}"
    users = retail.feed(spark, folder, "users")
    odd = F.regexp_extract("email", r"(\d+)$", 1).cast("bigint") % 2 == 1
    lake, lines = Lakehouse(spark), []
    try:
        for run, part in enumerate([users.where(odd), users.where(~odd), None], 1):
            if part is not None:
                part.write.options(header=True, escape='"', nullValue=feeds.NULL_TEXT).mode("append").csv(
                    f"{target}/users.csv"
                )
            taken = arrivals.take_in(spark, lake, target, "users")
            lines.append((run, taken, lake.read("bronze.users").count()))
    finally:
        lake.drop()
    cells = [F.struct(*[F.lit(v).cast("bigint").alias(n) for v, n in zip(x, ("run", "taken", "stored"))]) for x in lines]
    return spark.range(1).select(F.inline(F.array(*cells)))


@query
def raw_tables(spark, folder):
    """The stored raw tables: rows, and cells that hold the text ``null``."""
    tables = layered(spark, folder, raw=True)

    def line(name):
        df = tables[f"raw.{name}"]
        cells = reduce(lambda a, b: a + b, [F.count_if(F.col(c) == "null") for c in df.columns])
        return df.agg(F.lit(name).alias("table"), F.count("*").alias("rows"), cells.alias("null_texts"))

    return reduce(DataFrame.unionAll, [line(name) for name in FEEDS])


@query
def bronze_events(spark, folder):
    return flat(feeds.bronze(spark, delivered(spark, folder, "events"), "events"))


@query
def bronze_sales(spark, folder):
    return flat(feeds.bronze(spark, delivered(spark, folder, "sales"), "sales"))


@query
def bronze_users(spark, folder):
    return feeds.bronze(spark, delivered(spark, folder, "users"), "users")


@query
def bronze_products(spark, folder):
    return feeds.bronze(spark, delivered(spark, folder, "products"), "products")


@query
def silver_events(spark, folder):
    return flat(layered(spark, folder)["silver.events"])


@query
def silver_sales_enriched(spark, folder):
    return layered(spark, folder)["silver.sales_enriched"]


@query
def silver_event_items(spark, folder):
    return layered(spark, folder)["silver.event_items"]


@query
def gold_monthly_revenue_by_product_city(spark, folder):
    """Stored by month and clustered by item and city."""
    return layered(spark, folder)["gold.monthly_revenue_by_product_city"]


@query
def gold_top10_customers_by_ltv(spark, folder):
    return layered(spark, folder)["gold.top10_customers_by_ltv"]


@query
def gold_conversion_by_traffic_source(spark, folder):
    return layered(spark, folder)["gold.conversion_by_traffic_source"]


@query
def gold_customer_ltv(spark, folder):
    return layered(spark, folder)["gold.customer_ltv"].withColumn("clv", F.round("clv", 2))


@query
def dq_report(spark, folder):
    """What the writes of the build counted: rows checked and violations per expectation."""
    log = layered(spark, folder)[HISTORY].select(
        F.translate("table", ".", "_").alias("dataset"), "rows_checked", F.explode("violations")
    )
    actions = [
        F.struct(F.lit(d).alias("of"), F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"))
        for d, rules in layers.RULES.items()
        for r in rules
    ]
    known = spark.range(1).select(F.inline(F.array(*actions)))
    same = (F.col("dataset") == F.col("of")) & (F.col("key") == F.col("rule"))
    return log.join(known, same).select(
        "dataset",
        F.col("key").alias("expectation"),
        "action",
        F.col("rows_checked").alias("rows"),
        F.col("value").alias("violations"),
    )


@query
def audit_table_history(spark, folder):
    """All layers built from CSV; one line per write."""
    return layered(spark, folder)[HISTORY].select("table", "version", "operation", "mode", "rows")


@query
def catalog_tables(spark, folder):
    """The stored raw tables and how many rows each holds."""
    tables = {name: df for name, df in layered(spark, folder, raw=True).items() if name.startswith("raw.")}
    lines = [
        df.agg(F.lit("raw").alias("layer"), F.lit(name[4:]).alias("table"), F.count("*").alias("rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, lines)
