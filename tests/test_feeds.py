"""CSV feeds: JSON inside quotes, the text null, and their typed form."""

import datetime

import pytest
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.lakehouse import Lakehouse
from tillflow.plans import build
from tillflow.sources import feeds

ITEM = (
    '[{""coupon"":null,""item_id"":""M1"",""item_name"":""Bed, large"",'
    '""item_revenue_in_usd"":10.5,""price_in_usd"":10.5,""quantity"":1},'
    '{""coupon"":""NEW10"",""item_id"":""M2"",""item_name"":""a """"b"""""",'
    '""item_revenue_in_usd"":1,""price_in_usd"":2,""quantity"":3}]'
).replace('a """"b""""', "a b")
STAMP = "1593878946592107"
MOMENT = datetime.datetime(2020, 7, 4, 16, 9, 6, 592107)

USERS = f"""email,user_first_touch_timestamp
a@x,{STAMP}
a@x,1593878946592000
null,{STAMP}
"",{STAMP}
,null
"""
PRODUCTS = """item_id,name,price
M1,"Bed, large
size",10.5
M3,Pillow,2.25
"""
SALES = f"""order_id,email,transaction_timestamp,purchase_revenue_in_usd,total_item_quantity,items
1,a@x,{STAMP},11.5,4,"{ITEM}"
1,a@x,{STAMP},99.0,1,"[]"
2,b@x,{STAMP},5.0,1,not json
null,c@x,null,1.0,1,"{ITEM}"
4,d@x,{STAMP},-2.0,1,null
"""
EVENT = f'u1,finalize,null,{STAMP},null,{STAMP},"{{""city"":""Rome"",""state"":null}}",' + (
    '"{""purchase_revenue_in_usd"":11.5,""total_item_quantity"":4,""unique_items"":2}"'
)
EVENTS = f"""user_id,event_name,traffic_source,event_timestamp,event_previous_timestamp,user_first_touch_timestamp,geo,ecommerce,items
{EVENT},"{ITEM}"
{EVENT},"{ITEM}"
null,main,google,{STAMP},null,null,{{}},{{}},[]
u2,main,google,soon,null,null,null,null,null
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    for name, text in {"users": USERS, "products": PRODUCTS, "sales": SALES, "events": EVENTS}.items():
        (root / f"{name}.csv").write_text(text)
    return str(root)


def test_users(spark, folder):
    rows = [tuple(r) for r in feeds.bronze(spark, folder, "users").collect()]
    assert rows[0] == ("a@x", MOMENT)
    assert [r[0] for r in rows] == ["a@x", "a@x", None, "", None]
    assert rows[4] == (None, None)


def test_products_with_line_break(spark, folder):
    rows = feeds.bronze(spark, folder, "products").collect()
    assert [tuple(r) for r in rows] == [("M1", "Bed, large\nsize", 10.5), ("M3", "Pillow", 2.25)]


def test_sales_items(spark, folder):
    sales = feeds.bronze(spark, folder, "sales")
    assert sales.schema["items"].dataType.simpleString() == schemas.ITEMS
    rows = sales.collect()
    first, second = rows[0]["items"]
    assert (first.coupon, first.item_id, first.item_name) == (None, "M1", "Bed, large")
    assert (second.coupon, second.item_revenue_in_usd, second.quantity) == ("NEW10", 1.0, 3)
    assert rows[1]["items"] == []
    assert rows[2]["items"] is None
    assert rows[4]["items"] is None
    assert (rows[3].order_id, rows[3].transaction_timestamp) == (None, None)


def test_events(spark, folder):
    rows = feeds.bronze(spark, folder, "events").collect()
    assert (rows[0].geo.city, rows[0].geo.state) == ("Rome", None)
    assert rows[0].ecommerce.total_item_quantity == 4
    assert rows[0].event_timestamp == MOMENT
    assert rows[0].traffic_source is None
    assert rows[3].event_timestamp is None
    assert rows[0] == rows[1]


def test_raw_keeps_null_text(spark, folder):
    raw = feeds.read_raw(spark, folder, "sales")
    assert set(t for _, t in raw.dtypes) == {"string"}
    assert raw.where("order_id = 'null'").count() == 1
    assert feeds.read_raw(spark, folder, "users").where("email = 'null'").count() == 1


def test_inferred_types(spark, folder):
    kept = feeds.read_csv(spark, f"{folder}/products.csv", None)
    assert dict(kept.dtypes)["price"] == "double"


def test_sql_table_over_csv(spark, folder):
    spark.sql("DROP TABLE IF EXISTS product_files")
    table = feeds.csv_table(spark, "product_files", f"{folder}/products.csv", schemas.PRODUCTS_CSV)
    assert table.count() == 2
    spark.sql("DROP TABLE product_files")


def test_round_trip(spark, folder, tmp_path):
    sales = feeds.read_feed(spark, folder, "sales")
    feeds.write_feed(sales, str(tmp_path), "sales")
    again = feeds.read_feed(spark, str(tmp_path), "sales")
    assert sorted(map(str, again.collect())) == sorted(map(str, sales.collect()))


def test_layers_from_csv(spark, folder):
    lake = Lakehouse(spark)
    build.store_bronze(spark, lake, folder)
    build.store_silver(lake)
    events = lake.read("silver.events").collect()
    assert sorted(r.user_id for r in events) == ["u1", "u2"]
    sales = lake.read("silver.sales_enriched").orderBy("item_id").collect()
    assert [(r.order_id, r.item_id, r.product_price) for r in sales] == [
        ("1", "M1", 10.5),
        ("1", "M2", None),
    ]
    log = {r.table: r for r in lake.history().collect()}
    assert log["bronze.sales"].violations == {"has_items": 3, "values_fit": 1}
    assert log["bronze.events"].violations == {"values_fit": 1}
    assert log["bronze.users"].violations == {"values_fit": 0}
    lost = lake.read("quarantine.lost_values").select("source", "column", "raw", "reason").collect()
    assert sorted(map(tuple, lost)) == [
        ("events", "event_timestamp", "soon", "not an epoch time"),
        ("sales", "items", "not json", "malformed JSON"),
    ]
    assert log["silver.events"].violations == {"valid_user": 1, "non_null_ts": 1}
    assert log["silver.sales_enriched"].violations == {"valid_order": 2}
    assert log["silver.events"].rows == 2
    before = spark.createDataFrame([("old", 1.0, 1)], "email string, clv double, orders bigint")
    lake.write(before, "gold.customer_ltv")
    with pytest.raises(Exception, match="positive_clv"):
        build.store_gold(lake)
    assert [tuple(r) for r in lake.read("gold.customer_ltv").collect()] == [("old", 1.0, 1)]
    lake.drop()


def test_columns_by_header_name(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("name,extra,price,item_id\nBed,x,10.5,M1\nSofa,y,much,M2\n")
    typed = feeds.read_feed(spark, str(tmp_path), "products")
    assert typed.columns == ["item_id", "name", "price"]
    assert sorted(map(tuple, typed.collect())) == [("M1", "Bed", 10.5), ("M2", "Sofa", None)]
    raw = feeds.read_raw(spark, str(tmp_path), "products", multi_line=False)
    assert raw.orderBy("item_id").first() == ("M1", "Bed", "10.5")
    assert dict(feeds.read_raw(spark, str(tmp_path), "products", infer=True).dtypes)["name"] == "string"
    spark.sql("DROP TABLE IF EXISTS swapped_files")
    table = feeds.csv_table(spark, "swapped_files", str(path), schemas.PRODUCTS_CSV)
    assert table.orderBy("item_id").select("item_id", "name", "price").first() == ("M1", "Bed", 10.5)
    spark.sql("DROP TABLE swapped_files")


def test_missing_columns_are_an_error(spark, tmp_path):
    (tmp_path / "products.csv").write_text("name,price\nBed,10.5\n")
    with pytest.raises(ValueError, match="item_id"):
        feeds.read_feed(spark, str(tmp_path), "products")


def test_epochs_as_numbers_of_any_form(spark):
    from tillflow.functions import from_micros

    texts = ["1593878946592107", "1593878946592107.0", "1.593878946592107E15", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "m string").select(from_micros("m").alias("t"))
    found = [r.t.isoformat() if r.t else None for r in df.collect()]
    assert found[0] is not None and found[:3] == [found[0]] * 3 and found[3:] == [None] * 3


def test_month_partitions(spark, folder):
    lake = Lakehouse(spark)
    build.store_bronze(spark, lake, folder)
    build.store_silver(lake)
    gold = build.store_monthly_revenue(lake).read("gold.monthly_revenue_by_product_city")
    rows = [tuple(r) for r in gold.select("month", "item_id", "city", "revenue").orderBy("item_id").collect()]
    assert rows == [("2020-07", "M1", "Rome", 10.5), ("2020-07", "M2", "Rome", 1.0)]
    plan = gold.where(F.col("month") == "2020-07")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    lake.drop()
