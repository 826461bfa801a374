"""Small hand-made inputs for the cases where a query could plausibly go wrong."""

import datetime

import pytest
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import mean_of, ratio, sum_of
from tillflow.plans import company, layers, overview, shop, traffic

D = datetime.date


def ts(text):
    return datetime.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        (1, 1, ts("2023-01-01 00:00:00"), 6000.0),
        (2, 1, ts("2023-12-31 23:59:59"), 4000.5),
        (3, 1, ts("2024-01-01 00:00:00"), 900.0),
        (4, 2, ts("2023-05-05 00:00:00"), 10000.0),
        (5, 2, ts("2022-05-05 00:00:00"), 1.0),
        (7, 1, ts("2024-01-01 00:00:00"), None),
        (6, 1, ts("2024-01-01 00:00:00"), 0.1),
    ]
    return spark.createDataFrame(
        rows, "order_id int, customer_id int, order_date timestamp, order_amount double"
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "customer_id int, customer_name string")


def test_year_is_half_open_and_threshold_strict(customers, orders):
    assert company.customer_revenue(customers, orders, 2023, 10000).collect() == [("A", 10000.5)]
    assert company.customers_without_orders(customers, orders, 2024).collect() == [(2, "B"), (3, "C")]


def test_recent_orders_break_ties_by_id(orders):
    newest = company.recent_orders(orders)
    assert [(r.customer_id, r.order_id) for r in newest.collect()] == [(1, 3), (1, 6), (2, 4), (2, 5)]


def test_running_total_is_exact_and_ignores_null(orders):
    result = company.running_total(orders, "order_amount").where("customer_id = 1")
    totals = [r.running_total for r in result.orderBy("order_date", "order_id").collect()]
    assert totals == [6000.0, 10000.5, 10900.5, 10900.6, 10900.6]


def test_departments_without_salaries(spark):
    departments = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "department_id int, department_name string")
    staff = spark.createDataFrame(
        [(1, 1, 10.0), (2, 1, 20.0), (3, 2, None)], "emp_id int, department_id int, salary double"
    )
    found = company.average_salary(departments, staff).collect()
    assert found == [("x", 15.0), ("y", None), ("z", None)]
    marks = company.salary_percentile(staff, 0.5, "department_id")
    assert {(r.emp_id, r.percentile_salary) for r in marks.collect()} == {(1, 15.0), (2, 15.0), (3, None)}


def test_percentile_of_unknown_department(spark):
    staff = spark.createDataFrame([(1, None, 5.0), (2, None, 7.0)], "emp_id int, department string, salary double")
    assert {tuple(r) for r in company.salary_percentile(staff, 1.0).collect()} == {
        (1, None, 5.0, 7.0),
        (2, None, 7.0, 7.0),
    }


def test_growth_needs_both_years(spark):
    products = spark.createDataFrame(
        [(1, "p", "up"), (2, "q", "down"), (3, "r", "new"), (4, "s", None)],
        "product_id int, name string, category string",
    )
    sales = spark.createDataFrame(
        [(1, D(2022, 1, 1), 1.0), (1, D(2023, 12, 31), 1.5), (2, D(2022, 6, 1), 2.0), (2, D(2023, 6, 1), 2.0)]
        + [(3, D(2023, 6, 1), 9.0), (4, D(2022, 6, 1), 1.0), (4, D(2023, 6, 1), 2.0), (1, D(2024, 1, 1), 99.0)]
        + [(1, D(2021, 12, 31), 99.0)],
        "product_id int, sale_date date, amount double",
    )
    assert company.category_growth(sales, products, 2023).collect() == [("up", 1.5, 1.0, 0.5)]


def test_churn_counts_changes(spark):
    steps = [
        (1, "u", "active", "2024-01-01 00:00:00"),
        (2, "u", "cancelled", "2024-01-31 23:00:00"),
        (3, "u", "active", "2024-02-01 00:00:00"),
        (4, "u", "cancelled", "2024-02-02 00:00:00"),
        (5, "v", "cancelled", "2024-02-02 00:00:00"),
        (6, "v", "cancelled", "2024-02-03 00:00:00"),
        (7, "w", "active", "2024-01-01 00:00:00"),
        (8, "w", "cancelled", "2024-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(
        [(i, u, s, ts(t)) for i, u, s, t in steps], "event_id int, user_id string, status string, date timestamp"
    )
    for frame, tie_break in ((df, "event_id"), (df.drop("event_id"), "status")):
        churn = company.monthly_churn(frame, tie_break)
        assert sorted(churn.collect()) == [("2024-01", 2), ("2024-02", 1)]


def test_streak_over_month_end(spark):
    days = [D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1), D(2024, 2, 1), D(2024, 2, 5), D(2024, 2, 6)]
    df = spark.createDataFrame([("u", d) for d in days], "user_id string, login_date date")
    assert company.login_streaks(df).collect() == [("u", D(2024, 1, 30))]


def test_duplicates_on_one_day(spark):
    df = spark.createDataFrame(
        [(1, 5.0, ts("2024-01-01 01:00:00")), (1, 5.0, ts("2024-01-01 23:00:00"))]
        + [(1, 5.0, ts("2024-01-02 01:00:00")), (2, 5.0, ts("2024-01-01 01:00:00"))],
        "user_id int, amount double, transaction_date timestamp",
    )
    assert company.duplicate_transactions(df).collect() == [(1, 5.0, D(2024, 1, 1), 2)]


# --- shop ------------------------------------------------------------------------


def item(item_id, revenue, quantity, coupon=None, name=None, price=1.0):
    return (coupon, item_id, name or item_id, revenue, price, quantity)


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("1", "a", ts("2024-01-31 23:59:00"), 3.0, 3, [item("x", 1.0, 1, "C"), item("y", 2.0, 2)]),
        ("2", "a", ts("2024-02-01 00:01:00"), 5.0, None, []),
        ("2", "a", ts("2024-02-01 00:01:00"), 5.0, 4, None),
        ("3", None, ts("2023-08-01 00:00:00"), None, 1, [item("x", None, 5, None, "alias")]),
        ("4", "b", ts("2024-01-20 00:00:00"), -1.0, 1, [item("z", 0.005, 1)]),
    ]
    return spark.createDataFrame(
        rows,
        "order_id string, email string, transaction_timestamp timestamp, "
        f"purchase_revenue_in_usd double, total_item_quantity bigint, items {schemas.ITEMS}",
    )


def test_explode_drops_empty_and_null(sales):
    rows = shop.sales_items(sales)
    assert rows.count() == sales.selectExpr("sum(size(items))").first()[0] == 4
    assert rows.columns[:3] == shop.SALE and len(rows.columns) == 9


def test_item_totals(sales):
    assert shop.revenue_per_item(sales).collect() == [("y", 2.0), ("x", 1.0), ("z", 0.01)]
    assert shop.top_products(sales, 1).collect() == [("x", 6)]
    stats = {r.item_id: tuple(r)[1:] for r in shop.product_stats(sales).collect()}
    assert stats["x"] == ("alias", 6, 1.0, 1.0)


def test_prices_of_unknown_products(spark, sales):
    products = spark.createDataFrame([("x", "X", 9.0)], "item_id string, name string, price double")
    prices = {(r.order_id, r.item_id): r.product_price for r in shop.sales_priced(sales, products).collect()}
    assert prices == {("1", "x"): 9.0, ("1", "y"): None, ("3", "x"): 9.0, ("4", "z"): None}
    best = shop.top_products_detail(sales, products, 2).collect()
    assert best == [("y", None, None, 2.0), ("x", "X", 9.0, 1.0)]


def test_coupon_shares(sales):
    rows = {r.segment: r for r in shop.coupon_split(sales).collect()}
    assert (rows["coupon"].revenue, rows["no_coupon"].revenue) == (1.0, 2.01)
    assert (rows["coupon"].line_items, rows["no_coupon"].line_items) == (1, 3)
    assert sum(r.pct_revenue for r in rows.values()) == pytest.approx(100, abs=0.02)
    assert rows["coupon"].pct_quantity == 11.11


def test_correlation_skips_pairs_with_null(spark):
    lines = [(1, 10.0), (2, 25.0), (3, 28.0), (4, None)]
    df = spark.createDataFrame(
        [(str(q), [item("x", r, q)]) for q, r in lines], f"order_id string, items {schemas.ITEMS}"
    )
    line = shop.product_correlation(df).where("grain = 'line'").first()
    known = spark.createDataFrame(lines[:3], "q int, r double").selectExpr("corr(q, r)").first()[0]
    assert (line.n, line["corr"]) == (4, pytest.approx(known))


def test_buyers(sales):
    value = {r.email: (r.clv, r.orders) for r in shop.lifetime_value(sales).collect()}
    assert value == {"a": (13.0, 2), "b": (-1.0, 1), None: (None, 1)}
    often = {r.email: tuple(r)[1:3] + tuple(r)[5:] for r in shop.purchase_frequency(sales).collect()}
    assert often["a"] == (2, 2, 1, 1.0)
    total = shop.average_items(sales).first()
    assert tuple(total) == (5, 9, 2.25)


def test_recency_counts_calendar_days(sales):
    days = {r.email: r.days_since_last for r in shop.recency(sales).collect()}
    assert days == {"a": 0, "b": 12, None: 184}
    assert [r.email for r in shop.churned(sales).collect()] == [None]
    buckets = [tuple(r) for r in shop.recency_buckets(sales).collect()]
    assert buckets == [("0-7d", 1, 13.0), ("15d+", 1, None), ("8-14d", 1, -1.0)]


def test_touch_to_purchase(spark, sales):
    users = spark.createDataFrame(
        [("a", ts("2024-02-02 00:00:00")), ("a", ts("2024-01-31 22:59:00")), ("b", ts("2024-01-20 12:00:00"))]
        + [(None, ts("2020-01-01 00:00:00")), ("c", ts("2020-01-01 00:00:00"))],
        "email string, user_first_touch_timestamp timestamp",
    )
    rows = {r.user: (r.hours, r.days) for r in shop.touch_to_purchase(sales, users).collect()}
    assert rows == {"a": (1.0, 0.04), "b": (-12.0, -0.5)}
    assert tuple(shop.touch_to_purchase_average(sales, users).first()) == (-5.5, -0.23, 2)


def test_negative_value_stops_the_gold_table(sales):
    with pytest.raises(Exception, match="positive_clv"):
        layers.gold_customer_ltv(sales).collect()
    with pytest.raises(Exception, match="positive_clv"):
        layers.gold_customer_ltv(sales.where("email = 'b'")).select("email").collect()
    assert layers.gold_customer_ltv(sales.where("email = 'a'")).collect() == [("a", 13.0, 2)]


# --- events ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def events(spark):
    def event(user, name, source, city, state, revenue=None, items=None):
        basket = (revenue, 1, 1) if revenue is not None else None
        return (user, name, source, ts("2024-01-01 00:00:00"), (city, state), basket, items)

    rows = [
        event("u1", "main", "g", "Rome", "IT"),
        event("u1", "finalize", "g", "Rome", "IT", 10.0, [item("x", 10.0, 1)]),
        event("u2", "main", "g", None, None, None, [item("x", 3.0, 1)]),
        event("u3", "finalize", None, "Bonn", "DE", 4.0, [item("y", 4.0, 1)]),
        event(None, "finalize", "z", "Bonn", "DE", 0.0, []),
        event(None, "main", "z", "Bonn", "DE"),
    ]
    return spark.createDataFrame(
        rows,
        "user_id string, event_name string, traffic_source string, event_timestamp timestamp, "
        f"geo {schemas.GEO}, ecommerce {schemas.ECOMMERCE}, items {schemas.ITEMS}",
    )


def test_conversion(events):
    rows = {r.traffic_source: tuple(r)[1:] for r in traffic.conversion_by_source(events).collect()}
    assert rows == {"g": (2, 1, 0.5), None: (1, 1, 1.0), "z": (0, 0, None)}


def test_revenue_over_steps(events):
    assert dict(traffic.revenue_per_source(events).collect()) == {"g": 13.0, None: 4.0}
    assert dict(traffic.revenue_per_source(events, purchase_only=True).collect()) == {"g": 10.0, None: 4.0}
    assert traffic.revenue_by_state(events).collect() == [("IT", 10.0), ("DE", 4.0)]
    assert traffic.revenue_by_state(events, count=1).collect() == [("IT", 10.0)]


def test_event_impact(events):
    rows = {r.event_name: tuple(r)[1:] for r in traffic.event_impact(events).collect()}
    assert rows["main"] == (3, 0, None, None, None)
    assert rows["finalize"] == (3, 2, 14.0, 4.67, 5.03)


def test_cities(events):
    assert dict(traffic.active_users_per_city(events).collect()) == {"Rome": 1, None: 1, "Bonn": 1}
    assert traffic.monthly_events(events).collect() == [("2024-01", 6)]


def test_silver_drops_copies_and_unknown_users(events):
    clean = layers.silver_events(events.unionAll(events))
    assert clean.count() == 4
    assert layers.silver_events(clean).count() == 4
    assert layers.silver_event_items(clean).count() == 3


def test_overview(sales, events):
    tables = {"sales": sales, "events": events}
    assert dict(overview.table_counts(tables).collect()) == {"sales": 5, "events": 6}
    lines = {(r.table, r.column): (r.position, r.type, r.filled) for r in overview.table_schemas(tables).collect()}
    assert lines["sales", "email"] == (2, "string", 4)
    assert lines["sales", "items"] == (6, schemas.ITEMS, 4)


# --- exact numbers -------------------------------------------------------------------


def test_half_cents_round_up_whatever_the_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.705,), (None,)], "x double")
    for frame in (df, df.orderBy(F.desc("x")), df.repartition(4)):
        assert frame.agg(sum_of("x"), mean_of("x")).first() == (1.01, 0.34)


def test_large_and_negative_amounts(spark):
    df = spark.createDataFrame([(9e15,), (0.25,), (-0.5,), (-1234.567891,)], "x double")
    assert df.agg(sum_of("x", 6)).first()[0] == pytest.approx(9e15 - 1234.817891, abs=1)
    assert df.where("x < 1").agg(sum_of("x", 6)).first() == (-1234.817891,)
    assert spark.createDataFrame([(-0.005,)], "x double").agg(sum_of("x")).first() == (-0.01,)


def test_empty_groups(spark):
    df = spark.createDataFrame([], "x double")
    assert df.agg(sum_of("x"), mean_of("x")).first() == (None, None)
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0), 2)).first() == (None,)


def test_nan_is_refused(spark):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        spark.createDataFrame([(float("nan"),)], "x double").agg(sum_of("x")).collect()


def test_amounts_with_more_places_are_not_cut(spark):
    from tillflow.functions import mean_of, sum_of

    tiny = spark.range(1_000_000).select(F.lit(4e-7).alias("v"))
    assert tiny.select(sum_of("v", 4).alias("s")).first().s == 0.4
    mixed = spark.createDataFrame([(1e9 + 0.25,), (0.1234567,), (-3e-7,), (None,)], "v double")
    got = mixed.select(sum_of("v", 6).alias("s"), mean_of("v", 3).alias("m")).first()
    assert got.s == pytest.approx(1e9 + 0.3734564, abs=1e-6) and got.m == pytest.approx(333333333.458, abs=1e-3)
    cents = spark.range(1000).select((F.col("id") * 0.01 + 1e7).alias("v"))
    assert cents.select(sum_of("v").alias("s")).first().s == 10_000_004_995.0


def test_pieces_grow_with_the_rows(spark, monkeypatch):
    from tillflow.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_PIECE", 500)
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id", F.lit(1).alias("v"))
    assert ordered.piece_count(df) == 40
    cut = ordered.into_pieces(df, ["k"], ["id"])
    sizes = [r["count"] for r in cut.groupBy("_piece").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 1500
    got = ordered.running_sum(df, ["k"], ["id"], "v", into="s")
    assert got.where("s <> id + 1").count() == 0
    monkeypatch.setattr(ordered, "MOST_BROADCAST", 10)
    before = ordered.previous_value(df, ["k"], ["id"], "id", into="p")
    assert before.where("p <> id - 1").count() == 0 and before.where("p IS NULL").count() == 1
