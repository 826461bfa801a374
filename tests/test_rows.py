import datetime

import pytest
from pyspark.sql import functions as F

from tillflow.operators.rows import first_rows, one_per_key, repeated, streaks, without


def day(number):
    return datetime.date(2024, 1, 30) + datetime.timedelta(days=number)


def test_first_rows_with_hot_key(spark):
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("key")
    )
    best = first_rows(df, ["key"], [F.desc("id")], 2)
    assert best.groupBy("key").count().where("count <> 2").count() == 0
    assert [r.id for r in best.where("key = -1").orderBy("id").collect()] == [19995, 19998]


def test_one_per_key(spark):
    rows = [("a", 2, [1]), ("a", 1, [3]), ("a", 1, [2]), (None, 5, None), (None, 4, None), ("b", 1, [])]
    df = spark.createDataFrame(rows, "key string, n int, list array<int>")
    once = one_per_key(df, ["key"])
    assert sorted(once.collect(), key=str) == sorted(
        [("a", 1, [2]), (None, 4, None), ("b", 1, [])], key=str
    )
    assert sorted(one_per_key(once, ["key"]).collect(), key=str) == sorted(once.collect(), key=str)


def test_repeated(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (1, 3.0), (None, 1.0), (None, 1.0)], "u int, x double")
    assert set(repeated(df, "u", "x").collect()) == {(1, 2.0, 2), (None, 1.0, 2)}


def test_without_keeps_null_and_ignores_null(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert set(without(left, right, "k").collect()) == {(1,), (None,)}


def test_streaks(spark):
    days = [(1, 0), (1, 1), (1, 1), (1, 2), (1, 3), (1, 6), (1, 7), (2, 0), (2, 2), (2, 4)]
    days += [(3, 0), (3, 1), (3, 2), (3, 5), (3, 6), (3, 7)]
    df = spark.createDataFrame([(u, day(d)) for u, d in days] + [(3, None)], "u int, d date")
    found = sorted(streaks(df, "u", "d", 3).collect())
    assert found == [(1, day(0), 4), (3, day(0), 3), (3, day(5), 3)]


def test_streak_days_add_up(spark):
    df = spark.range(500).select(
        (F.col("id") % 7).alias("u"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(40))).alias("d"),
    )
    total = streaks(df, "u", "d", 1).agg(F.sum("streak_days")).first()[0]
    assert total == df.distinct().count()


def test_small_amounts_and_long_keys(spark):
    """Amounts far below a cent add up, and a total just below zero breaks its rule."""
    from tillflow.functions import off_scale, total_of
    from tillflow.operators.quality import enforce
    from tillflow.plans import layers

    tiny = spark.range(1_000_000).select(F.lit(4e-7).alias("x"))
    assert abs(tiny.agg(total_of("x")).first()[0] - 0.4) < 1e-9
    assert tiny.agg(off_scale("x", 2)).first()[0] == 1_000_000
    assert spark.sql("SELECT 0.29D AS x UNION ALL SELECT 1234567.89D").agg(off_scale("x", 2)).first()[0] == 0
    below = spark.sql("SELECT 'e' AS email, -4e-7D AS clv")
    with pytest.raises(Exception, match="positive_clv"):
        enforce(below, layers.RULES["gold_customer_ltv"]).collect()


def test_buyers_with_ten_digit_keys_stay_apart(spark, tmp_path):
    from tillflow.plans import shop
    from tillflow.sources import retail

    keys = (1234567890, 1234567891)
    spark.createDataFrame([(k, f"Customer#{k}") for k in keys], "c_custkey long, c_name string").write.parquet(
        f"{tmp_path}/customer.parquet"
    )
    orders = [(n, k, 10.0 * n) for n, k in enumerate(keys, 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").withColumn(
        "o_orderdate", F.lit("1997-01-01").cast("timestamp_ntz")
    ).write.parquet(f"{tmp_path}/orders.parquet")
    report = shop.revenue_per_user(retail.purchases(spark, str(tmp_path)), retail.BUYER)
    found = {r.email: r.total_revenue for r in retail.named(spark, str(tmp_path), report).collect()}
    assert found == {"Customer#1234567890": 10.0, "Customer#1234567891": 20.0}
