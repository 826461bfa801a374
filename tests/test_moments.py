"""Centred moments, correlation near 1e9, and the analysis of variance against published figures."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.functions import moments
from tillflow.plans import shop, traffic

ITEMS = (
    "items array<struct<item_id:string,item_name:string,quantity:bigint,item_revenue_in_usd:double,"
    "price_in_usd:double,coupon:string>>"
)


def sales(spark, lines):
    rows = [([(i, "n", q, r, 1.0, None)],) for i, q, r in lines]
    return spark.createDataFrame(rows, ITEMS)


@pytest.mark.parametrize("base", [0.0, 1e9, 1e12])
def test_correlation_of_large_amounts(spark, base):
    rng = random.Random(7)
    lines = [(f"i{k % 40}", q := rng.randint(1, 9), base + 100 * q + rng.uniform(0, 3)) for k in range(2000)]
    got = {r.grain: r for r in shop.product_correlation(sales(spark, lines)).collect()}
    x, y = np.array([x[1] for x in lines], float), np.array([x[2] for x in lines])
    assert got["line"].n == 2000 and got["product"].n == 40
    assert got["line"]["corr"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)


def test_correlation_without_spread_or_rows(spark):
    still = [("a", 2, 5.0), ("a", 2, 6.0)]
    assert {r.grain: (r.n, r["corr"]) for r in shop.product_correlation(sales(spark, still)).collect()} == {
        "product": (1, None), "line": (2, None),
    }
    got = shop.product_correlation(sales(spark, [])).collect()
    assert sorted((r.grain, r.n, r["corr"]) for r in got) == [("line", 0, None), ("product", 0, None)]


def test_merged_moments(spark):
    rng = random.Random(3)
    data = [(k % 7, 1e9 + rng.gauss(0, 3), 1e9 + rng.gauss(0, 2)) for k in range(3000)] + [(1, None, 2.0)]
    df = spark.createDataFrame(data, "k int, x double, y double")
    parts = df.groupBy("k").agg(*[v.alias(n) for n, v in moments.moments(F.col("x"), F.col("y")).items()])
    whole, _ = moments.merged(parts)
    got = parts.agg(*[v.alias(n) for n, v in whole.items()]).first()
    x, y = np.array([d[1:] for d in data[:-1]]).T
    assert got[moments.N] == 3000
    assert got[moments.XX] == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-7)
    assert got[moments.XY] == pytest.approx(((x - x.mean()) * (y - y.mean())).sum(), rel=1e-4, abs=1e-3)


def simpson(a: float, b: float, x: float, steps: int = 20_000) -> float:
    """The incomplete beta function by numeric integration over the square root of the place."""
    low, total = math.sqrt(1 - x), 0.0
    for i in range(steps + 1):
        u = low + (1 - low) * i / steps
        weight = 1 if i in (0, steps) else 4 if i % 2 else 2
        total += weight * 2 * max(1 - u * u, 1e-300) ** (a - 1) * u ** (2 * b - 1)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
    return total * scale * (1 - low) / 3 / steps


def test_incomplete_beta(spark):
    cases = [(2.0, 3.0, 0.4), (5.0, 1.5, 0.9), (50.0, 2.0, 0.97), (500.0, 1.0, 0.995), (1.5, 0.5, 0.2), (30.0, 30.0, 0.5)]
    df = spark.createDataFrame(cases, "a double, b double, x double")
    got = df.select("a", "b", "x", moments.beta_share(F.col("a"), F.col("b"), F.col("x")).alias("i")).collect()
    for r in got:
        assert r.i == pytest.approx(simpson(r.a, r.b, r.x), abs=1e-7)
    gammas = spark.createDataFrame([(0.5,), (1.0,), (7.5,), (1e6,)], "x double")
    for r in gammas.select("x", moments.log_gamma(F.col("x")).alias("g")).collect():
        assert r.g == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-12)


def events(spark, groups):
    rows = [(k, (v, 1, 1) if v is not None else None) for k, values in groups.items() for v in values]
    kind = "struct<purchase_revenue_in_usd:double,total_item_quantity:bigint,unique_items:bigint>"
    return spark.createDataFrame(rows, f"event_name string, ecommerce {kind}")


def test_significance_of_a_worked_example(spark):
    """Three groups of six with F = 9.26 at 2 and 15 degrees of freedom, p = 0.0024."""
    groups = {"a": [6, 8, 4, 5, 3, 4], "b": [8, 12, 9, 11, 6, 8], "c": [13, 9, 11, 8, 7, 12], "d": [None, None]}
    got = traffic.event_significance(events(spark, {k: [v and float(v) for v in vs] for k, vs in groups.items()})).first()
    assert (got.kinds, got.events) == (3, 18)
    assert got.f == pytest.approx(9.264706, abs=1e-6)
    assert got.p == pytest.approx(0.0023988, abs=1e-6)
    assert got.explained == pytest.approx(84 / 152)


def test_significance_far_from_zero_and_without_a_difference(spark):
    rng = random.Random(2)
    alike = {k: [1e9 + rng.gauss(0, 1) for _ in range(300)] for k in "abcd"}
    got = traffic.event_significance(events(spark, alike)).first()
    values = np.array(list(alike.values()))
    between = 300 * ((values.mean(1) - values.mean()) ** 2).sum() / 3
    within = ((values - values.mean(1)[:, None]) ** 2).sum() / (1200 - 4)
    assert got.f == pytest.approx(between / within, rel=1e-4)
    assert got.p == pytest.approx(simpson(598, 1.5, 1196 / (1196 + 3 * got.f)), abs=1e-6)
    assert 0 <= got.p <= 1
    for groups in ({}, {"a": [1.0, 2.0]}, {"a": [1.0], "b": [2.0]}, {"a": [3.0, 3.0], "b": [3.0]}):
        none = traffic.event_significance(events(spark, groups)).first()
        assert (none.f, none.p) == (None, None)
