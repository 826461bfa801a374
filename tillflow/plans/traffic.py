"""Clickstream events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import each_item, item_rows, mean_of, moments, month_of, ratio, sum_of
from tillflow.schemas import PURCHASE

EVENT = ["user_id", "event_name", "traffic_source", "event_timestamp"]


def event_items(events: DataFrame) -> DataFrame:
    """One row per item of an event, with place and basket figures."""
    basket = ["purchase_revenue_in_usd", "total_item_quantity", "unique_items"]
    return item_rows(events, *EVENT, "geo.city", "geo.state", *[f"ecommerce.{b}" for b in basket])


def monthly_events(events: DataFrame) -> DataFrame:
    return events.groupBy(month_of("event_timestamp").alias("month")).count().orderBy("month")


def active_users_per_city(events: DataFrame) -> DataFrame:
    """Distinct users per city; unknown cities form one group."""
    return (
        events.groupBy(F.col("geo.city").alias("city"))
        .agg(F.count_distinct("user_id").alias("active_users"))
        .orderBy(F.desc("active_users"), "city")
    )


def _only(events: DataFrame, purchase_only: bool) -> DataFrame:
    return events.where(F.col("event_name") == PURCHASE) if purchase_only else events


def revenue_per_source(events: DataFrame, purchase_only: bool = False) -> DataFrame:
    """Item revenue by traffic source, over all funnel steps unless ``purchase_only``."""
    return (
        each_item(_only(events, purchase_only), ["item_revenue_in_usd"], "traffic_source")
        .groupBy("traffic_source")
        .agg(sum_of("item_revenue_in_usd").alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "traffic_source")
    )


def revenue_by_state(
    events: DataFrame, purchase_only: bool = False, count: int | None = None
) -> DataFrame:
    """Item revenue by known state; with ``count`` the best ones only."""
    located = _only(events, purchase_only).where(F.col("geo.state").isNotNull())
    states = (
        each_item(located, ["item_revenue_in_usd"], F.col("geo.state").alias("state"))
        .groupBy("state")
        .agg(sum_of("item_revenue_in_usd").alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "state")
    )
    return states if count is None else states.limit(count)


def event_impact(events: DataFrame) -> DataFrame:
    """Revenue figures by kind of event; the deviation of a single value is NULL."""
    paid = F.col("ecommerce.purchase_revenue_in_usd")
    return (
        events.groupBy("event_name")
        .agg(
            F.count("*").alias("num_events"),
            F.count_if(paid > 0).alias("events_with_rev"),
            sum_of(paid).alias("total_revenue"),
            mean_of(paid).alias("avg_rev_per_event"),
            F.round(F.stddev_samp(paid), 2).alias("stddev_rev"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "event_name")
    )


def event_significance(events: DataFrame, by: str = "event_name") -> DataFrame:
    """Whether revenue differs between kinds of event: a one-way analysis of variance.

    ``by`` names the column that tells the kinds apart; NULL is a kind.

    Events without revenue figures are left out. ``f`` compares the spread between the kinds with that
    inside them, ``p`` is the chance of such an ``f`` if all kinds were alike, and ``explained`` the
    share of the whole spread that lies between them.
    """
    paid = F.col("ecommerce.purchase_revenue_in_usd")
    per_kind = events.groupBy(by).agg(
        *[value.alias(name) for name, value in moments.moments(paid).items()]
    ).where(F.col(moments.N) > 0)
    whole, between = moments.merged(per_kind)
    parts = per_kind.agg(
        F.count("*").alias("kinds"),
        F.coalesce(whole[moments.N], F.lit(0)).alias("events"),
        between[moments.XX].alias("_between"),
        F.sum(moments.XX).alias("_within"),
    )
    ratio, chance = moments.f_test(F.col("_between"), F.col("_within"), F.col("kinds"), F.col("events"))
    explained = F.try_divide(F.col("_between"), F.col("_between") + F.col("_within"))
    return parts.select("kinds", "events", ratio.alias("f"), chance.alias("p"), explained.alias("explained"))


def conversion_by_source(events: DataFrame, step: str = PURCHASE) -> DataFrame:
    """Distinct buyers over distinct visitors by traffic source.

    One row per source and user, then one per source: a single pass in which even
    one dominant source is spread over its users. An unknown source keeps its
    buyers; a source without known users has no rate.
    """
    per_user = events.groupBy("traffic_source", "user_id").agg(
        F.max(F.coalesce(F.col("event_name") == step, F.lit(False))).alias("_bought")
    )
    return (
        per_user.groupBy("traffic_source")
        .agg(
            F.count("user_id").alias("visitors"),
            F.count_if(F.col("_bought") & F.col("user_id").isNotNull()).alias("buyers"),
        )
        .withColumn("conversion_rate", ratio(F.col("buyers"), F.col("visitors"), 4))
        .orderBy(F.desc_nulls_last("conversion_rate"), "traffic_source")
    )
