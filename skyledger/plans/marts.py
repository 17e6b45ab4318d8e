"""Enriched deliveries and the city and restaurant marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.bands import revenue_tier
from skyledger.functions.numbers import round_sql
from skyledger.functions.sums import exact_avg, exact_sum
from skyledger.operators.lookups import lookup_join
from skyledger.operators.shared import Settled


def enrich_orders(
    orders: DataFrame, summary: DataFrame | Settled, null_safe: bool = True, **limits: int
) -> DataFrame:
    """Every order with the weather of its city. Dataframe merges match null keys to each other."""
    return lookup_join(orders, summary, ["city"], "left", null_safe, **limits)


def int_orders_enriched(
    deliveries: DataFrame, weather: DataFrame | Settled, **limits: int
) -> DataFrame:
    per_degree = F.col("amount") / F.nullif(F.col("avg_temp"), F.lit(0.0))
    return lookup_join(deliveries, weather, ["city"], "left", **limits).select(
        "delivery_id",
        "city",
        "status",
        "amount",
        "is_high_value",
        "order_date",
        "avg_temp",
        round_sql(per_degree, 2).alias("revenue_per_degree"),
    )


def _ranked(mart: DataFrame, ordered: bool) -> DataFrame:
    """Highest revenue first. Jobs that store a mart leave it out: stored rows keep no order."""
    return mart.orderBy(F.desc_nulls_last("total_revenue")) if ordered else mart


def mart_city_summary(enriched: DataFrame, ordered: bool = True) -> DataFrame:
    mart = (
        enriched.groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            exact_sum("amount").alias("total_revenue"),
            round_sql(exact_avg("amount"), 2).alias("avg_order_value"),
            F.count_if(F.col("status") == "delivered").alias("delivered_count"),
            round_sql(exact_avg("avg_temp"), 1).alias("avg_temp"),
            round_sql(exact_avg("revenue_per_degree"), 4).alias("avg_revenue_per_degree"),
        )
    )
    return _ranked(mart, ordered)


def int_orders_by_restaurant(orders: DataFrame) -> DataFrame:
    return orders.groupBy("restaurant_name", "restaurant_category").agg(
        exact_sum("order_total").alias("total_orders"),
        exact_sum("order_revenue").alias("total_revenue"),
        round_sql(exact_avg("order_total"), 2).alias("avg_order_value"),
        F.sum(F.col("is_free_delivery").cast("int")).alias("free_delivery_count"),
    )


def mart_restaurant_summary(
    by_restaurant: DataFrame, high: float = 100, low: float = 50, ordered: bool = True
) -> DataFrame:
    tier = revenue_tier("total_revenue", high, low)
    return _ranked(by_restaurant.withColumn("revenue_tier", tier), ordered)


def mart_restaurant_daily(orders: DataFrame, high: float = 200, low: float = 100) -> DataFrame:
    return (
        orders.groupBy("order_date", "restaurant_name")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            exact_sum("amount").alias("total_revenue"),
            exact_avg("amount").alias("avg_order_value"),
        )
        .withColumn("revenue_tier", revenue_tier("total_revenue", high, low))
    )


def mart_city_orders(
    orders: DataFrame, unique: Column | None = None, ordered: bool = True
) -> DataFrame:
    """City totals. Pass an approximate distinct count as `unique` if an estimate will do."""
    if unique is None:
        unique = F.count_distinct("restaurant_name")
    mart = (
        orders.groupBy("customer_city")
        .agg(
            exact_sum("order_total").alias("total_orders"),
            exact_sum("order_revenue").alias("total_revenue"),
            exact_avg("order_total").alias("avg_order_value"),
            unique.alias("unique_restaurants"),
        )
    )
    return _ranked(mart, ordered)
