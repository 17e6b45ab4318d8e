"""Staged tables: cast once, filter once, keep lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.bands import above, order_tier
from skyledger.functions.numbers import (
    cents_to_dollars,
    number,
    to_double,
    to_whole,
    where_number,
)
from skyledger.functions.text import not_blank, sql_tidy
from skyledger.operators.cleaning import HIGH_VALUE

RESTAURANT_HIGH_VALUE = 80


def stg_deliveries(
    deliveries: DataFrame, threshold: float = HIGH_VALUE, high: float = 100, low: float = 50
) -> DataFrame:
    """Deliveries with a numeric amount and a city. A bad order date fails the query.

    The tier reads the parsed amount: the source may keep amounts as text.
    """
    return (
        where_number(deliveries.where(not_blank("city")), "amount")
        .select(
            F.col("id").alias("delivery_id"),
            sql_tidy("city").alias("city"),
            sql_tidy("status").alias("status"),
            "amount",
            F.col("order_date").cast("date").alias("order_date"),
        )
        .withColumns(
            {
                "is_high_value": above("amount", threshold),
                "amount_usd": cents_to_dollars("amount"),
                "order_tier": order_tier("amount", high, low),
            }
        )
    )


def stg_weather(summary: DataFrame) -> DataFrame:
    return summary.withColumn("city", sql_tidy("city"))


def stg_weather_raw(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("temperature_c").isNotNull()).select(
        sql_tidy("city").alias("city"),
        F.col("time").try_cast("timestamp_ntz").alias("recorded_at"),
        "temperature_c",
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Delivered orders of an all-text table."""
    return (
        raw_orders.select(
            to_whole("order_id").alias("order_id"),
            sql_tidy("customer_city").alias("customer_city"),
            sql_tidy("restaurant_name").alias("restaurant_name"),
            sql_tidy("restaurant_category").alias("restaurant_category"),
            to_double("order_total").alias("order_total"),
            to_double("delivery_fee").alias("delivery_fee"),
            sql_tidy("order_status").alias("order_status"),
            F.col("ordered_at").try_cast("timestamp_ntz").alias("ordered_at"),
        )
        .where(F.col("order_status") == "delivered")
        .withColumns(
            {
                "order_revenue": F.col("order_total") - F.col("delivery_fee"),
                "is_free_delivery": F.col("delivery_fee") == 0,
            }
        )
    )


def stg_restaurant_orders(
    orders: DataFrame, threshold: float = RESTAURANT_HIGH_VALUE
) -> DataFrame:
    """Restaurant orders whose raw status is exactly `delivered`."""
    return (
        orders.where(F.col("status") == "delivered")
        .select(
            "order_id",
            F.lower("restaurant_name").alias("restaurant_name"),
            F.lower("city").alias("city"),
            number(orders, "amount").alias("amount"),
            "status",
            "order_date",
        )
        .withColumn("is_high_value", above("amount", threshold))
    )
