"""The data checks of the staged tables and marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.quality import (
    Check,
    Checked,
    accepted_values,
    custom,
    not_null,
    quality_report,
    unique,
)


def suite() -> list[Check]:
    return [
        *unique("stg_deliveries", "delivery_id"),
        *not_null("stg_deliveries", "delivery_id", "city", "status", "amount"),
        *accepted_values("stg_deliveries", "status", ["delivered", "cancelled"]),
        *custom(
            "stg_deliveries",
            "no_negative_amount_when_delivered",
            "amount",
            (F.col("amount") < 0) & (F.col("status") == "delivered"),
        ),
        *not_null("stg_weather", "city", "avg_temp"),
        *unique("stg_weather", "city"),
        *not_null("stg_orders", "order_id", "order_status", "order_total"),
        *unique("stg_orders", "order_id"),
        *accepted_values("stg_orders", "order_status", ["delivered"]),
        *not_null("stg_restaurant_orders", "order_id"),
        *unique("stg_restaurant_orders", "order_id"),
        *not_null("mart_city_summary", "city", "total_revenue"),
        *unique("mart_city_summary", "city"),
        *custom("mart_city_summary", "revenue_positive", "total_revenue",
                F.col("total_revenue") <= 0),
        *not_null("mart_restaurant_summary", "restaurant_name", "total_revenue"),
        *unique("mart_restaurant_summary", "restaurant_name"),
        *not_null("mart_restaurant_daily", "total_revenue"),
    ]


def report(tables: Mapping[str, DataFrame | Checked]) -> DataFrame:
    return quality_report(tables, suite())
