"""Analytic questions over deliveries: ranks, running totals, averages, day series.

Cities are few and one may hold a large part of all rows, so no question here puts the rows of a
city into one task. Values of a whole city are aggregated and looked up; running totals work on
daily totals; row numbers and previous values come from the range-sorted operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.dates import days_of
from skyledger.functions.numbers import round_sql
from skyledger.functions.sums import exact_avg, exact_sum, merge_states, state_sum, sum_state
from skyledger.operators.lookups import lookup_join
from skyledger.operators.ordered import WINDOW_ROWS, with_previous, with_row_number
from skyledger.operators.shared import settle

CITY = ["city"]


def rank_in_city(deliveries: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Position by falling amount; equal amounts go by id."""
    order = [F.desc_nulls_last("amount"), F.asc_nulls_last("id")]
    rows = deliveries.select("id", "city", "amount")
    return with_row_number(rows, CITY, order, "rank_in_city", window_rows)


def running_total(deliveries: DataFrame, **limits: int) -> DataFrame:
    """Total of the city up to and including the order's day; orders of one day share a value.

    The value depends on city and day alone, so the window runs over one row per city and day.
    """
    # Partial sums, so that the running total is rounded once and not day by day.
    days = deliveries.groupBy("city", "order_date").agg(sum_state("amount").alias("day_total"))
    so_far = (
        Window.partitionBy("city")
        .orderBy(F.asc_nulls_last("order_date"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = days.select("city", "order_date", merge_states("day_total", so_far).alias("so_far"))
    totals = totals.select("city", "order_date", state_sum("so_far").alias("running_total"))
    rows = deliveries.select("id", "city", "order_date", "amount")
    return lookup_join(rows, totals, ["city", "order_date"], "inner", null_safe=True, **limits)


def vs_city_average(deliveries: DataFrame, **limits: int) -> DataFrame:
    averages = deliveries.groupBy("city").agg(exact_avg("amount").alias("average"))
    rows = deliveries.select("id", "city", "amount")
    return lookup_join(rows, averages, CITY, "inner", null_safe=True, **limits).select(
        "id",
        "city",
        "amount",
        round_sql(F.col("average"), 2).alias("city_avg"),
        round_sql(F.col("amount") - F.col("average"), 2).alias("diff_from_avg"),
    )


def day_change(deliveries: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Amount beside that of the previous order in the city, by date and then id."""
    order = [F.asc_nulls_last("order_date"), F.asc_nulls_last("id")]
    rows = deliveries.select("id", "city", "order_date", "amount")
    return with_previous(rows, CITY, order, "amount", "prev_amount", window_rows).withColumn(
        "day_change", F.col("amount") - F.col("prev_amount")
    )


def top_orders(deliveries: DataFrame, columns: Sequence[str], **limits: int) -> DataFrame:
    """Orders of the highest amount of their city, ties kept, with the city average."""
    best = deliveries.groupBy("city").agg(
        F.max("amount").alias("top_amount"), exact_avg("amount").alias("average")
    )
    rows = deliveries.select(*columns)
    return lookup_join(rows, best, CITY, "inner", null_safe=True, **limits).where(
        F.col("amount").eqNullSafe(F.col("top_amount"))
    )


def top_order(deliveries: DataFrame, **limits: int) -> DataFrame:
    columns = ["id", "city", "amount", "status"]
    return top_orders(deliveries, columns, **limits).select(*columns)


def top_vs_average(deliveries: DataFrame, **limits: int) -> DataFrame:
    # A null city has top orders but, as null keys do not join, no average beside them.
    average = F.when(F.col("city").isNotNull(), F.col("average"))
    return top_orders(deliveries, ["city", "amount"], **limits).select(
        "city",
        "top_amount",
        round_sql(average, 2).alias("city_avg"),
        round_sql(F.col("top_amount") - average, 2).alias("diff"),
    )


def delivered_revenue(deliveries: DataFrame, threshold: float = 100) -> DataFrame:
    revenue = (
        deliveries.where(F.col("status") == "delivered")
        .groupBy("city")
        .agg(exact_sum("amount").alias("revenue"))
    )
    return revenue.withColumn("exceeds_100", F.col("revenue") > threshold)


def daily_totals(deliveries: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Total per day of a series, 0 on days without orders.

    Orders are added up by day before the join, so both sides of it are one row per day.
    """
    totals = settle(
        deliveries.groupBy(F.col("order_date").alias("date")).agg(
            exact_sum("amount").alias("total")
        ),
        "day_totals",
    ).frame
    # First and last day come from the totals, so the deliveries are read once.
    series = days_of(totals, "date") if days is None else days
    return (
        series.join(totals, "date", "left")
        .select("date", F.coalesce("total", F.lit(0.0)).alias("total_amount"))
        .orderBy("date")
    )


def above_city_average(deliveries: DataFrame, **limits: int) -> DataFrame:
    averages = deliveries.groupBy("city").agg(exact_avg("amount").alias("average"))
    rows = deliveries.select("id", "city", "amount", "status")
    return (
        lookup_join(rows, averages, CITY, "inner", **limits)
        .where(F.col("amount") > F.col("average"))
        .select("id", "city", "amount", "status", round_sql(F.col("average"), 2).alias("city_avg"))
    )


def above_city_average_rows(deliveries: DataFrame, **limits: int) -> DataFrame:
    """The same orders as they are, without the average they were compared with."""
    return above_city_average(deliveries, **limits).drop("city_avg")
