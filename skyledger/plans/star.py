"""Star schema, wide view, and the normalised split of wide orders."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.bands import above
from skyledger.functions.dates import calendar_parts, day_series, days_between, days_of
from skyledger.functions.numbers import number, round_sql
from skyledger.functions.sums import exact_avg, exact_sum
from skyledger.operators.cleaning import HIGH_VALUE
from skyledger.operators.dimensions import distinct_dimension, extend_dimension, split_entity
from skyledger.operators.lookups import lookup_join
from skyledger.operators.shared import Settled, settle, together


def with_calendar(days: DataFrame) -> DataFrame:
    return days.select(*(part.alias(name) for name, part in calendar_parts(F.col("date")).items()))


def dim_date(spark: SparkSession, first: str, last: str) -> DataFrame:
    return with_calendar(day_series(spark, first, last))


def dim_date_of(df: DataFrame, column: str) -> DataFrame:
    """Calendar from the first to the last day that occurs in a date column."""
    return with_calendar(days_of(df.select(F.col(column).cast("date").alias(column)), column))


def dim_city(deliveries: DataFrame) -> Settled:
    return distinct_dimension(deliveries, "city", "city_key", "city_name")


def dim_status(deliveries: DataFrame) -> Settled:
    return distinct_dimension(deliveries, "status", "status_key", "status_name")


def fact_orders(
    deliveries: DataFrame,
    dates: DataFrame | Settled,
    cities: DataFrame | Settled,
    statuses: DataFrame | Settled,
    threshold: float = HIGH_VALUE,
    **limits: int,
) -> DataFrame:
    """Key lookups for every delivery that has an amount text, numeric or not."""
    rows = deliveries.where(F.col("amount").isNotNull()).select(
        F.col("id").alias("order_key"),
        F.col("order_date").cast("date").alias("date"),
        F.col("city").alias("city_name"),
        F.col("status").alias("status_name"),
        number(deliveries, "amount").alias("amount"),
    )
    keyed = lookup_join(rows, _only(dates, "date", "date_key"), ["date"], **limits)
    keyed = lookup_join(keyed, _only(cities, "city_name", "city_key"), ["city_name"], **limits)
    keyed = lookup_join(
        keyed, _only(statuses, "status_name", "status_key"), ["status_name"], **limits
    )
    return keyed.select(
        "order_key",
        "date_key",
        "city_key",
        "status_key",
        "amount",
        above("amount", threshold).alias("is_high_value"),
    )


def _only(table: DataFrame | Settled, *columns: str) -> DataFrame | Settled:
    if isinstance(table, Settled):
        return replace(table, frame=table.frame.select(*columns))
    return table.select(*columns)


@dataclass(frozen=True)
class Star:
    """Facts and the dimensions they point to; dimensions are settled once and reused."""

    facts: DataFrame
    dates: Settled
    cities: Settled
    statuses: Settled


def build_star(
    deliveries: DataFrame,
    known_cities: DataFrame | None = None,
    known_statuses: DataFrame | None = None,
    **limits: int,
) -> Star:
    """All dimensions come from one pass over the deliveries, the facts from a second one.

    Dimensions of an earlier load may be given; their keys are then kept and new ones added.
    """
    day = F.col("order_date").cast("date")
    found = settle(
        deliveries.groupBy("city", "status").agg(F.min(day).alias("first"), F.max(day).alias("last")),
        "star_values",
    ).frame
    bounds = found.agg(F.min("first").alias("first"), F.max("last").alias("last"))
    days = days_between(bounds, F.col("first"), F.col("last"))
    dates, cities, statuses = together(
        deliveries.sparkSession,
        lambda: settle(with_calendar(days), "dim_date"),
        lambda: _dimension(found, "city", "city_key", "city_name", known_cities),
        lambda: _dimension(found, "status", "status_key", "status_name", known_statuses),
    )
    return Star(
        fact_orders(deliveries, dates, cities, statuses, **limits), dates, cities, statuses
    )


def _dimension(
    found: DataFrame, column: str, key: str, name: str, known: DataFrame | None
) -> Settled:
    if known is None:
        return distinct_dimension(found, column, key, name)
    return settle(extend_dimension(known, found, column, key, name), key)


def _with_city_and_status(star: Star, **limits: int) -> DataFrame:
    joined = lookup_join(star.facts, star.cities, ["city_key"], **limits)
    return lookup_join(joined, star.statuses, ["status_key"], **limits)


def star_weekday(star: Star, **limits: int) -> DataFrame:
    """Totals by city and status on weekdays; orders outside the calendar drop out."""
    flags = _only(star.dates, "date_key", "is_weekend")
    joined = lookup_join(_with_city_and_status(star, **limits), flags, ["date_key"], **limits)
    return (
        joined.where(~F.col("is_weekend"))
        .groupBy(F.col("city_name").alias("city"), F.col("status_name").alias("status"))
        .agg(
            exact_sum("amount").alias("total_amount"),
            round_sql(exact_avg("amount"), 2).alias("avg_amount"),
            F.count(F.lit(1)).alias("order_count"),
        )
        .orderBy(F.asc_nulls_last("city"), F.asc_nulls_last("status"))
    )


def wide_orders(star: Star, **limits: int) -> DataFrame:
    days = _only(star.dates, "date_key", "day_of_week", "month_name", "is_weekend")
    joined = lookup_join(_with_city_and_status(star, **limits), days, ["date_key"], **limits)
    return joined.select(
        "order_key",
        "amount",
        "is_high_value",
        "city_name",
        "day_of_week",
        "month_name",
        "is_weekend",
        "status_name",
    )


def _delivered_total(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("status_name") == "delivered")
        .groupBy("city_name")
        .agg(exact_sum("amount").alias("total_amount"))
        .orderBy(F.desc_nulls_last("total_amount"))
    )


def delivered_normalized(star: Star, **limits: int) -> DataFrame:
    """From the star. The calendar adds nothing to this question and is left out."""
    return _delivered_total(_with_city_and_status(star, **limits))


def delivered_wide(wide: DataFrame) -> DataFrame:
    return _delivered_total(wide)


CUSTOMER = {"customer_name": "name", "customer_email": "email"}
PRODUCT = {"product_name": "name", "product_category": "category", "product_price": "unit_price"}
PLACE = {"customer_city": "city_name", "customer_region": "region"}
# Columns that must depend on one other column alone for the split to lose nothing.
DEPENDENCIES = (
    ("customer_name", "customer_email"),
    ("customer_city", "customer_region"),
    ("order_id", "customer_name"),
    ("order_id", "order_date"),
    ("product_name", "product_category"),
)


def dim_customers(wide: DataFrame) -> Settled:
    return split_entity(wide, CUSTOMER, "customer_id")


def dim_products(wide: DataFrame) -> Settled:
    return split_entity(wide, PRODUCT, "product_id")


def dim_cities(wide: DataFrame) -> Settled:
    return split_entity(wide, PLACE, "city_id")


def all_entities(wide: DataFrame) -> tuple[Settled, Settled, Settled]:
    """Customers, products and cities of a stored wide table."""
    customers, products, cities = together(
        wide.sparkSession,
        lambda: dim_customers(wide),
        lambda: dim_products(wide),
        lambda: dim_cities(wide),
    )
    return customers, products, cities


def order_lines(
    wide: DataFrame, customers: Settled, products: Settled, cities: Settled, **limits: int
) -> DataFrame:
    """What is left of the wide table once customers, products and cities are keys."""
    rows = wide
    for entity, table in ((CUSTOMER, customers), (PRODUCT, products), (PLACE, cities)):
        back = {new: old for old, new in entity.items()}
        renamed = replace(table, frame=table.frame.withColumnsRenamed(back))
        rows = lookup_join(rows, renamed, list(entity), null_safe=True, **limits).drop(*entity)
    return rows.select("order_id", "customer_id", "product_id", "city_id", "quantity", "order_date")
