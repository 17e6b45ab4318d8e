"""Whole jobs: files or tables in, tables or files out.

Only these functions, the writers and the gates start Spark jobs on purpose; everything else
stays lazy, apart from the lookups that must be settled before their join is chosen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators.cleaning import (
    ORDER_KEYS,
    clean_orders,
    clean_orders_sql,
    label_valid,
    resolve_cities,
    split_processed,
    unknown_cities,
)
from skyledger.operators.lookups import lookup_join
from skyledger.operators.merging import put
from skyledger.operators.quality import require_fields, require_rows
from skyledger.operators.shared import settle, together
from skyledger.plans import marts, staging, star
from skyledger.plans.weather import aggregate_weather, weather_summary
from skyledger.sources import files, payloads
from skyledger.sources.registry import WAREHOUSE, bucketed, source, table_path
from skyledger.sources.writers import (
    read_table,
    replace_table,
    upsert_table,
    write_csv,
    write_split,
)


def orders_with_weather(orders: DataFrame, readings: DataFrame) -> DataFrame:
    return marts.enrich_orders(clean_orders(orders), aggregate_weather(readings, ordered=False))


def analyse_files(
    spark: SparkSession, orders_csv: str, readings_json: str, out_csv: str, lines: bool = True
) -> DataFrame:
    """Orders file and readings file to one enriched CSV folder."""
    columns = schemas.ORDERS_RAW.fieldNames()
    orders = files.read_csv_text(spark, orders_csv, columns, files.MISSING_TEXTS)
    readings = files.read_json(spark, readings_json, schemas.READINGS, lines)
    enriched = orders_with_weather(orders, readings)
    write_csv(enriched, out_csv)
    return enriched


def summarise_readings(
    spark: SparkSession, readings_json: str, out_csv: str, lines: bool = True
) -> None:
    """Readings file to a CSV folder with one row per city."""
    readings = files.read_json(spark, readings_json, schemas.READINGS, lines)
    write_csv(aggregate_weather(require_rows(readings, "weather readings")), out_csv)


def load_orders(orders: DataFrame, root: str) -> int:
    cleaned = clean_orders_sql(orders).withColumn("id", F.col("id").cast("bigint"))
    batch = cleaned.select(*schemas.ORDERS.fieldNames())
    return bucketed(root, "orders").upsert(batch)


def load_weather(readings: DataFrame, root: str) -> int:
    batch = weather_summary(readings)
    path = table_path(root, "weather_summary")
    return upsert_table(batch, path, schemas.WEATHER_SUMMARY, "city")


def enriched_by_id(orders: DataFrame, summary: DataFrame, **limits: int) -> DataFrame:
    joined = marts.enrich_orders(orders, summary, null_safe=False, **limits)
    return joined.orderBy(F.asc_nulls_last("id"))


def warehouse_enriched(spark: SparkSession, root: str) -> DataFrame:
    """Stored orders with the stored weather of their city, in order of id."""
    return enriched_by_id(
        source(spark, root, "warehouse", "orders"),
        source(spark, root, "warehouse", "weather_summary"),
    )


def _store(
    spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, str]]
) -> dict[str, int]:
    """Replace tables that do not depend on each other, each with its key; rows per table."""
    writes = [
        partial(replace_table, frame, table_path(root, name), key=(key,))
        for name, (frame, key) in tables.items()
    ]
    return dict(zip(tables, together(spark, *writes)))


def _earlier(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, table_path(root, name), WAREHOUSE[name], absent_as_empty=True)


def load_star(deliveries: DataFrame, root: str) -> star.Star:
    """Add deliveries to the four tables of the star, and return it on top of what is stored.

    Facts are put in place by order, in the buckets of the batch, and days by date, so those of
    earlier loads stay. So do city and status keys.
    """
    spark = deliveries.sparkSession
    built = star.build_star(
        deliveries, _earlier(spark, root, "dim_city"), _earlier(spark, root, "dim_status")
    )
    days = settle(put(_earlier(spark, root, "dim_date"), built.dates, "date_key"), "dim_date")
    tables = {
        "dim_date": (days.frame, "date_key"),
        "dim_city": (built.cities.frame, "city_key"),
        "dim_status": (built.statuses.frame, "status_key"),
    }
    # Facts come last: a load that fails leaves dimensions with more rows, and no fact without one.
    _store(spark, root, tables)
    facts = bucketed(root, "fact_orders")
    facts.upsert(built.facts)
    return star.Star(facts.read(spark), days, built.cities, built.statuses)


def load_entities(wide: DataFrame, root: str) -> dict[str, int]:
    """Write customers, products and cities; returns the rows of each table."""
    customers, products, cities = star.all_entities(settle(wide, "wide_orders").frame)
    built = {
        "dim_customers": (customers.frame, "customer_id"),
        "dim_products": (products.frame, "product_id"),
        "dim_cities": (cities.frame, "city_id"),
    }
    return _store(wide.sparkSession, root, built)


def split_orders_file(
    spark: SparkSession,
    orders_csv: str,
    out: str,
    required: Sequence[str] = ORDER_KEYS,
    skip_null_amount: bool = True,
) -> dict[str, int]:
    """Valid and failed rows of an orders file into two sub-folders, with their counts."""
    orders = files.read_csv_text(spark, orders_csv, schemas.ORDERS_RAW.fieldNames())
    return write_split(label_valid(orders, required, skip_null_amount), "is_valid", out)


def process_orders_file(
    spark: SparkSession, orders_json: str, out: str, lines: bool = False
) -> dict[str, int]:
    """Strict JSON orders to sub-folders of processed and rejected records, with their counts.

    Each record is read and judged once. Keys beside the order's own go along in `other_keys`.
    """
    orders = files.read_json_records(spark, orders_json, schemas.ORDERS_JSON, ORDER_KEYS, lines)
    return write_split(split_processed(orders, missing_keys="missing_keys"), "is_valid", out)


@dataclass(frozen=True)
class Report:
    """Requests for unknown cities, and asked-for cities whose payload could not be read."""

    unknown: DataFrame
    failed: DataFrame


def weather_report(
    spark: SparkSession,
    requested: DataFrame,
    registry: DataFrame,
    payload_path: str,
    out_csv: str,
) -> Report:
    """Summary of the requested cities from landed payloads, and what it could not cover."""
    known = settle(registry, "registry")
    cities = settle(
        resolve_cities(requested, known).select(F.col("name").alias("city")).distinct(), "cities"
    )
    landed = payloads.read_payloads(spark, payload_path)
    readings = payloads.flatten_payloads(landed).withColumn("city", F.lower("city"))
    chosen = require_rows(lookup_join(readings, cities, ["city"], "inner"), "chosen readings")
    write_csv(aggregate_weather(chosen), out_csv)
    broken = payloads.failed_cities(landed).select(F.lower("city").alias("city")).distinct()
    return Report(unknown_cities(requested, known), cities.frame.join(broken, "city", "left_semi"))


@dataclass(frozen=True)
class Marts:
    """Rows written per table by a batch."""

    rows: dict[str, int]


def weather_batch(
    readings: DataFrame, deliveries: DataFrame, raw_orders: DataFrame, root: str
) -> Marts:
    """Check and refresh the readings, then build every model that hangs on them.

    The city weather is derived from the readings of this batch, so marts never lag behind.
    """
    spark = readings.sparkSession
    require_rows(readings, "weather readings")
    rows = {"weather_raw": replace_table(readings, table_path(root, "weather_raw"))}
    stored = read_table(spark, table_path(root, "weather_raw"), WAREHOUSE["weather_raw"])
    weather = settle(staging.stg_weather(weather_summary(stored)), "stg_weather")
    enriched = marts.int_orders_enriched(staging.stg_deliveries(deliveries), weather)
    orders = staging.stg_orders(raw_orders)
    models = {
        "weather_summary": weather.frame,
        "mart_city_summary": marts.mart_city_summary(enriched, ordered=False),
        "mart_city_orders": marts.mart_city_orders(orders, ordered=False),
        "mart_restaurant_summary": marts.mart_restaurant_summary(
            marts.int_orders_by_restaurant(orders), ordered=False
        ),
    }
    writes = [partial(replace_table, df, table_path(root, name)) for name, df in models.items()]
    return Marts({**rows, **dict(zip(models, together(spark, *writes)))})


def restaurant_batch(
    orders: DataFrame, root: str, fill: Mapping[str, object] | None = None
) -> Marts:
    """Check and refresh the restaurant orders, then build their daily mart.

    An order without a required field refuses the batch, unless `fill` says what stands for it.
    """
    require_rows(orders, "restaurant orders")
    orders = orders.fillna(dict(fill)) if fill else orders
    require_fields(orders, ["order_id", "restaurant_name", "amount"], "order_id")
    path = table_path(root, "restaurant_orders_raw")
    rows = {"restaurant_orders_raw": replace_table(orders, path)}
    stored = read_table(orders.sparkSession, path, schemas.RESTAURANT_ORDERS)
    daily = marts.mart_restaurant_daily(staging.stg_restaurant_orders(stored))
    rows["mart_restaurant_daily"] = replace_table(
        daily, table_path(root, "mart_restaurant_daily")
    )
    return Marts(rows)
