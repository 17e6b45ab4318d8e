"""Registered queries, each with the SQL an independent engine runs beside it.

Names ending in `_large_lookup` or `_sliced` run the same question through the path that is taken
when a lookup or an input is too large for the simple plan; the limits are set low to force it.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from job_queries import JOBS
from oracles import ORACLES
from skyledger import schemas
from skyledger.functions.numbers import price
from skyledger.functions.text import blank_to_null, slug
from skyledger.operators import cleaning, dimensions, merging
from skyledger.operators.profile import column_profiles
from skyledger.operators.quality import settle_checked
from skyledger.operators.shared import scratch_path, settle
from skyledger.plans import analytics, jobs, marts, staging, star, suite
from skyledger.plans.weather import aggregate_weather, weather_summary
from skyledger.sources import files, messy, payloads
from skyledger.sources.writers import write_csv, write_json

Query = Callable[[SparkSession, str], DataFrame]
SMALL_LIMITS = {"broadcast_rows": 0, "hot_rows": 100}


def over(statement: str, job: Callable[..., DataFrame], **options: object) -> Query:
    """A job over one view of the given tables."""
    return lambda spark, sf_dir: job(messy.view(spark, sf_dir, statement), **options)


def _enriched(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    deliveries = staging.stg_deliveries(messy.view(spark, sf_dir, messy.DELIVERIES))
    weather = staging.stg_weather(weather_summary(messy.view(spark, sf_dir, messy.WEATHER)))
    return marts.int_orders_enriched(deliveries, weather, **limits)


def city_summary(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    return marts.mart_city_summary(_enriched(spark, sf_dir, **limits))


def orders_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.orders_with_weather(
        messy.view(spark, sf_dir, messy.DELIVERIES), messy.view(spark, sf_dir, messy.WEATHER)
    )


def warehouse_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = cleaning.clean_orders_sql(messy.view(spark, sf_dir, messy.DELIVERIES))
    return jobs.enriched_by_id(orders, weather_summary(messy.view(spark, sf_dir, messy.WEATHER)))


def by_restaurant(raw_orders: DataFrame) -> DataFrame:
    return marts.int_orders_by_restaurant(staging.stg_orders(raw_orders))


def _star(spark: SparkSession, sf_dir: str, **limits: int) -> star.Star:
    return star.build_star(messy.view(spark, sf_dir, messy.DELIVERIES_TIDY), **limits)


def dim_city_extended(deliveries: DataFrame) -> DataFrame:
    """A first load numbers the cities of one month; the next load adds the rest."""
    first = star.dim_city(deliveries.where(F.col("order_date") < "1995-02-01")).frame
    return dimensions.extend_dimension(first, deliveries, "city", "city_key", "city_name")


def order_lines(wide: DataFrame) -> DataFrame:
    stored = settle(wide, "wide_orders").frame  # read four times below
    return star.order_lines(stored, *star.all_entities(stored))


def dependency_report(wide: DataFrame) -> DataFrame:
    stored = settle(wide, "wide_orders").frame  # read once per rule
    return dimensions.dependency_report(stored, star.DEPENDENCIES)


def dim_customers_sliced(wide: DataFrame) -> DataFrame:
    return dimensions.split_entity(wide, star.CUSTOMER, "customer_id", window_rows=0).frame


def price_parse(texts: DataFrame) -> DataFrame:
    return texts.select("origin", "id", price(texts, "value").alias("price"))


def slugs(texts: DataFrame) -> DataFrame:
    return texts.select("origin", "id", slug("value").alias("slug"))


def valid_failed_split(deliveries: DataFrame) -> DataFrame:
    """As read from CSV, where a blank cell is a missing one."""
    read = deliveries.withColumns(
        {c: blank_to_null(c) for c in ("city", "status", "amount", "order_date")}
    )
    labelled = cleaning.label_valid(read, cleaning.ORDER_KEYS)
    return labelled.select("id", F.col("city").isNotNull().alias("has_city"), "is_valid")


def valid_without_status(deliveries: DataFrame) -> DataFrame:
    """A required column that is not there is missing on every row."""
    return cleaning.label_valid(deliveries.drop("status")).select("id", "is_valid")


def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = messy.table(spark, sf_dir, "part")
    names = cleaning.normalize_list(F.split("p_name", " "), lambda x: slug(F.upper(x)))
    return parts.select(F.col("p_partkey").alias("id"), F.array_join(names, "|").alias("names"))


def city_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = messy.view(spark, sf_dir, messy.REQUESTS)
    return cleaning.resolve_cities(requests, messy.view(spark, sf_dir, messy.CITY_REGISTRY))


def city_registry_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = messy.view(spark, sf_dir, messy.REQUESTS)
    return cleaning.unknown_cities(requests, messy.view(spark, sf_dir, messy.CITY_REGISTRY))


def payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.flatten_payloads(messy.payloads(spark, sf_dir))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged tables and marts are written once; that write counts the row checks.

    Only keys are read again, for uniqueness.
    """
    checks = suite.suite()
    staged = settle_checked(
        checks,
        stg_deliveries=staging.stg_deliveries(messy.view(spark, sf_dir, messy.DELIVERIES)),
        stg_weather=staging.stg_weather(weather_summary(messy.view(spark, sf_dir, messy.WEATHER))),
        stg_orders=staging.stg_orders(messy.view(spark, sf_dir, messy.RAW_ORDERS)),
        stg_restaurant_orders=staging.stg_restaurant_orders(
            messy.view(spark, sf_dir, messy.RESTAURANT_ORDERS)
        ),
    )
    stored = {name: checked.table for name, checked in staged.items()}
    enriched = marts.int_orders_enriched(stored["stg_deliveries"].frame, stored["stg_weather"])
    by_restaurant_name = marts.int_orders_by_restaurant(stored["stg_orders"].frame)
    built = settle_checked(
        checks,
        mart_city_summary=marts.mart_city_summary(enriched, ordered=False),
        mart_restaurant_summary=marts.mart_restaurant_summary(by_restaurant_name, ordered=False),
        mart_restaurant_daily=marts.mart_restaurant_daily(stored["stg_restaurant_orders"].frame),
    )
    return suite.report({**staged, **built})


def upsert(deliveries: DataFrame) -> DataFrame:
    """Orders before 2000 are loaded; a batch then restates those from 1999 on.

    The batch holds some orders twice, and the later row of an order counts.
    """
    loaded = cleaning.clean_orders_sql(deliveries.where(F.col("order_date") < "2000-01-01"))
    recent = cleaning.clean_orders_sql(deliveries.where(F.col("order_date") >= "1999-01-01"))
    # A high-value order arrives as open and then as settled, any other one only as open.
    states = F.when(F.col("is_high_value"), F.array(F.lit("open"), F.lit("settled"))).otherwise(
        F.array(F.lit("open"))
    )
    batch = recent.select("*", F.posexplode(states).alias("load", "state"))
    batch = batch.withColumn("status", F.col("state")).drop("state")
    columns = schemas.ORDERS.fieldNames()
    return merging.upsert(loaded.select(*columns), batch, "id", F.col("load"))


def history(deliveries: DataFrame) -> DataFrame:
    """Three looks at the deliveries: some not there yet, some changed, some gone."""
    checked = ["status", "amount"]
    late = F.when(F.col("order_date") >= "2000-07-01", "delivered").otherwise(F.col("status"))
    second = deliveries.withColumn("status", late)
    third = second.where(F.col("order_date") >= "1996-01-01").withColumn(
        "amount", F.coalesce("amount", F.lit("0.00"))
    )
    first = merging.open_history(deliveries.where(F.col("order_date") < "2001-01-01"), 1)
    # A snapshot reads the history twice, once for closed and once for open versions.
    stored = settle(merging.snapshot(first, second, "id", checked, 2), "history").frame
    return merging.snapshot(stored, third, "id", checked, 3)


def file_round_trip(deliveries: DataFrame) -> DataFrame:
    spark = deliveries.sparkSession
    csv_path, json_path = scratch_path(spark, "csv"), scratch_path(spark, "json")
    write_csv(deliveries, csv_path)
    write_json(deliveries, json_path)
    from_csv = files.read_csv_text(spark, csv_path, deliveries.columns)
    from_json = files.read_json(spark, json_path, schemas.DELIVERIES)
    return (
        from_csv.withColumn("id", F.col("id").cast("bigint"))
        .withColumn("format", F.lit("csv"))
        .unionByName(from_json.withColumn("format", F.lit("json")))
    )


def _typed(job: Callable[..., DataFrame], **options: object) -> Query:
    return over(messy.DELIVERIES_TYPED, job, **options)


def _stored(job: Callable[..., DataFrame], **options: object) -> Query:
    """The typed deliveries as a stored table, for jobs that read them twice."""
    return lambda spark, sf_dir: job(
        settle(messy.view(spark, sf_dir, messy.DELIVERIES_TYPED), "deliveries").frame, **options
    )


def _tidy(job: Callable[..., DataFrame], **options: object) -> Query:
    return over(messy.DELIVERIES_TIDY, job, **options)


QUERIES: dict[str, Query] = {
    "city_summary": city_summary,
    "city_summary_large_lookup": lambda s, d: city_summary(s, d, **SMALL_LIMITS),
    "stg_deliveries": over(messy.DELIVERIES, staging.stg_deliveries),
    "stg_weather_readings": over(messy.WEATHER, staging.stg_weather_raw),
    "stg_orders": over(messy.RAW_ORDERS, staging.stg_orders),
    "stg_restaurant_orders": over(messy.RESTAURANT_ORDERS, staging.stg_restaurant_orders),
    "weather_summary_sql": over(
        messy.WEATHER, lambda readings: staging.stg_weather(weather_summary(readings))
    ),
    "weather_summary_nonnull": over(messy.WEATHER, aggregate_weather),
    "orders_enriched": orders_enriched,
    "int_orders_enriched": _enriched,
    "warehouse_enriched": warehouse_enriched,
    "restaurant_totals": over(messy.RAW_ORDERS, by_restaurant),
    "restaurant_summary": over(
        messy.RAW_ORDERS, lambda raw: marts.mart_restaurant_summary(by_restaurant(raw))
    ),
    "restaurant_daily": over(
        messy.RESTAURANT_ORDERS,
        lambda raw: marts.mart_restaurant_daily(staging.stg_restaurant_orders(raw)),
    ),
    "city_orders": over(
        messy.RAW_ORDERS, lambda raw: marts.mart_city_orders(staging.stg_orders(raw))
    ),
    "rank_in_city": _typed(analytics.rank_in_city),
    "rank_in_city_sliced": _typed(analytics.rank_in_city, window_rows=0),
    "running_total": _stored(analytics.running_total),
    "running_total_large_lookup": _stored(analytics.running_total, **SMALL_LIMITS),
    "vs_city_average": _stored(analytics.vs_city_average),
    "vs_city_average_large_lookup": _stored(analytics.vs_city_average, **SMALL_LIMITS),
    "day_change": _typed(analytics.day_change),
    "day_change_sliced": _typed(analytics.day_change, window_rows=0),
    "top_order": _stored(analytics.top_order),
    "delivered_revenue": _typed(analytics.delivered_revenue),
    "top_vs_average": _stored(analytics.top_vs_average),
    "daily_totals": _typed(analytics.daily_totals),
    "above_city_average": _stored(analytics.above_city_average),
    "above_city_average_correlated": _stored(analytics.above_city_average_rows),
    "dim_date": _tidy(lambda deliveries: star.dim_date_of(deliveries, "order_date")),
    "dim_city": _tidy(lambda rows: star.dim_city(rows).frame),
    "dim_status": _tidy(lambda rows: star.dim_status(rows).frame),
    "dim_city_extended": over(messy.DELIVERIES, dim_city_extended),
    "fact_orders": lambda s, d: _star(s, d).facts,
    "fact_orders_large_lookup": lambda s, d: _star(s, d, **SMALL_LIMITS).facts,
    "star_weekday": lambda s, d: star.star_weekday(_star(s, d)),
    "wide_orders": lambda s, d: star.wide_orders(_star(s, d)),
    "delivered_normalized": lambda s, d: star.delivered_normalized(_star(s, d)),
    "delivered_wide": lambda s, d: star.delivered_wide(star.wide_orders(_star(s, d))),
    "dim_customers": over(messy.WIDE_ORDERS, lambda wide: star.dim_customers(wide).frame),
    "dim_customers_sliced": over(messy.WIDE_ORDERS, dim_customers_sliced),
    "dim_products": over(messy.WIDE_ORDERS, lambda wide: star.dim_products(wide).frame),
    "dim_cities": over(messy.WIDE_ORDERS, lambda wide: star.dim_cities(wide).frame),
    "order_lines": over(messy.WIDE_ORDERS, order_lines),
    "dependency_report": over(messy.WIDE_ORDERS, dependency_report),
    "price_parse": over(messy.TEXTS, price_parse),
    "slug": over(messy.TEXTS, slugs),
    "process_orders": over(messy.DELIVERIES, cleaning.process_orders),
    "rejected_orders": over(messy.DELIVERIES, cleaning.rejected_orders),
    "valid_failed_split": over(messy.DELIVERIES, valid_failed_split),
    "valid_without_status": over(messy.DELIVERIES, valid_without_status),
    "normalized_names": normalized_names,
    "column_profile": over(
        messy.DELIVERIES, column_profiles, columns=["id", "city", "status", "amount", "order_date"], position="id"
    ),
    "city_registry": city_registry,
    "city_registry_unknown": city_registry_unknown,
    "payload_flatten": payload_flatten,
    "quality_report": quality_report,
    "upsert": over(messy.DELIVERIES, upsert),
    "history": _tidy(history),
    "file_round_trip": over(messy.DELIVERIES, file_round_trip),
    **JOBS,
}


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the text-preparation subpackage; none where it was taken out."""
    try:
        from corpus_pipeline import ORACLE_SQL, pipeline
        from skyledger.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "skyledger.llm", "skyledger.llm.queries"):
            raise
        return {}, {}
    sql = ORACLES if ORACLE_SQL is None else {**ORACLES, "pipeline": ORACLE_SQL}
    return {**QUERIES, "pipeline": pipeline}, dict(sql)


def entry(spark: SparkSession) -> DataFrame:
    """City summary of messy deliveries and weather readings."""
    return city_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **_llm()[1]}
