"""Registered queries that run a whole job through files or stored tables and read its result.

Inputs are written from the given tables into the shared folder, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.sums import exact_sum_by
from skyledger.operators.quality import DataCheckError, require_fields, require_key, require_rows
from skyledger.operators.shared import scratch_path, settle
from skyledger.plans import incremental, jobs, marts, staging
from skyledger.plans.weather import weather_summary
from skyledger.sources import files, messy
from skyledger.sources.history import HistoryTable
from skyledger.sources.registry import WAREHOUSE, source, table_path
from skyledger.sources.writers import read_table, write_csv, write_json
from skyledger.streaming.landing import load_landed, report_failed

ENRICHED = schemas.schema(
    id=schemas.LONG, city=schemas.TEXT, amount=schemas.DOUBLE, status=schemas.TEXT,
    is_high_value=schemas.FLAG, avg_temp=schemas.DOUBLE, max_temp=schemas.DOUBLE,
    min_temp=schemas.DOUBLE, record_count=schemas.LONG,
)
BROKEN_CITY = "nation_3"


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with one more column, and the columns in an order of their own."""
    rows = messy.view(spark, sf_dir, messy.DELIVERIES)
    courier = F.concat(F.lit("rider "), (F.col("id") % 7).cast("string"))
    return rows.select("order_date", "amount", courier.alias("courier"), "status", "id", "city")


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders_csv")
    write_csv(_deliveries(spark, sf_dir), path)
    return path


def _payload_files(spark: SparkSession, sf_dir: str) -> str:
    """Landed payloads; those of one city lack their temperatures."""
    path = scratch_path(spark, "payloads")
    temperatures = F.when(F.col("city") != BROKEN_CITY, F.col("hourly.temperature_2m"))
    hourly = F.struct(F.col("hourly.time").alias("time"), temperatures.alias("temperature_2m"))
    write_json(messy.payloads(spark, sf_dir).withColumn("hourly", hourly), path)
    return path


def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "split")
    jobs.split_orders_file(spark, _orders_csv(spark, sf_dir), out)
    schema = (
        "id string, city string, amount string, status string, order_date string, courier string, "
        "is_valid boolean"
    )
    return spark.read.schema(schema).json(out).drop("rows")


def typed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed reader on files of two orders of columns, one of them without the courier."""
    path = scratch_path(spark, "typed_csv")
    rows = _deliveries(spark, sf_dir).withColumn("amount", F.col("amount").try_cast("double"))
    write_csv(rows.where("id % 2 = 0"), f"{path}/part=even")
    write_csv(rows.where("id % 2 = 1").select("city", "id", "amount", "status", "order_date"), f"{path}/part=odd")
    declared = schemas.schema(id=schemas.LONG, amount=schemas.DOUBLE, order_date=schemas.DATE)
    return files.read_csv(spark, f"{path}/*", declared, mixed_headers=True)


def process_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records leave out fields without a value, so some lack a required key."""
    records = scratch_path(spark, "records")
    _deliveries(spark, sf_dir).write.json(records, ignoreNullFields=True)
    return _judged(spark, records, lines=True)


def process_order_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in a few files of one array each."""
    records = scratch_path(spark, "arrays")
    rows = _deliveries(spark, sf_dir).withColumn("file", F.col("id") % 4)
    in_file = Window.partitionBy("file").orderBy("id")
    json = F.to_json(F.struct(*(c for c in rows.columns if c != "file")), {"ignoreNullFields": "true"})
    first = F.when(F.lag("id").over(in_file).isNull(), "[").otherwise(",")
    last = F.when(F.lead("id").over(in_file).isNull(), "]").otherwise("")
    text = rows.select("file", F.concat(first, json, last).alias("value"))
    text.write.partitionBy("file").text(records)
    return _judged(spark, records, lines=False)


def _judged(spark: SparkSession, records: str, lines: bool) -> DataFrame:
    out = scratch_path(spark, "judged")
    jobs.process_orders_file(spark, records, out, lines=lines)
    schema = (
        "id string, city string, amount double, status string, raw_amount string, reason string, "
        "other_keys map<string, string>, is_valid boolean"
    )
    judged = spark.read.schema(schema).json(out).drop("rows")
    others = [F.col("other_keys")[k].alias(k) for k in ("order_date", "courier")]
    return judged.select(*[c for c in judged.columns if c != "other_keys"], *others)


def analysis_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings, out = scratch_path(spark, "readings"), scratch_path(spark, "enriched")
    write_json(messy.view(spark, sf_dir, messy.WEATHER), readings)
    jobs.analyse_files(spark, _orders_csv(spark, sf_dir), readings, out)
    return files.read_csv(spark, out, ENRICHED)


def weather_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cities that were asked for: summarised, with a broken payload, or unknown."""
    out = scratch_path(spark, "report")
    requests = messy.view(spark, sf_dir, messy.REQUESTS)
    registry = messy.view(spark, sf_dir, messy.CITY_REGISTRY)
    report = jobs.weather_report(spark, requests, registry, _payload_files(spark, sf_dir), out)
    summary = files.read_csv(spark, out, schemas.WEATHER_SUMMARY)
    unknown = report.unknown.groupBy("city").agg(F.count(F.lit(1)).alias("record_count"))
    parts = {"summary": summary, "failed": report.failed, "unknown": unknown}
    found = [df.withColumn("part", F.lit(part)) for part, df in parts.items()]
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def landed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    load_landed(spark, _payload_files(spark, sf_dir), out, checkpoint).awaitTermination()
    return spark.read.schema(schemas.READINGS).parquet(out)


def landed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "failed"), scratch_path(spark, "stream")
    report_failed(spark, _payload_files(spark, sf_dir), out, checkpoint).awaitTermination()
    failed = spark.read.schema("city string, file string").parquet(out)
    return failed.groupBy("city").agg(F.count(F.lit(1)).alias("payloads"))


def stored_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early orders are loaded, then all of them; the second load replaces rows of the first."""
    root = scratch_path(spark, "warehouse")
    deliveries = messy.view(spark, sf_dir, messy.DELIVERIES)
    early = deliveries.where(F.col("order_date") < "1998-01-01")
    jobs.load_orders(early.withColumn("status", F.lit("early")), root)
    jobs.load_orders(deliveries, root)
    jobs.load_weather(messy.view(spark, sf_dir, messy.WEATHER), root)
    return jobs.warehouse_enriched(spark, root)


def stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of a second load, with the names behind their keys.

    The first load knows few cities; their keys stay, so later cities get higher ones.
    """
    root = scratch_path(spark, "star")
    deliveries = messy.view(spark, sf_dir, messy.DELIVERIES_TIDY)
    jobs.load_star(deliveries.where(F.col("order_date") < "1995-01-15"), root)
    jobs.load_star(deliveries, root)
    return _named_facts(spark, root).drop("status_key")


def _named_facts(spark: SparkSession, root: str) -> DataFrame:
    facts = source(spark, root, "warehouse", "fact_orders")
    for key, table in (("city_key", "dim_city"), ("status_key", "dim_status")):
        facts = facts.join(source(spark, root, "warehouse", table), key, "left")
    return facts


def _two_batches(spark: SparkSession, sf_dir: str) -> str:
    """Deliveries in two loads that share a month; the first has other amounts in it."""
    root = scratch_path(spark, "star_batches")
    deliveries = messy.view(spark, sf_dir, messy.DELIVERIES_TIDY)
    early = deliveries.where(F.col("order_date") < "1997-07-01")
    restated = F.when(F.col("order_date") >= "1997-06-01", F.lit("1.00")).otherwise(F.col("amount"))
    jobs.load_star(early.withColumn("amount", F.when(F.col("amount").isNotNull(), restated)), root)
    jobs.load_star(deliveries.where(F.col("order_date") >= "1997-06-01"), root)
    return root


def stored_star_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of both loads, by name and day."""
    root = _two_batches(spark, sf_dir)
    days = source(spark, root, "warehouse", "dim_date").select("date_key", "date", "day_of_week")
    facts = _named_facts(spark, root).join(days, "date_key", "left")
    return facts.drop("city_key", "status_key", "date_key")


def stored_star_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar after both loads."""
    return source(spark, _two_batches(spark, sf_dir), "warehouse", "dim_date")


def weather_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "weather_batch")
    views = (messy.WEATHER, messy.DELIVERIES, messy.RAW_ORDERS)
    jobs.weather_batch(*(messy.view(spark, sf_dir, v) for v in views), root)
    return read_table(spark, table_path(root, "mart_city_summary"), schemas.MART_CITY_SUMMARY)


def _refusal(check: Callable[[], object]) -> str | None:
    try:
        check()
    except DataCheckError as refused:
        return str(refused)
    return None


def restaurant_batch_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are offered and refused, as some lack an amount; then 0 is to stand for it."""
    root = scratch_path(spark, "restaurant_batch")
    orders = messy.view(spark, sf_dir, messy.RESTAURANT_ORDERS)
    said = _refusal(lambda: jobs.restaurant_batch(orders, root))
    jobs.restaurant_batch(orders, root, fill={"amount": 0.0})
    path = table_path(root, "mart_restaurant_daily")
    daily = read_table(spark, path, schemas.MART_RESTAURANT_DAILY)
    refusal = spark.createDataFrame([(said,)], "refusal string")
    return daily.unionByName(refusal, allowMissingColumns=True)


def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each gate says to an input that breaks its rule."""
    orders = messy.view(spark, sf_dir, messy.RESTAURANT_ORDERS)
    twice = orders.select("order_id").union(orders.where("order_id % 1000 = 1").select("order_id"))
    said = {
        "rows": _refusal(lambda: require_rows(orders.where("order_id < 0"), "restaurant orders")),
        "fields": _refusal(lambda: require_fields(orders, ["order_id", "amount"], "order_id")),
        "column": _refusal(lambda: require_fields(orders, ["courier"], "order_id")),
        "key": (_refusal(lambda: require_key(twice, "order_id")) or "")[-14:],
        "kept": _refusal(lambda: require_key(orders, "order_id")),
    }
    return spark.createDataFrame(list(said.items()), "gate string, said string")


def _looked_at(spark: SparkSession, sf_dir: str) -> HistoryTable:
    """Three looks at the deliveries: some not there yet, some changed, some gone."""
    deliveries = messy.view(spark, sf_dir, messy.DELIVERIES_TIDY)
    table = HistoryTable(scratch_path(spark, "history"), deliveries.schema, "id", ("status", "amount"))
    late = F.when(F.col("order_date") >= "2000-07-01", "delivered").otherwise(F.col("status"))
    second = deliveries.withColumn("status", late)
    third = second.where(F.col("order_date") >= "1996-01-01").withColumn(
        "amount", F.coalesce("amount", F.lit("0.00"))
    )
    table.look(deliveries.where(F.col("order_date") < "2001-01-01"), 1)
    table.look(second, 2)
    table.look(third, 3)
    return table


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _looked_at(spark, sf_dir).read(spark)


def history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second of three looks saw, versions that the third one closed included."""
    return _looked_at(spark, sf_dir).as_of(spark, 2)


def city_mart_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city mart from stored states after two loads, without reading the first load again.

    The second load brings later orders, and earlier ones of low amount that had other amounts.
    """
    weather = staging.stg_weather(weather_summary(messy.view(spark, sf_dir, messy.WEATHER)))
    staged = staging.stg_deliveries(messy.view(spark, sf_dir, messy.DELIVERIES))
    enriched = settle(marts.int_orders_enriched(staged, weather), "enriched").frame
    early = F.col("order_date") < "1997-01-01"
    again = early & (F.col("amount") < 20)
    wrong = enriched.where(early).withColumn("amount", F.when(again, 0.07).otherwise(F.col("amount")))
    table = incremental.city_table(scratch_path(spark, "city_states"), spark)
    incremental.apply_load(table, wrong)
    restated = wrong.where("amount = 0.07")
    incremental.apply_load(
        table, enriched.where(~early).unionByName(enriched.where(again)), restated
    )
    return incremental.city_mart(table.read(spark))


def restaurants_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct restaurants of a city per year from daily sketches, beside the exact counts.

    `within` says whether the estimate is within five per cent, several times its usual error.
    """
    orders = staging.stg_orders(messy.view(spark, sf_dir, messy.RAW_ORDERS))
    orders = settle(
        orders.select("customer_city", "restaurant_name", F.to_date("ordered_at").alias("day")), "orders"
    ).frame
    sketches = incremental.distinct_sketches(orders, ["customer_city", "day"], "restaurant_name")
    stored = settle(sketches, "sketches").frame
    parts = []
    for first, last in (("1992-01-01", "1993-06-30"), ("1993-07-01", "1996-02-29"), ("1992-01-01", "2005-01-01")):
        period = F.col("day").between(first, last)
        estimate = incremental.distinct_in(stored, ["customer_city"], period)
        exact = orders.where(period).groupBy("customer_city").agg(F.count_distinct("restaurant_name").alias("restaurants"))
        parts.append(exact.join(estimate, "customer_city").withColumn("until", F.lit(last)))
    joined = parts[0].unionByName(parts[1]).unionByName(parts[2])
    near = F.abs(F.col("estimate") - F.col("restaurants")) <= F.greatest(F.lit(1.0), F.col("restaurants") * 0.05)
    return joined.select("customer_city", "until", "restaurants", near.alias("within"))


def sums_across_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of amounts whose sizes differ by forty digits, most of which cancel.

    In odd parts only the smallest amounts are left, in even ones some of the usual size too.
    """
    amounts = spark.sql(
        """SELECT l_suppkey % 20 AS part, l_extendedprice * scale AS amount
           FROM {lines} LATERAL VIEW explode(array(1D, -1D, 1e-18D, 1e24D, -1e24D)) s AS scale
           WHERE scale <> -1 OR l_linenumber <> 1 OR l_suppkey % 2 = 1""",
        lines=messy.table(spark, sf_dir, "lineitem"),
    )
    return exact_sum_by(amounts, ["part"], "amount", "total")


JOBS = {
    "history_table": history_table,
    "history_as_of": history_as_of,
    "city_mart_two_loads": city_mart_two_loads,
    "restaurants_in_periods": restaurants_in_periods,
    "sums_across_scales": sums_across_scales,
    "split_files": split_files,
    "typed_files": typed_files,
    "process_order_files": process_order_files,
    "process_order_arrays": process_order_arrays,
    "analysis_files": analysis_files,
    "weather_report_files": weather_report_files,
    "landed_readings": landed_readings,
    "landed_failures": landed_failures,
    "stored_warehouse": stored_warehouse,
    "stored_star": stored_star,
    "stored_star_two_batches": stored_star_two_batches,
    "stored_star_days": stored_star_days,
    "weather_batch_summary": weather_batch_summary,
    "restaurant_batch_daily": restaurant_batch_daily,
    "refusals": refusals,
}
