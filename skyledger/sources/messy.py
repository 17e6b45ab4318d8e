"""Messy views over the given tables, in SQL that two engines run unchanged.

They stand in for the raw deliveries, weather readings and restaurant orders: null, blank, padded
and mixed-case text, amounts that are not numbers, bad timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Readings per payload are bounded by this many events, however many readings a city has.
PAYLOAD_EVENTS = 1800

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents")

DELIVERIES = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '   '
       WHEN o_orderkey % 3 = 0 THEN concat('  ', n_name, ' ')
       WHEN o_orderkey % 3 = 1 THEN lower(n_name) ELSE n_name END AS city,
  CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN ' delivered '
       ELSE 'CANCELLED' END AS status,
  CASE WHEN o_orderkey % 83 = 0 THEN NULL WHEN o_orderkey % 79 = 0 THEN 'N/A'
       ELSE concat(CAST(CAST(floor(c / 100) AS BIGINT) AS STRING), '.',
                   lpad(CAST(c % 100 AS STRING), 2, '0')) END AS amount,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date
FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) % 20000 AS c FROM {orders}) o
JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

# City and status already lower case and trimmed, the amount still raw text.
DELIVERIES_TIDY = f"""
SELECT id, trim(lower(city)) AS city, trim(lower(status)) AS status, amount, order_date
FROM ({DELIVERIES}) raw
"""

WEATHER = """
SELECT CASE WHEN event_id % 2 = 0 THEN concat('NATION_', CAST(user_id % 25 AS STRING))
            ELSE concat(' nation_', CAST(user_id % 25 AS STRING), ' ') END AS city,
  CASE WHEN event_id % 101 = 0 THEN 'bad-time' ELSE CAST(ts AS STRING) END AS time,
  CASE WHEN event_id % 53 = 0 THEN NULL
       ELSE CAST(floor(value * 10) AS BIGINT) % 450 / 10 END AS temperature_c
FROM {events}
"""

RAW_ORDERS = """
SELECT CAST(o_orderkey AS STRING) AS order_id, concat(' ', n_name) AS customer_city,
  s_name AS restaurant_name,
  concat('Category ', CAST(s_nationkey % 5 AS STRING)) AS restaurant_category,
  CASE WHEN o_orderkey % 71 = 0 THEN 'free'
       ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 200 AS STRING) END AS order_total,
  CAST(o_orderkey % 4 AS STRING) AS delivery_fee,
  CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN ' delivered '
       ELSE 'Cancelled' END AS order_status,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T12:30') AS ordered_at
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
JOIN {supplier} ON s_suppkey = o_orderkey % (SELECT count(*) FROM {supplier})
"""

# The restaurant load has its own table, with a typed amount and a status not to be tidied.
RESTAURANT_ORDERS = f"""
SELECT CAST(order_id AS BIGINT) AS order_id, restaurant_name, customer_city AS city,
  CAST(CASE WHEN order_total = 'free' THEN NULL ELSE order_total END AS DOUBLE) AS amount,
  CASE order_status WHEN 'Delivered' THEN 'delivered' ELSE order_status END AS status,
  substring(ordered_at, 1, 10) AS order_date
FROM ({RAW_ORDERS}) raw
"""

# Typed but not filtered: null and blank cities, and orders without an amount, stay in.
DELIVERIES_TYPED = f"""
SELECT id, city, status, TRY_CAST(amount AS DOUBLE) AS amount, CAST(order_date AS DATE) AS order_date
FROM ({DELIVERIES_TIDY}) tidy
"""

# Requests for cities, one per event, as they were typed.
REQUESTS = """
SELECT event_id AS position,
  CASE WHEN event_id % 2 = 0 THEN concat('Nation_', CAST(user_id % 40 AS STRING))
       ELSE concat('NATION_', CAST(user_id % 25 AS STRING)) END AS city
FROM {events}
"""

CITY_REGISTRY = """
SELECT lower(n_name) AS name, CAST(n_nationkey AS DOUBLE) * 1.5 - 10 AS lat,
  CAST(n_regionkey AS DOUBLE) * 2.25 AS lon
FROM {nation}
"""

# Free text with and without prices in it: whole documents, and labels made from parts.
TEXTS = """
SELECT 'document' AS origin, doc_id AS id, text AS value FROM {documents}
UNION ALL
SELECT 'part' AS origin, p_partkey AS id,
  concat(' ', p_name, ' EUR -', CAST(p_size AS STRING), ',',
         lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'),
         CASE WHEN p_partkey % 2 = 0 THEN '.50' ELSE '' END, '	') AS value
FROM {part}
"""

# One wide row per order line, before it is split into customers, products and cities.
WIDE_ORDERS = """
SELECT o_orderkey AS order_id, c_name AS customer_name,
  concat(lower(c_name), '@example.com') AS customer_email,
  n_name AS customer_city, r_name AS customer_region,
  p_name AS product_name, p_type AS product_category, p_retailprice AS product_price,
  l_quantity AS quantity, CAST(o_orderdate AS DATE) AS order_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey JOIN {part} ON l_partkey = p_partkey
"""


_known: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once, as a catalog would keep it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _known:
        _known[path] = spark.read.parquet(path).schema
    return spark.read.schema(_known[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    used = [t for t in TABLES if "{" + t + "}" in statement]
    return spark.sql(statement, **{t: table(spark, sf_dir, t) for t in used})


def plain(statement: str) -> str:
    """The same statement for an engine where the tables are known by name."""
    return statement.format(**{t: t for t in TABLES})


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather payloads with parallel arrays, one per city and block of events.

    Every third block lacks its last temperature, so the two arrays differ in length.
    """
    events = table(spark, sf_dir, "events")
    reading = F.struct(
        "event_id",
        F.col("ts").cast("string").alias("time"),
        F.when(F.col("event_id") % 53 != 0, F.col("value")).alias("value"),
    )
    city = F.concat(F.lit("nation_"), (F.col("user_id") % 25).cast("string"))
    block = F.floor(F.col("event_id") / PAYLOAD_EVENTS)
    grouped = events.groupBy(city.alias("city"), block.alias("block")).agg(
        F.array_sort(F.collect_list(reading)).alias("readings")
    )
    kept = F.size("readings") - F.when(F.col("block") % 3 == 0, 1).otherwise(0)
    return grouped.select(
        "city",
        F.struct(
            F.col("readings.time").alias("time"),
            F.slice(F.col("readings.value"), 1, kept).alias("temperature_2m"),
        ).alias("hourly"),
    )
