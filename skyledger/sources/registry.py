"""Named sources: a name gives a reader and its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyledger import schemas
from skyledger.sources.files import read_csv
from skyledger.sources.buckets import BucketedTable
from skyledger.sources.writers import TableNotFoundError, read_table

WAREHOUSE: dict[str, StructType] = {
    "orders": schemas.ORDERS,
    "deliveries": schemas.DELIVERIES,
    "restaurant_orders_raw": schemas.RESTAURANT_ORDERS,
    "weather_raw": schemas.READINGS,
    "weather_summary": schemas.WEATHER_SUMMARY,
    "dim_date": schemas.DIM_DATE,
    "dim_city": schemas.DIM_CITY,
    "dim_status": schemas.DIM_STATUS,
    "fact_orders": schemas.FACT_ORDERS,
    "dim_customers": schemas.DIM_CUSTOMERS,
    "dim_products": schemas.DIM_PRODUCTS,
    "dim_cities": schemas.DIM_CITIES,
}
SEEDS: dict[str, StructType] = {"raw_orders": schemas.RAW_ORDERS}
# Tables that grow by upserts, with their key; they lie in buckets of it.
BUCKETED = {"orders": "id", "fact_orders": "order_key"}
GROUPS = {"warehouse": WAREHOUSE, "seeds": SEEDS}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def bucketed(root: str, table: str) -> BucketedTable:
    return BucketedTable(table_path(root, table), WAREHOUSE[table], BUCKETED[table])


def source(spark: SparkSession, root: str, group: str, table: str) -> DataFrame:
    """Warehouse tables are versioned folders or buckets; seeds are CSV files, all text.

    A table or file that is not there is an error.
    """
    schema = GROUPS[group][table]
    if group == "seeds":
        return read_csv(spark, f"{table_path(root, table)}.csv", schema)
    if table in BUCKETED:
        stored = bucketed(root, table)
        if not stored.there(spark):
            raise TableNotFoundError(stored.path)
        return stored.read(spark)
    return read_table(spark, table_path(root, table), schema)
