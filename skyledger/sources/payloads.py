"""Landed weather payloads: parallel arrays of times and temperatures, one payload per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.text import col


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """All landed files in one scan; each line is one payload.

    The city is a field of the payload, or comes from the path when files land in folders named
    `city=<name>`.
    """
    return spark.read.schema(schemas.PAYLOAD).json(path, mode="FAILFAST")


def zip_shortest(left: str | Column, right: str | Column) -> Column:
    """Pair two arrays up to the length of the shorter one."""
    left, right = col(left), col(right)
    length = F.least(F.size(left), F.size(right))
    return F.arrays_zip(
        F.slice(left, 1, length).alias("time"), F.slice(right, 1, length).alias("temperature_c")
    )


def is_broken() -> Column:
    """A payload without one of its two arrays has no readings to give."""
    return F.col("hourly.time").isNull() | F.col("hourly.temperature_2m").isNull()


def failed_cities(payloads: DataFrame) -> DataFrame:
    """Cities whose payload is broken; all others are still read."""
    return payloads.where(is_broken()).select("city").distinct()


def flatten_payloads(payloads: DataFrame) -> DataFrame:
    """One reading per row, tagged with the city of its payload."""
    return payloads.select("city", F.inline(zip_shortest("hourly.time", "hourly.temperature_2m")))
