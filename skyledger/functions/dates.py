"""Calendar parts and day series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ONE_DAY = "INTERVAL 1 DAY"


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def calendar_parts(d: Column) -> dict[str, Column]:
    return {
        "date_key": date_key(d),
        "date": d,
        "day_of_week": F.date_format(d, "EEEE"),
        "week_number": F.weekofyear(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row a day, both ends included, from a one-row frame that holds the ends."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr(ONE_DAY))).alias("date"))


def day_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    return days_between(spark.range(1), F.lit(first).cast("date"), F.lit(last).cast("date"))


def days_of(df: DataFrame, name: str, extra_days: int = 0) -> DataFrame:
    """Every day from the earliest to the latest value of a date column."""
    bounds = df.agg(F.min(name).alias("first"), F.max(name).alias("last"))
    return days_between(bounds, F.col("first"), F.date_add("last", extra_days))
