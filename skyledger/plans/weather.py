"""Weather summaries per city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.numbers import round_even, round_sql
from skyledger.functions.sums import exact_avg
from skyledger.functions.text import sql_tidy, strip_lower


def aggregate_weather(readings: DataFrame, ordered: bool = True) -> DataFrame:
    """Dataframe rules: only real readings count, no null city, half-even rounding, sorted."""
    temperature = F.nanvl("temperature_c", F.lit(None).cast("double"))
    weather = (
        readings.select(strip_lower("city").alias("city"), temperature.alias("temperature_c"))
        .where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(
            round_even(exact_avg("temperature_c"), 1).alias("avg_temp"),
            F.max("temperature_c").alias("max_temp"),
            F.min("temperature_c").alias("min_temp"),
            F.count("temperature_c").alias("record_count"),
        )
    )
    return weather.orderBy("city") if ordered else weather


def weather_summary(readings: DataFrame) -> DataFrame:
    """SQL rules: every row counts, null cities form a group, half-up rounding."""
    return (
        readings.groupBy(sql_tidy("city").alias("city"))
        .agg(
            round_sql(exact_avg("temperature_c"), 1).alias("avg_temp"),
            F.max("temperature_c").alias("max_temp"),
            F.min("temperature_c").alias("min_temp"),
            F.count(F.lit(1)).alias("record_count"),
        )
    )
