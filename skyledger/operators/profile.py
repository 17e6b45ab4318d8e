"""Column profile: rows, distinct values, most common value, nulls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_profiles(df: DataFrame, columns: Sequence[str], position: str) -> DataFrame:
    """One row per column, from one pass over the frame. Values are compared as text.

    Ties for the most common value go to the one seen first by `position`. Values are counted
    first, so only one small row per column and distinct value reaches the last step.
    """
    cells = F.array(
        *(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns)
    )
    counted = (
        df.select(F.col(position).alias("position"), F.inline(cells))
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("seen"))
    )
    found = counted.agg(*(_of(name).alias(f"_{i}") for i, name in enumerate(columns)))
    return found.select(F.inline(F.array(*(f"_{i}" for i in range(len(columns))))))


def column_profile(df: DataFrame, column: str, position: str) -> DataFrame:
    return column_profiles(df, [column], position)


def _of(name: str) -> Column:
    mine = F.col("name") == name
    is_value = mine & F.col("value").isNotNull()
    rank = F.struct(F.col("n"), -F.col("seen"))
    return F.struct(
        F.lit(name).alias("column_name"),
        F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias("row_count"),
        F.count_if(is_value).alias("unique_count"),
        F.max_by("value", F.when(is_value, rank)).alias("most_common"),
        F.coalesce(
            F.sum(F.when(mine & F.col("value").isNull(), F.col("n"))), F.lit(0)
        ).alias("null_count"),
    )
