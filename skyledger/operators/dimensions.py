"""Surrogate keys and the split of a wide table into entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.ordered import WINDOW_ROWS, with_row_number
from skyledger.operators.shared import Settled, settle


def number_values(
    values: DataFrame | Settled, by: Sequence[str], key: str, window_rows: int = WINDOW_ROWS
) -> Settled:
    """Key 1, 2, 3... in ascending order of the value, nulls last.

    The values are written once; their number is then known, and the keys follow from it lazily.
    """
    values = values if isinstance(values, Settled) else settle(values, "values")
    order = [F.asc_nulls_last(c) for c in by]
    numbered = with_row_number(values, [], order, key, window_rows)
    size = values.size + 8 * values.rows
    return Settled(numbered.select(key, *values.frame.columns), values.rows, size)


def distinct_values(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).distinct()


def distinct_dimension(
    df: DataFrame, column: str, key: str, name: str, window_rows: int = WINDOW_ROWS
) -> Settled:
    return number_values(distinct_values(df, column, name), [name], key, window_rows)


def extend_dimension(
    existing: DataFrame, df: DataFrame, column: str, key: str, name: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Keep every key already given out; number only values not seen before, after the last key."""
    seen = existing.select(F.col(name).alias("_seen"))
    fresh = distinct_values(df, column, name).join(seen, F.col(name).eqNullSafe(F.col("_seen")), "left_anti")
    last = existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = number_values(fresh, [name], key, window_rows).frame
    return existing.unionByName(numbered.withColumn(key, F.col(key) + last))


def split_entity(
    wide: DataFrame, columns: Mapping[str, str], key: str, window_rows: int = WINDOW_ROWS
) -> Settled:
    """Distinct entity rows of a wide table under new names, with a surrogate key."""
    entity = wide.select(*(F.col(old).alias(new) for old, new in columns.items())).distinct()
    return number_values(entity, list(columns.values()), key, window_rows)


def dependency_report(wide: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """For each rule (determinant, dependent): how many determinants have several values."""

    def broken(determinant: str, dependent: str) -> DataFrame:
        pairs = wide.select(determinant, dependent).where(F.col(determinant).isNotNull())
        values = pairs.distinct().groupBy(determinant).agg(F.count(F.lit(1)).alias("n"))
        return values.agg(
            F.lit(determinant).alias("determinant"),
            F.lit(dependent).alias("dependent"),
            F.count(F.lit(1)).alias("determinants"),
            F.count_if(F.col("n") > 1).alias("broken"),
        )

    return reduce(DataFrame.unionByName, (broken(*rule) for rule in rules))
