"""Data checks.

A check counts the rows (or, for uniqueness, the keys) that break it. All row checks of one
table share a single pass; a suite is one frame with a row per check. A table that is written
anyway has its row checks counted by that write (`settle_checked`), and is not read for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.shared import Settled, settle, together


class DataCheckError(ValueError):
    """Input that must not be loaded."""


@dataclass(frozen=True)
class Check:
    table: str
    name: str
    column: str
    breaks: Column | None = None  # None: the column must be unique


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", c, F.col(c).isNull()) for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check(table, "unique", c) for c in columns]


def accepted_values(table: str, column: str, values: Sequence[str]) -> list[Check]:
    return [Check(table, "accepted_values", column, ~F.col(column).isin(*values))]


def custom(table: str, name: str, column: str, breaks: Column) -> list[Check]:
    return [Check(table, name, column, breaks)]


@dataclass(frozen=True)
class Checked:
    """A table on shared storage, with the violations of its row checks as its write counted them."""

    table: Settled
    violations: tuple[int, ...]


def settle_checked(checks: Sequence[Check], **frames: DataFrame) -> dict[str, Checked]:
    """Write tables that do not depend on each other, counting their row checks on the way."""

    def write(name: str, df: DataFrame) -> Checked:
        counted = [c.breaks for c in checks if c.table == name and c.breaks is not None]
        if not counted:
            return Checked(settle(df, name), ())
        seen = Observation()
        table = settle(df.observe(seen, *(F.count_if(b).alias(f"_{i}") for i, b in enumerate(counted))), name)
        return Checked(table, tuple(seen.get[f"_{i}"] for i in range(len(counted))))

    spark = next(iter(frames.values())).sparkSession
    return dict(zip(frames, together(spark, *(partial(write, n, df) for n, df in frames.items()))))


def counted_report(spark: SparkSession, table: str, checks: Sequence[Check], counts: Sequence[int]) -> DataFrame:
    """As `row_check_report`, from counts that were taken before."""
    rows = [(table, c.column, c.name, n) for c, n in zip(checks, counts)]
    return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, violations bigint")


def row_check_report(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One aggregate over the table, then one output row per check."""
    counted = df.agg(*(F.count_if(c.breaks).alias(f"_{i}") for i, c in enumerate(checks)))
    rows = F.array(
        *(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.name).alias("check_name"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, c in enumerate(checks)
        )
    )
    return counted.select(F.inline(rows))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def unique_report(df: DataFrame, table: str, column: str) -> DataFrame:
    return repeated_keys(df, column).agg(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("unique").alias("check_name"),
        F.count(F.lit(1)).alias("violations"),
    )


def quality_report(tables: Mapping[str, DataFrame | Checked], checks: Sequence[Check]) -> DataFrame:
    parts: list[DataFrame] = []
    for table, given in tables.items():
        df = given.table.frame if isinstance(given, Checked) else given
        mine = [c for c in checks if c.table == table]
        by_row = [c for c in mine if c.breaks is not None]
        if by_row and isinstance(given, Checked):
            parts.append(counted_report(df.sparkSession, table, by_row, given.violations))
        elif by_row:
            parts.append(row_check_report(df, table, by_row))
        parts.extend(unique_report(df, table, c.column) for c in mine if c.breaks is None)
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("violations") == 0)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise DataCheckError(f"{what} is empty: nothing to load")
    return df


def require_fields(df: DataFrame, fields: Sequence[str], record: str) -> DataFrame:
    """Every row must carry every field; the error names a record and its missing field."""
    absent = [f for f in fields if f not in df.columns]
    if absent:
        raise DataCheckError(f"every record is missing field: {absent[0]}")
    # A struct is null-safe as a sample: the record id itself may be the missing field.
    sample = F.struct(F.col(record).cast("string").alias("record"))
    found = df.agg(
        *(F.min(F.when(F.col(f).isNull(), sample)).alias(f) for f in fields)
    ).first()
    for field in fields:
        if found[field] is not None:
            raise DataCheckError(f"record {found[field]['record']} is missing field: {field}")
    return df


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Primary key rule for tables whose format cannot enforce one: not null and not repeated."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    lacking = reduce(or_, (F.col(k).isNull() for k in keys))
    broken = counted.where(lacking | (F.col("n") > 1)).first()
    if broken is not None:
        raise DataCheckError(f"key {tuple(broken[k] for k in keys)} occurs {broken['n']} times")
    return df
