"""Row numbers and previous values over groups of any size.

A window puts each group into one task. That is right while the whole input is small, and it is
used then. A stored table brings its counts along; any other frame is stored first, which counts it,
so that it is worked out once. Above the limits of rows or bytes the rows are range-partitioned on group and order, sorted inside each
partition and written with their position; a partition holds a slice of one group or a few whole
groups. One small row per slice carries what the next slice needs from the ones before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyledger.operators.lookups import lookup_join
from skyledger.operators.shared import Settled, settle

WINDOW_ROWS = 5_000_000
WINDOW_BYTES = 1 << 30
SLICE, PLACE = "_slice", "_place"


def with_row_number(
    df: DataFrame | Settled,
    group: Sequence[str],
    order: Sequence[Column],
    name: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Number the rows of each group from 1. The order must be total for a stable result."""
    rows, small = _source(df, window_rows)
    if small:
        return rows.withColumn(name, F.row_number().over(_window(group, order)).cast("bigint"))

    sliced = _slices(rows, group, order)
    starts = sliced.groupBy(SLICE, *group).agg(
        F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = _window(group, [F.col(SLICE)]).rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        SLICE,
        *group,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return (
        lookup_join(sliced, starts, [SLICE, *group], "inner", null_safe=True)
        .withColumn(name, F.col(PLACE) + F.col("_shift"))
        .select(*rows.columns, name)
    )


def with_previous(
    df: DataFrame | Settled,
    group: Sequence[str],
    order: Sequence[Column],
    value: str,
    name: str,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Value of the row before, within the group; null on the first row of a group."""
    rows, small = _source(df, window_rows)
    if small:
        return rows.withColumn(name, F.lag(value).over(_window(group, order)))

    sliced = _slices(rows, group, order)
    edges = sliced.groupBy(SLICE, *group).agg(
        F.min(PLACE).alias("_first"), F.max_by(value, PLACE).alias("_last")
    )
    edges = edges.select(
        SLICE,
        *group,
        "_first",
        F.lag("_last").over(_window(group, [F.col(SLICE)])).alias("_carried"),
    )
    inside = sliced.withColumn(name, F.lag(value).over(_window([SLICE, *group], [F.col(PLACE)])))
    carried = F.when(F.col(PLACE) == F.col("_first"), F.col("_carried")).otherwise(F.col(name))
    return (
        lookup_join(inside, edges, [SLICE, *group], "inner", null_safe=True)
        .withColumn(name, carried)
        .select(*rows.columns, name)
    )


def _source(df: DataFrame | Settled, window_rows: int) -> tuple[DataFrame, bool]:
    """The rows, and whether one window per group may take them."""
    if window_rows <= 0:
        return df.frame if isinstance(df, Settled) else df, False
    known = df if isinstance(df, Settled) else settle(df, "ordered")
    return known.frame, known.rows <= window_rows and known.size <= WINDOW_BYTES


def _window(group: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    return Window.partitionBy(*group).orderBy(*order) if group else Window.orderBy(*order)


def _slices(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Write the rows in sorted slices, each row with its slice and its place in the slice."""
    keys = [*(F.col(g) for g in group), *order]
    # The id counts rows of a partition in the low 33 bits and partitions in the bits above.
    place = F.monotonically_increasing_id()
    written = settle(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(PLACE, place), "slices"
    ).frame
    return written.withColumn(SLICE, F.shiftright(PLACE, 33)).withColumn(
        PLACE, F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    )
