"""Upsert by key and type-2 history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS
from skyledger.operators.shared import Settled, settle


def last_per_key(batch: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """One row per key, the last by `order`. Combines before the shuffle, so hot keys are safe.

    A null key is refused when the rows are read, as a primary key would refuse it.
    """
    row = F.struct(*batch.columns)
    rank = row if order is None else F.struct(order.alias("by"), row.alias("row"))
    kept = batch.groupBy(_known(batch, key).alias("_key")).agg(F.max_by(row, rank).alias("_row"))
    # The key comes from the grouping, or its check would be pruned.
    return kept.select(
        *(F.col("_key" if c == key else f"_row.{c}").alias(c) for c in batch.columns)
    )


def _known(df: DataFrame, key: str) -> Column:
    refused = F.raise_error(F.lit(f"the key {key} is null")).cast(df.schema[key].dataType)
    return F.when(F.col(key).isNull(), refused).otherwise(F.col(key))


def upsert(
    existing: DataFrame, batch: DataFrame, key: str, order: Column | None = None
) -> DataFrame:
    """Existing rows with those of the batch put in their place or added."""
    return put(existing, settle(last_per_key(batch, key, order), "batch"), key)


def put(existing: DataFrame, incoming: Settled, key: str) -> DataFrame:
    """As `upsert`, for incoming rows that are known to have each key once.

    Rows that stay are those whose key does not arrive. The keys of a batch within the limits are
    broadcast, so the existing rows are not shuffled for it.
    """
    keys = incoming.frame.select(F.col(key).alias("_key"))
    if incoming.rows <= BROADCAST_ROWS and incoming.size <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    stay = existing.join(keys, existing[key] == keys["_key"], "left_anti")
    return stay.unionByName(incoming.frame.select(*existing.columns))


def open_history(source: DataFrame, version: int | Column) -> DataFrame:
    """First snapshot: every row is a current version."""
    return source.withColumns(
        {"valid_from": _lit(version), "valid_to": F.lit(None).cast("bigint")}
    )


def snapshot(
    history: DataFrame, source: DataFrame, key: str, checked: Sequence[str], version: int | Column
) -> DataFrame:
    """Type-2 history after one more look at the source.

    Of source rows that share a key the greatest one counts, column by column; a null key is
    refused.
    A key whose checked columns changed has its open version closed and a new one opened. A new
    key opens a version. A key that left the source keeps its open version. Closed versions pass
    through without a join.
    """
    columns = source.columns
    source = last_per_key(source, key)
    closed = history.where(F.col("valid_to").isNotNull())
    current = history.where(F.col("valid_to").isNull()).select(
        F.struct(*history.columns).alias("old"), F.col(key).alias("old_key")
    )
    arriving = source.select(F.struct(*columns).alias("new"), F.col(key).alias("new_key"))
    pairs = current.join(arriving, F.col("old_key") == F.col("new_key"), "full_outer")
    differs = reduce(or_, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in checked))
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & differs

    kept = F.struct(
        *(F.col(f"old.{c}").alias(c) for c in columns),
        F.col("old.valid_from").alias("valid_from"),
        F.when(changed, _lit(version)).alias("valid_to"),
    )
    opened = F.struct(
        *(F.col(f"new.{c}").alias(c) for c in columns),
        _lit(version).alias("valid_from"),
        F.lit(None).cast("bigint").alias("valid_to"),
    )
    versions = F.array(
        F.when(F.col("old").isNotNull(), kept),
        F.when(F.col("old").isNull() | changed, opened),
    )
    moved = pairs.select(F.inline(F.filter(versions, lambda v: v.isNotNull())))
    return closed.unionByName(moved)


def _lit(version: int | Column) -> Column:
    return (version if isinstance(version, Column) else F.lit(version)).cast("bigint")
