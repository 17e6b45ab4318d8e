"""Joins of a large frame to a lookup that has at most one row per key.

The lookup is written first, so its rows and bytes are known. Up to a limit it is broadcast and
the large side is not shuffled at all. Beyond the limit the join shuffles. Keys that hold too many
rows of the large side are labelled by a broadcast list and spread over salts, and their lookup
rows are copied once per salt, so no key can fill one task and the large side is joined once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from skyledger.operators.shared import Settled, settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 2_000_000
MOST_HOT_KEYS = 100_000
HOW = ("inner", "left", "left_semi", "left_anti")


def as_settled(lookup: DataFrame | Settled, label: str = "lookup") -> Settled:
    return lookup if isinstance(lookup, Settled) else settle(lookup, label)


def lookup_join(
    large: DataFrame,
    lookup: DataFrame | Settled,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join on equally named keys. With `null_safe`, null keys match each other."""
    if how not in HOW:
        raise ValueError(f"lookup_join keeps rows of the large side: how is one of {HOW}")
    lookup = as_settled(lookup)
    if lookup.rows <= broadcast_rows and lookup.size <= BROADCAST_BYTES:
        return _join(large, F.broadcast(lookup.frame), keys, how, null_safe)

    counts = settle(large.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key_counts").frame
    # At most MOST_HOT_KEYS keys can hold more than this share of all rows each. They are labelled
    # by a hash, so the list is small enough to broadcast however long keys are; another key of the
    # same hash is salted too, which does no harm. All salts together are as many as hot rows fill.
    share = (counts.agg(F.sum("_rows") / F.lit(MOST_HOT_KEYS))).scalar()
    many = (F.col("_rows") > F.lit(hot_rows)) & (F.col("_rows") > share)
    label = F.xxhash64(*keys).alias("_label")
    salts = F.max(F.ceil(F.col("_rows") / hot_rows)).alias("_salts")
    hot = settle(counts.where(many).groupBy(label).agg(salts), "hot_keys")
    if hot.rows == 0:
        return _join(large, lookup.frame, keys, how, null_safe)
    labels = F.broadcast(hot.frame)
    last = F.coalesce("_salts", F.lit(1))
    # Any column may tell rows of a key apart; equal rows share a salt.
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(large)]), last).alias("_salt")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint") - 1)).alias("_salt")
    labelled = large.select("*", label).join(labels, "_label", "left")
    salted = labelled.select(*large.columns, spread)
    copied = lookup.frame.select("*", label).join(labels, "_label", "left").select(*lookup.frame.columns, copies)
    return _join(salted, copied, keys, how, null_safe, also="_salt").drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]


def _join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: bool,
    also: str | None = None,
) -> DataFrame:
    """Join on equally named keys, and on one more column that is never null."""
    more = [also] if also else []
    if not null_safe:
        return left.join(right, [*keys, *more], how)
    renamed = right.withColumnsRenamed({k: f"_key_{k}" for k in [*keys, *more]})
    matches: Column = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    for name in more:
        matches &= F.col(name) == F.col(f"_key_{name}")
    return left.join(renamed, matches, how).drop(*(f"_key_{k}" for k in [*keys, *more]))
