"""Marts kept up to date from what arrived, by partial states that add up.

A state holds what a mart needs of a group in a form that merges: parts of exact sums, counts, and a
sketch for distinct counts. A load aggregates its own rows and merges them with the stored states of
the groups it touches, in hash buckets; rows of earlier loads are not read again. A row that is
stated anew is taken away as it was and added as it is.

Sums and counts come out as a full rebuild gives them. Distinct counts cannot be taken back, so they
are for rows that only arrive; they are estimates within a few times 1.04 / sqrt(2**k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.functions.numbers import round_sql
from skyledger.functions.sums import merge_states, state_avg, state_sum, sum_state
from skyledger.sources.buckets import BucketedTable

ADDED, TAKEN = 1, -1
SKETCH_K = 14  # a sketch has 2**14 registers of six bits, so its error is 0.8 % or so


def city_states(enriched: DataFrame, sign: int = ADDED) -> DataFrame:
    """One row per city: the states of `mart_city_summary`, to be added or taken away."""
    return (
        enriched.groupBy("city")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(F.col("status") == "delivered").alias("delivered"),
            sum_state("amount").alias("amount"),
            sum_state("avg_temp").alias("avg_temp"),
            sum_state("revenue_per_degree").alias("per_degree"),
        )
        .withColumn("sign", F.lit(sign))
    )


def merged_states(states: DataFrame) -> DataFrame:
    sums, counts = ("amount", "avg_temp", "per_degree"), ("orders", "delivered")
    return states.groupBy("city").agg(
        *(F.sum(F.col(c) * F.col("sign")).alias(c) for c in counts),
        *(merge_states(c, sign=F.col("sign")).alias(c) for c in sums),
    )


def city_table(path: str, spark: SparkSession) -> BucketedTable:
    """Stored states; cities are few, but the same layout serves any group key."""
    schema = StructType.fromDDL(
        "city string, orders bigint, delivered bigint, "
        + ", ".join(
            f"{c} struct<near: array<bigint>, rest: double, n: bigint>" for c in ("amount", "avg_temp", "per_degree")
        )
    )
    return BucketedTable(path, schema, "city", 4)


def apply_load(
    table: BucketedTable, arrived: DataFrame, restated: DataFrame | None = None
) -> int:
    """Merge the states of arrived rows, and take away rows as they were before, into the table.

    Reads the arrived and restated rows and the stored states of their cities. Rows without a city
    are not kept, as a table has no null key.
    """
    spark = arrived.sparkSession
    changes = city_states(arrived.where(F.col("city").isNotNull()))
    if restated is not None:
        changes = changes.unionByName(city_states(restated.where(F.col("city").isNotNull()), TAKEN))
    change = merged_states(changes).withColumn("sign", F.lit(ADDED))
    known = table.read(spark).join(F.broadcast(change.select("city")), "city", "left_semi")
    return table.upsert(merged_states(change.unionByName(known.withColumn("sign", F.lit(ADDED)))))


def city_mart(states: DataFrame) -> DataFrame:
    """`mart_city_summary` from states; cities whose rows were all taken away are gone."""
    return states.where("orders > 0").select(
        "city",
        F.col("orders").alias("total_orders"),
        state_sum("amount").alias("total_revenue"),
        round_sql(state_avg("amount"), 2).alias("avg_order_value"),
        F.col("delivered").alias("delivered_count"),
        round_sql(state_avg("avg_temp"), 1).alias("avg_temp"),
        round_sql(state_avg("per_degree"), 4).alias("avg_revenue_per_degree"),
    )


def distinct_sketches(rows: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """A sketch of the distinct values of each group, to be stored and united later."""
    return rows.groupBy(*groups).agg(F.hll_sketch_agg(value, F.lit(SKETCH_K)).alias("sketch"))


def distinct_in(sketches: DataFrame, groups: Sequence[str], period: Column) -> DataFrame:
    """Distinct values per group over any period, from the sketches alone."""
    chosen = sketches.where(period)
    united = chosen.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*groups, F.hll_sketch_estimate("sketch").alias("estimate"))
