"""The paths for large lookups and large inputs give the rows of the plain path."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.operators.dimensions import distinct_dimension, extend_dimension
from skyledger.operators.lookups import lookup_join
from skyledger.operators.shared import settle
from skyledger.operators.ordered import with_previous, with_row_number
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a sixth have none."""
    random.seed(1)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 6 == 1 else f"k{random.randrange(400)}"
        data.append((i, key, float(random.randrange(50))))
    return spark.createDataFrame(data, "id int, key string, amount double").repartition(5)


@pytest.fixture(scope="module")
def lookup(spark):
    data = [("hot", 1), (None, 2), *((f"k{i}", 10 + i) for i in range(0, 400, 2))]
    return spark.createDataFrame(data, "key string, value int")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_lookup_paths_agree(skewed, lookup, how, null_safe, hot_rows):
    plain = lookup_join(skewed, lookup, ["key"], how, null_safe)
    split = lookup_join(
        skewed, lookup, ["key"], how, null_safe, broadcast_rows=0, hot_rows=hot_rows
    )
    assert plain.columns == split.columns
    assert rows(plain) == rows(split)


def test_a_lookup_with_few_but_wide_rows_is_not_broadcast(spark, skewed, monkeypatch):
    from skyledger.operators import lookups

    wide = spark.createDataFrame([("hot", "x" * 5000)], "key string, value string")
    known = lookups.as_settled(wide)
    assert (known.rows, known.size) == (1, 5003)
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 4096)
    split = lookup_join(skewed, known, ["key"], hot_rows=100)
    assert "_salt" in split._jdf.queryExecution().optimizedPlan().toString()
    assert split.where("value is not null").count() == 1000


def test_nested_columns_count_with_their_bytes(spark):
    from skyledger.operators import lookups

    nested = spark.createDataFrame([("k", ["x" * 3000])], "key string, value array<string>")
    assert lookups.as_settled(nested).size > 3000


def test_other_joins_are_refused(skewed, lookup):
    with pytest.raises(ValueError, match="how"):
        lookup_join(skewed, lookup, ["key"], "full_outer")


def test_hot_keys_are_salted_and_the_large_side_is_read_once(skewed, lookup):
    large = settle(skewed, "large").frame
    split = lookup_join(large, lookup, ["key"], broadcast_rows=0, hot_rows=100)
    twice = lookup_join(split, lookup.withColumnRenamed("value", "v2"), ["key"], broadcast_rows=0, hot_rows=100)
    for joined in (split, twice):
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "_salt" in plan and "Union" not in plan
        assert plan.count("amount") and plan.count("Relation [id#") == 1
    # No task of the join holds the hot key: its rows are spread over as many salts as it needs.
    assert split.where("key = 'hot'").count() == 1000


def order():
    return [F.desc_nulls_last("amount"), F.asc_nulls_last("id")]


@pytest.mark.parametrize("group", [["key"], []])
def test_sliced_row_numbers(skewed, group):
    window = Window.partitionBy(*group).orderBy(*order())
    expected = skewed.withColumn("n", F.row_number().over(window))
    assert rows(with_row_number(skewed, group, order(), "n")) == rows(expected)
    assert rows(with_row_number(skewed, group, order(), "n", window_rows=0)) == rows(expected)


@pytest.mark.parametrize("group", [["key"], []])
def test_sliced_previous_values(skewed, group):
    window = Window.partitionBy(*group).orderBy(*order())
    gaps = skewed.withColumn("amount", F.when(F.col("id") % 7 != 0, F.col("amount")))
    expected = gaps.withColumn("before", F.lag("amount").over(window))
    assert rows(with_previous(gaps, group, order(), "amount", "before")) == rows(expected)
    sliced = with_previous(gaps, group, order(), "amount", "before", window_rows=0)
    assert rows(sliced) == rows(expected)


def test_a_hot_group_is_cut_into_several_slices(spark, skewed):
    from skyledger.operators import ordered

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = ordered._slices(skewed, ["key"], order())
        hot = sliced.where(F.col("key") == "hot").groupBy(ordered.SLICE).count().collect()
        assert len(hot) > 1 and max(r["count"] for r in hot) < 1000
        expected = skewed.withColumn(
            "n", F.row_number().over(Window.partitionBy("key").orderBy(*order()))
        )
        assert rows(with_row_number(skewed, ["key"], order(), "n", 0)) == rows(expected)
        lagged = skewed.withColumn(
            "b", F.lag("amount").over(Window.partitionBy("key").orderBy(*order()))
        )
        assert rows(with_previous(skewed, ["key"], order(), "amount", "b", 0)) == rows(lagged)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=40))
def test_any_small_input_is_numbered_right(spark, data):
    df = spark.createDataFrame(
        [(i, k, v) for i, (k, v) in enumerate(data)], "id int, key string, amount int"
    )
    found = {r.id: r.n for r in with_row_number(df, ["key"], order(), "n", window_rows=0).collect()}
    for key in {k for k, _ in data}:
        mine = sorted((-v, i) for i, (k, v) in enumerate(data) if k == key)
        assert [found[i] for _, i in mine] == list(range(1, len(mine) + 1))


def test_extending_a_dimension_keeps_its_keys(spark):
    first = spark.createDataFrame([("b",), ("d",), (None,)], "v string")
    dim = distinct_dimension(first, "v", "k", "name").frame
    assert rows(dim, "k") == [(1, "b"), (2, "d"), (3, None)]
    more = spark.createDataFrame([("c",), ("a",), ("b",), (None,)], "v string")
    for window_rows in (0, 1000):
        grown = extend_dimension(dim, more, "v", "k", "name", window_rows)
        assert rows(grown, "k") == [(1, "b"), (2, "d"), (3, None), (4, "a"), (5, "c")]
    again = extend_dimension(dim, first, "v", "k", "name")
    assert rows(again, "k") == rows(dim, "k")


def test_extending_an_empty_dimension(spark):
    empty = spark.createDataFrame([], "k bigint, name string")
    values = spark.createDataFrame([("x",)], "v string")
    assert rows(extend_dimension(empty, values, "v", "k", "name")) == [(1, "x")]
