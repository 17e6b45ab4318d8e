import pytest
from pyspark.sql import functions as F

from skyledger.operators.merging import last_per_key, open_history, snapshot, upsert
from tests.conftest import rows

SCHEMA = "id bigint, city string, status string, amount string"


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([(1, "a", "x", "1"), (2, "b", "x", None)], SCHEMA)
    new = spark.createDataFrame([(2, None, "y", "2"), (3, "c", "y", "3")], SCHEMA)
    expected = [(1, "a", "x", "1"), (2, None, "y", "2"), (3, "c", "y", "3")]
    once = upsert(old, new, "id")
    assert rows(once) == expected
    assert rows(upsert(once, new, "id")) == expected
    assert rows(upsert(old.where("false"), new, "id")) == [(2, None, "y", "2"), (3, "c", "y", "3")]


def test_the_last_row_of_a_key_counts(spark):
    batch = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", None)], "id int, v string, n int")
    assert rows(last_per_key(batch, "id", F.col("n"))) == [(1, "a", 2), (2, "c", None)]


def versions(df):
    return rows(df.select("id", "status", "amount", "valid_from", "valid_to"))


def test_history(spark):
    first = spark.createDataFrame(
        [(1, "a", "new", "1"), (2, "b", "new", None), (3, "c", "new", "3")], SCHEMA
    )
    history = open_history(first, 1)
    unchanged = snapshot(history, first, "id", ["status", "amount"], 2)
    assert versions(unchanged) == versions(history)

    # 1 changes, 2 gets an amount, 3 is gone, 4 is new; a change of city alone does not count.
    second = spark.createDataFrame(
        [(1, "a", "done", "1"), (2, "B", "new", "2"), (4, "d", "new", "4")], SCHEMA
    )
    later = snapshot(unchanged, second, "id", ["status", "amount"], 3)
    assert versions(later) == [
        (1, "done", "1", 3, None), (1, "new", "1", 1, 3),
        (2, "new", "2", 3, None), (2, "new", None, 1, 3),
        (3, "new", "3", 1, None), (4, "new", "4", 3, None),
    ]
    # Back to an old value is one more version; closed versions stay as they are.
    last = snapshot(later, first, "id", ["status", "amount"], 4)
    assert [v for v in versions(last) if v[0] == 1] == [
        (1, "done", "1", 3, 4), (1, "new", "1", 1, 3), (1, "new", "1", 4, None)
    ]
    current = last.where("valid_to is null")
    assert current.count() == current.select("id").distinct().count() == 4


def test_null_keys_are_refused_and_repeated_ones_reduced(spark):
    old = spark.createDataFrame([(1, "a", "x", "1")], SCHEMA)
    lacking = spark.createDataFrame([(None, "b", "y", "2")], SCHEMA)
    with pytest.raises(Exception, match="the key id is null"):
        upsert(old, lacking, "id")
    twice = spark.createDataFrame([(1, "a", "x", "1"), (1, "a", "y", "1")], SCHEMA)
    history = open_history(old, 1)
    looked = snapshot(history, twice, "id", ["status"], 2)
    assert versions(looked) == [(1, "x", "1", 1, 2), (1, "y", "1", 2, None)]
    with pytest.raises(Exception, match="the key id is null"):
        snapshot(history, lacking, "id", ["status"], 2).collect()


def test_a_small_batch_leaves_the_table_where_it_is(spark):
    old = spark.range(1000).select("id", F.lit("a").alias("v"))
    plan = upsert(old, old.where("id < 3"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
