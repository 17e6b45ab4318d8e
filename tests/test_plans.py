"""What the plans must and must not contain."""

import pytest

import __spark_entry__ as registered
from skyledger.plans import staging
from skyledger.sources import messy

QUERIES = registered.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["city_summary", "fact_orders", "vs_city_average", "running_total"])
def test_small_lookups_are_broadcast(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    orders = staging.stg_orders(messy.view(spark, sf_dir, messy.RAW_ORDERS))
    text = plan(orders.groupBy("order_status").count())
    assert "o_totalprice" not in text and "c_name" not in text and "o_orderpriority" not in text


def test_status_filter_reaches_the_scan(spark, tmp_path):
    stored = str(tmp_path / "t")
    spark.createDataFrame(
        [(1, "r", "c", 1.0, "delivered", "d")],
        "order_id long, restaurant_name string, city string, amount double, status string, order_date string",
    ).write.parquet(stored)
    text = plan(staging.stg_restaurant_orders(spark.read.parquet(stored)))
    assert "EqualTo(status,delivered)" in text
