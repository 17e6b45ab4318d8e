"""Hand-checked results on the small samples."""

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.functions.dates import day_series
from skyledger.plans import analytics, marts, star
from skyledger.operators.cleaning import clean_orders, clean_orders_sql
from tests.conftest import rows

# Own sample: a tie for the highest amount, two orders on one day, a missing amount, no city.
ORDERS = [
    (1, "oslo", "delivered", 40.0, "2025-03-01"),
    (2, "oslo", "delivered", 40.0, "2025-03-02"),
    (3, "oslo", "cancelled", 10.0, "2025-03-04"),
    (4, "lisbon", "delivered", 12.5, "2025-03-01"),
    (5, "lisbon", "delivered", 99.5, "2025-03-01"),
    (6, "quito", "cancelled", 70.0, "2025-03-02"),
    (7, "quito", "delivered", None, "2025-03-03"),
    (8, None, "delivered", 5.0, "2025-03-02"),
    (9, None, "cancelled", 7.0, "2025-03-04"),
]


@pytest.fixture(scope="module")
def deliveries(spark):
    columns = "id bigint, city string, status string, amount double, d string"
    df = spark.createDataFrame(ORDERS, columns)
    return df.select("id", "city", "status", "amount", F.col("d").cast("date").alias("order_date"))


def per_city(df, column, *order):
    found = {}
    for r in df.orderBy(*order).collect():
        found.setdefault(r["city"], []).append(r[column])
    return found


def test_rank(deliveries):
    found = per_city(analytics.rank_in_city(deliveries), "id", "rank_in_city")
    assert found == {"oslo": [1, 2, 3], "lisbon": [5, 4], "quito": [6, 7], None: [9, 8]}


def test_running_total(deliveries):
    found = per_city(analytics.running_total(deliveries), "running_total", "id")
    assert found == {
        "oslo": [40.0, 80.0, 90.0], "lisbon": [112.0, 112.0], "quito": [70.0, 70.0],
        None: [5.0, 12.0],
    }


def test_average_and_difference(deliveries):
    df = analytics.vs_city_average(deliveries)
    assert per_city(df, "city_avg", "id")["lisbon"] == [56.0, 56.0]
    assert per_city(df, "diff_from_avg", "id") == {
        "oslo": [10.0, 10.0, -20.0], "lisbon": [-43.5, 43.5], "quito": [0.0, None],
        None: [-1.0, 1.0],
    }


def test_day_change(deliveries):
    found = per_city(analytics.day_change(deliveries), "day_change", "order_date", "id")
    assert found == {
        "oslo": [None, 0.0, -30.0], "lisbon": [None, 87.0], "quito": [None, None],
        None: [None, 2.0],
    }


def test_top_order(deliveries):
    ids = rows(analytics.top_order(deliveries).select("id"), "id")
    assert ids == [(1,), (2,), (5,), (6,), (9,)]
    assert rows(analytics.top_vs_average(deliveries), "city") == [
        (None, 7.0, None, None), ("lisbon", 99.5, 56.0, 43.5),
        ("oslo", 40.0, 30.0, 10.0), ("oslo", 40.0, 30.0, 10.0), ("quito", 70.0, 70.0, 0.0),
    ]


def test_delivered_revenue(deliveries):
    assert rows(analytics.delivered_revenue(deliveries), "city") == [
        (None, 5.0, False), ("lisbon", 112.0, True), ("oslo", 80.0, False), ("quito", None, None),
    ]


def test_above_average(deliveries):
    ids = [(1,), (2,), (5,)]
    assert rows(analytics.above_city_average(deliveries).select("id"), "id") == ids
    assert rows(analytics.above_city_average_rows(deliveries).select("id"), "id") == ids


def test_daily_totals(spark, deliveries):
    own = [r.total_amount for r in analytics.daily_totals(deliveries).collect()]
    assert own == [152.0, 115.0, 0.0, 17.0]
    days = day_series(spark, "2025-02-28", "2025-03-05")
    found = [r.total_amount for r in analytics.daily_totals(deliveries, days).collect()]
    assert found == [0.0, *own, 0.0]


def test_star(deliveries):
    text = deliveries.withColumns(
        {"amount": F.col("amount").cast("string"), "order_date": F.col("order_date").cast("string")}
    )
    built = star.build_star(text)
    # Only the fourth of March is a weekday with amounts.
    assert [tuple(r) for r in star.star_weekday(built).collect()] == [
        ("oslo", "cancelled", 10.0, 10.0, 1), (None, "cancelled", 7.0, 7.0, 1)
    ]
    wide = star.wide_orders(built)
    assert wide.count() == 8
    assert rows(star.delivered_wide(wide)) == rows(star.delivered_normalized(built))
    assert [r.city_name for r in built.cities.frame.orderBy("city_key").collect()] == [
        "lisbon", "oslo", "quito", None
    ]


def test_file_orders_with_weather(spark):
    orders = spark.createDataFrame(
        [("a1", " Oslo ", "12.5", "sent"), ("a2", "LISBON", "-nan", "sent"),
         ("a3", "oslo", None, "lost"), ("a4", "\t", "9", "sent"),
         ("a5", "Bergen", "+51", "sent"), ("a6", "oslo", "1e999", "sent"),
         ("a7", "oslo", "inf", "sent")],
        schemas.ORDERS_RAW,
    )
    weather = spark.createDataFrame(
        [("oslo", 4.5, 9.0, -1.0, 12), ("lisbon", 15.0, 15.0, 15.0, 1)], schemas.WEATHER_SUMMARY
    )
    assert rows(marts.enrich_orders(clean_orders(orders), weather).select(
        "id", "city", "amount", "status", "is_high_value", "avg_temp", "record_count"
    ), "id") == [
        ("a1", "oslo", 12.5, "sent", False, 4.5, 12),
        ("a5", "bergen", 51.0, "sent", True, None, None),
        ("a7", "oslo", float("inf"), "sent", True, 4.5, 12),
    ]


def test_nan_amount_is_missing_only_by_dataframe_rules(spark):
    orders = spark.createDataFrame([("1", "a", "nan", "x"), ("2", "\t", "1", "x"), ("3", "a", "-NaN", "x")], schemas.ORDERS_RAW)
    assert clean_orders(orders).count() == 0
    assert [str(r.amount) for r in clean_orders_sql(orders).orderBy("id").collect()] == ["nan", "1.0", "nan"]
