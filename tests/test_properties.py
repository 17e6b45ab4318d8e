"""Things that must hold between jobs."""

import pytest
from pyspark.sql import functions as F

from skyledger.operators.cleaning import label_valid, process_orders, rejected_orders
from skyledger.plans import analytics, marts, staging, star
from skyledger.plans.weather import weather_summary
from skyledger.sources import messy
from tests.conftest import rows


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return messy.view(spark, sf_dir, messy.DELIVERIES).cache()


@pytest.fixture(scope="module")
def typed(spark, sf_dir):
    return messy.view(spark, sf_dir, messy.DELIVERIES_TYPED).cache()


def test_no_row_is_lost_by_a_split(raw):
    assert process_orders(raw).count() + rejected_orders(raw).count() == raw.count()
    labelled = label_valid(raw)
    assert labelled.where("is_valid").count() + labelled.where("not is_valid").count() == raw.count()


def test_city_totals_add_up(spark, sf_dir, raw):
    staged = staging.stg_deliveries(raw)
    weather = weather_summary(messy.view(spark, sf_dir, messy.WEATHER))
    summary = marts.mart_city_summary(marts.int_orders_enriched(staged, weather))
    found = summary.agg(F.sum("total_orders"), F.round(F.sum("total_revenue"), 2)).first()
    assert tuple(found) == tuple(staged.agg(F.count("*"), F.round(F.sum("amount"), 2)).first())


def test_daily_totals_add_up(typed):
    days = analytics.daily_totals(typed).agg(F.round(F.sum("total_amount"), 2)).first()[0]
    assert days == typed.agg(F.round(F.sum("amount"), 2)).first()[0]


def test_both_forms_of_above_average_agree(typed):
    columns = ["id", "city", "amount", "status"]
    assert rows(analytics.above_city_average(typed).select(*columns)) == rows(
        analytics.above_city_average_rows(typed)
    )


def test_star_and_wide_view_agree(spark, sf_dir):
    built = star.build_star(messy.view(spark, sf_dir, messy.DELIVERIES_TIDY))
    assert rows(star.delivered_normalized(built)) == rows(star.delivered_wide(star.wide_orders(built)))


def test_an_estimate_of_distinct_restaurants_is_close(spark, sf_dir):
    orders = staging.stg_orders(messy.view(spark, sf_dir, messy.RAW_ORDERS))
    exact = {r.customer_city: r.unique_restaurants for r in marts.mart_city_orders(orders).collect()}
    estimate = marts.mart_city_orders(orders, F.approx_count_distinct("restaurant_name", 0.01))
    for row in estimate.collect():
        assert abs(row.unique_restaurants - exact[row.customer_city]) <= 1
