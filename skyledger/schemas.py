"""Declared schemas. Readers never infer types: raw text stays text until staging."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
FLAG, DATE = T.BooleanType(), T.DateType()


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ORDERS_RAW = schema(id=TEXT, city=TEXT, amount=TEXT, status=TEXT)
ORDERS = schema(
    id=LONG,
    city=TEXT,
    amount=DOUBLE,
    status=TEXT,
    is_high_value=FLAG,
)
# In JSON an amount may be a number or a text, and the two are cleaned differently.
# Ids are kept as they come, numbers as their text.
ORDERS_JSON = schema(id=TEXT, city=TEXT, amount=T.VariantType(), status=TEXT)

READINGS = schema(city=TEXT, time=TEXT, temperature_c=DOUBLE)
WEATHER_SUMMARY = schema(
    city=TEXT,
    avg_temp=DOUBLE,
    max_temp=DOUBLE,
    min_temp=DOUBLE,
    record_count=LONG,
)
PAYLOAD = schema(
    city=TEXT,
    hourly=schema(time=T.ArrayType(TEXT), temperature_2m=T.ArrayType(DOUBLE)),
)

DELIVERIES = schema(
    id=LONG,
    city=TEXT,
    status=TEXT,
    amount=TEXT,
    order_date=TEXT,
)
RESTAURANT_ORDERS = schema(
    order_id=LONG,
    restaurant_name=TEXT,
    city=TEXT,
    amount=DOUBLE,
    status=TEXT,
    order_date=TEXT,
)
RAW_ORDERS = schema(
    order_id=TEXT,
    customer_city=TEXT,
    restaurant_name=TEXT,
    restaurant_category=TEXT,
    order_total=TEXT,
    delivery_fee=TEXT,
    order_status=TEXT,
    ordered_at=TEXT,
)
CITY_REGISTRY = schema(name=TEXT, lat=DOUBLE, lon=DOUBLE)

DIM_DATE = schema(
    date_key=INT,
    date=DATE,
    day_of_week=TEXT,
    week_number=INT,
    month_name=TEXT,
    quarter=INT,
    year=INT,
    is_weekend=FLAG,
)
DIM_CITY = schema(city_key=LONG, city_name=TEXT)
DIM_STATUS = schema(status_key=LONG, status_name=TEXT)
FACT_ORDERS = schema(
    order_key=LONG,
    date_key=INT,
    city_key=LONG,
    status_key=LONG,
    amount=DOUBLE,
    is_high_value=FLAG,
)

DIM_CUSTOMERS = schema(customer_id=LONG, name=TEXT, email=TEXT)
DIM_PRODUCTS = schema(product_id=LONG, name=TEXT, category=TEXT, unit_price=DOUBLE)
DIM_CITIES = schema(city_id=LONG, city_name=TEXT, region=TEXT)

MART_CITY_SUMMARY = schema(
    city=TEXT,
    total_orders=LONG,
    total_revenue=DOUBLE,
    avg_order_value=DOUBLE,
    delivered_count=LONG,
    avg_temp=DOUBLE,
    avg_revenue_per_degree=DOUBLE,
)
MART_RESTAURANT_DAILY = schema(
    order_date=TEXT,
    restaurant_name=TEXT,
    total_orders=LONG,
    total_revenue=DOUBLE,
    avg_order_value=DOUBLE,
    revenue_tier=TEXT,
)
