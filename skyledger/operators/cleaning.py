"""Order cleaning, row validation and registry lookup."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, VariantType

from skyledger.functions.bands import above, above_or_false
from skyledger.functions.numbers import price, where_number
from skyledger.functions.text import not_blank, slug, sql_tidy, strip_lower
from skyledger.operators.lookups import lookup_join
from skyledger.operators.shared import Settled

HIGH_VALUE = 50
ORDER_KEYS = ("id", "city", "amount", "status")


def clean_orders(orders: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """Dataframe rules: every whitespace trimmed; NaN, and digits too large for a double, are missing."""
    if isinstance(orders.schema["amount"].dataType, StringType):
        named = F.col("amount").rlike("(?i)inf")
        too_large = (F.abs(F.col("amount").try_cast("double")) == float("inf")) & ~named
        orders = orders.where(~F.coalesce(too_large, F.lit(False)))
    return (
        where_number(orders, "amount")
        .where(~F.isnan("amount"))
        .withColumn("city", strip_lower("city"))
        .where(F.col("city") != "")
        .withColumn("is_high_value", above("amount", threshold))
    )


def clean_orders_sql(orders: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """SQL rules: only spaces trimmed, NaN is a value."""
    return (
        where_number(orders.where(not_blank("city")), "amount")
        .select("id", sql_tidy("city").alias("city"), "amount", "status")
        .withColumn("is_high_value", above_or_false("amount", threshold))
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def lacks_required(
    df: DataFrame, required: Sequence[str], skip_null_amount: bool = True
) -> Column:
    """True where a required field is null; an absent column is null on every row."""
    names = [*required, "amount"] if skip_null_amount else list(required)
    tests = [F.col(n).isNull() if n in df.columns else F.lit(True) for n in names]
    return reduce(or_, tests, F.lit(False))


def label_valid(
    df: DataFrame, required: Sequence[str] = ORDER_KEYS, skip_null_amount: bool = True
) -> DataFrame:
    return df.withColumn("is_valid", ~lacks_required(df, required, skip_null_amount))


def judge_orders(
    orders: DataFrame, required: Sequence[str] = ORDER_KEYS, missing_keys: str | None = None
) -> DataFrame:
    """Add the parsed price, the city slug and a reason for each row that cannot be kept.

    `missing_keys` may name an array column with the keys absent from the source record; without
    it only columns missing from the whole frame count as absent.
    """
    absent = missing_columns(orders, required)
    if absent:
        reason = F.lit("Missing required keys: " + ", ".join(absent))
        return orders.withColumns(
            {"_price": F.lit(None).cast("double"), "_slug": F.lit(None).cast("string"), "reason": reason}
        )
    keys = F.array_sort(missing_keys) if missing_keys else F.array().cast("array<string>")
    parsed = price(orders, "amount")
    return orders.withColumns({"_price": parsed, "_slug": slug("city")}).withColumn(
        "reason",
        F.when(F.size(keys) > 0, F.concat(F.lit("Missing required keys: "), F.array_join(keys, ", ")))
        .when(F.coalesce("_price", F.lit(0.0)) == 0, F.lit("No usable amount"))
        .when(F.col("city").isNull(), F.lit("No city")),
    )


def process_orders(
    orders: DataFrame, required: Sequence[str] = ORDER_KEYS, missing_keys: str | None = None
) -> DataFrame:
    """Rows that pass, with the amount parsed and the city as a slug; other columns kept."""
    judged = judge_orders(orders, required, missing_keys).where(F.col("reason").isNull())
    tidy = {"city": F.col("_slug"), "amount": F.col("_price")}
    return judged.withColumns(tidy).drop("_slug", "_price", "reason", *_extra(missing_keys))


def rejected_orders(
    orders: DataFrame, required: Sequence[str] = ORDER_KEYS, missing_keys: str | None = None
) -> DataFrame:
    judged = judge_orders(orders, required, missing_keys).where(F.col("reason").isNotNull())
    return judged.drop("_slug", "_price", *_extra(missing_keys))


def split_processed(
    orders: DataFrame, required: Sequence[str] = ORDER_KEYS, missing_keys: str | None = None
) -> DataFrame:
    """All rows, judged once: `is_valid`, with tidy city and amount where it is true, and else the
    reason, the city as it came and the amount as it came in `raw_amount`."""
    judged = judge_orders(orders, required, missing_keys)
    good = F.col("reason").isNull()
    came = F.col("amount") if "amount" in orders.columns else F.lit(None)
    if "amount" in orders.columns and isinstance(orders.schema["amount"].dataType, VariantType):
        came = F.try_variant_get("amount", "$", "string")
    city = F.col("city") if "city" in orders.columns else F.lit(None)
    tidy = {
        "raw_amount": F.when(~good, came.cast("string")),
        "city": F.when(good, F.col("_slug")).otherwise(city.cast("string")),
        "amount": F.when(good, F.col("_price")),
        "is_valid": good,
    }
    return judged.withColumns(tidy).drop("_slug", "_price", *_extra(missing_keys))


def _extra(name: str | None) -> list[str]:
    return [name] if name else []


def normalize_list(c: str | Column, rule: Callable[[Column], Column]) -> Column:
    """Apply a column rule to each element of an array column."""
    return F.transform(c, rule)


def resolve_cities(
    requested: DataFrame, registry: DataFrame | Settled, name: str = "city", **limits: int
) -> DataFrame:
    """Requested cities found in the registry, in lower case, each request kept."""
    return lookup_join(
        requested.withColumn("name", F.lower(name)), registry, ["name"], "inner", **limits
    )


def unknown_cities(
    requested: DataFrame, registry: DataFrame | Settled, name: str = "city", **limits: int
) -> DataFrame:
    lowered = requested.withColumn("name", F.lower(name))
    return lookup_join(lowered, registry, ["name"], "left_anti", **limits).drop("name")
