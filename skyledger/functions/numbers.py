"""Text to number, and rounding with the tie rules of each job family."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.text import col

# Fixed patterns. The first two say which texts count as numbers: Spark alone would also take
# forms such as 1d, 1f and 0x1p3. The third finds a price, in the digits of any script; a sign
# counts only before a decimal.
DECIMAL_TEXT = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf|infinity)\s*$"
WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"
PRICE_TEXT = r"(?U)[-+]?\d*\.\d+|\d+"

# Decimal digits of every script in the basic plane, and the ASCII digit of each.
DIGITS = "".join(chr(c) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Nd")
ASCII_DIGITS = "".join(str(unicodedata.decimal(d)) for d in DIGITS)


def is_number(c: str | Column) -> Column:
    return F.coalesce(col(c).rlike(DECIMAL_TEXT), F.lit(False))


def to_double(c: str | Column) -> Column:
    return F.when(is_number(c), _parsed(c))


def _parsed(c: str | Column) -> Column:
    """Double of a text that is a number; a NaN with a sign is the one Spark does not read."""
    return F.coalesce(col(c).try_cast("double"), F.lit(float("nan")))


def to_whole(c: str | Column) -> Column:
    """Whole number from text; a fraction is rounded half away from zero, as SQL casts do."""
    c = col(c)
    return F.when(c.rlike(WHOLE_TEXT), c.try_cast("bigint")).otherwise(
        F.round(to_double(c)).try_cast("bigint")
    )


def number(df: DataFrame, name: str) -> Column:
    """A column as double: parsed when it is text, a plain cast when it is already numeric."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_double(name)
    return F.col(name).cast("double")


def where_number(df: DataFrame, name: str) -> DataFrame:
    """Rows whose column is a number, with the column as double.

    The text is tested once, in the filter; parsing it first would test it again in the filter
    that Spark pushes below the parsing.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return df.where(is_number(name)).withColumn(name, _parsed(name))
    return df.where(F.col(name).isNotNull()).withColumn(name, F.col(name).cast("double"))


def price(df: DataFrame, name: str) -> Column:
    """First price-like number in a text; numbers pass through.

    A variant column, as read from JSON, decides row by row: it may hold either.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.VariantType):
        held = F.schema_of_variant(name)
        text = F.try_variant_get(name, "$", "string")
        amount = F.try_variant_get(name, "$", "double")
        is_number = held.isin("BIGINT", "DOUBLE", "BOOLEAN") | held.startswith("DECIMAL")
        return F.when(held == "STRING", price_text(text)).when(is_number, amount)
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    return price_text(name)


def price_text(c: str | Column) -> Column:
    found = F.regexp_extract(F.replace(col(c), F.lit(","), F.lit("")), PRICE_TEXT, 0)
    return F.translate(found, DIGITS, ASCII_DIGITS).try_cast("double")


def round_sql(c: Column, digits: int) -> Column:
    """Half away from zero, decided on the binary value (1.005 to 2 digits is 1.0)."""
    scale = float(10**digits)
    return F.round(c * scale) / scale


def round_even(c: Column, digits: int) -> Column:
    """Half to even on the scaled binary value, the dataframe rule (0.25 to 1 digit is 0.2)."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def cents_to_dollars(c: str | Column) -> Column:
    return round_sql(col(c) / 100.0, 2)
