"""Words of a text as column expressions; a word is a run without space, tab or line end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_OTHER_SPACE = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Array of words; null text has none."""
    line = F.trim(F.translate(F.coalesce(text, F.lit("")), _OTHER_SPACE, " " * len(_OTHER_SPACE)))
    none = F.array().cast("array<string>")
    return F.when(line == "", none).otherwise(F.split(line, " +"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def without_space(text: Column) -> Column:
    return without(text, " " + _OTHER_SPACE)


def hashed_runs(array: str, length: int) -> Column:
    """A hash of each run of `length` neighbouring elements; the array must be a column."""
    element = lambda i, k: F.get(F.col(array), i + k)
    runs = F.transform(
        F.sequence(F.lit(0), F.size(array) - length),
        lambda i: F.xxhash64(*[element(i, k) for k in range(length)]),
    )
    return F.when(F.size(array) >= length, runs).otherwise(F.array().cast("array<bigint>"))
