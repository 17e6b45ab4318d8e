"""Text clean-up.

Two trims are needed. Jobs that follow SQL rules drop only space separators; jobs that follow
dataframe rules drop every kind of whitespace, tabs and newlines included.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# All of these lie in the basic plane. SQL TRIM removes the space separators, dataframe rules
# every whitespace character.
BASIC_PLANE = [chr(code) for code in range(0x10000)]
SPACE_SEPARATORS = "".join(c for c in BASIC_PLANE if unicodedata.category(c) == "Zs")
WHITESPACE = "".join(c for c in BASIC_PLANE if c.isspace())


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_trim(c: str | Column) -> Column:
    """Drop space separators at both ends; ASCII text, which has but one, takes the fast trim."""
    spaces_gone = F.trim(col(c))
    is_ascii = F.length(spaces_gone) == F.octet_length(spaces_gone)
    return F.when(is_ascii, spaces_gone).otherwise(F.trim(spaces_gone, F.lit(SPACE_SEPARATORS)))


def sql_tidy(c: str | Column) -> Column:
    return sql_trim(F.lower(col(c)))


def not_blank(c: str | Column) -> Column:
    """Has something other than space separators; one trim, as filters do not share terms."""
    return F.trim(col(c), F.lit(SPACE_SEPARATORS)) != ""


def strip(c: str | Column) -> Column:
    return F.trim(col(c), F.lit(WHITESPACE))


def strip_lower(c: str | Column) -> Column:
    return F.lower(strip(c))


def blank_to_null(c: str | Column) -> Column:
    """Keep the text untouched unless it is empty or only whitespace."""
    return F.when(strip(c) != "", col(c))


def slug(c: str | Column) -> Column:
    return F.replace(strip_lower(c), F.lit(" "), F.lit("_"))
