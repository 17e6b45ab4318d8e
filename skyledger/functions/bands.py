"""Threshold flags and three-band labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.text import col


def above(c: str | Column, threshold: float) -> Column:
    """Strictly above; null stays null."""
    return col(c) > F.lit(threshold)


def above_or_false(c: str | Column, threshold: float) -> Column:
    """Strictly above; null counts as not above."""
    return F.coalesce(above(c, threshold), F.lit(False))


def band(c: str | Column, high: float, low: float, labels: tuple[str, str, str]) -> Column:
    """Label by inclusive lower bounds; null falls into the lowest band."""
    top, middle, bottom = labels
    return F.when(col(c) >= high, top).when(col(c) >= low, middle).otherwise(bottom)


def order_tier(c: str | Column, high: float = 100, low: float = 50) -> Column:
    return band(c, high, low, ("high", "medium", "low"))


def revenue_tier(c: str | Column, high: float, low: float) -> Column:
    return band(c, high, low, ("high", "med", "low"))
