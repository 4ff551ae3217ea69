"""Ratios; the denominators differ on purpose between outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 when true; 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def guarded_ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """num * scale / den as double, NULL unless the denominator is positive."""
    return F.when(den > 0, num.cast("double") * F.lit(float(scale)) / den.cast("double"))


def percent(num: Column, den: Column) -> Column:
    return guarded_ratio(num, den, 100.0)


def stored_percent(num: Column, den: Column, scale: float = 100.0) -> Column:
    """The stored-column form: 0, not NULL, when there is no denominator."""
    return F.coalesce(guarded_ratio(num, den, scale), F.lit(0.0))
