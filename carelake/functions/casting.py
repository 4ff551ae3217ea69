"""Text to number, with the reading rules of the source files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes are checked before each cast. A failed cast raises and swallows an
# exception per row, which costs far more than the check; and Java would read a
# trailing d or f as a type suffix ("1d" = 1.0).
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def to_double(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.rlike(_NUMBER) | text.rlike(_SPECIAL), text.try_cast("double"))


def _to_integral(c: Column, kind: str) -> Column:
    """Integers as they are; '12.5' rounds to 13 and '4e2' reads as 400."""
    text = c.cast("string")
    return F.when(text.rlike(_INTEGER), text.try_cast(kind)).when(
        text.rlike(_NUMBER), F.round(text.try_cast("double")).try_cast(kind)
    )


def to_int(c: Column) -> Column:
    return _to_integral(c, "int")


def to_long(c: Column) -> Column:
    return _to_integral(c, "bigint")


def br_number(c: Column) -> Column:
    """'62.448' -> 62448, '4,69' -> 4.69, blank -> 0, anything else NULL."""
    plain = F.replace(F.replace(F.trim(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(plain == "", F.lit(0.0)).otherwise(to_double(plain))


def decimal_comma(c: Column) -> Column:
    return F.trim(F.replace(c, F.lit(","), F.lit(".")))


def money_sum(c: Column) -> Column:
    """Exact sum of a money column: does not depend on row order."""
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def money_avg(c: Column) -> Column:
    """Exact mean over the known values; NULL when there are none."""
    return F.try_divide(money_sum(c), F.count(c))
