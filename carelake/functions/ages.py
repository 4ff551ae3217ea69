"""Unit-coded ages and age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.casting import to_int


def decode_admission_age(value: Column, unit: Column) -> Column:
    """Unit 4 is years, 5 is years past 100; shorter units count as age 0."""
    years = to_int(value)
    return (
        F.when(unit == "4", years)
        .when(unit == "5", F.try_add(years, F.lit(100)))
        .otherwise(F.lit(0))
    )


def decode_packed_age(packed: Column) -> Column:
    """Unit digit followed by the value, as in death and notification records."""
    text = packed.cast("string")
    unit = F.substring(text, 1, 1)
    years = to_int(F.substr(text, F.lit(2)))
    return (
        F.when(text.isNull() | (F.length(text) < 2), F.lit(None).cast("int"))
        .when(unit == "4", years)
        .when(unit == "5", F.try_add(years, F.lit(100)))
        .otherwise(F.lit(0))
    )


# (upper bound, label); an unknown age falls through to the last band.
_BANDS = ((1, "<1"), (15, "1-14"), (30, "15-29"), (45, "30-44"), (60, "45-59"), (75, "60-74"))
_BANDS8 = (
    (1, "0 <1ano"),
    (15, "1 1-14"),
    (30, "2 15-29"),
    (45, "3 30-44"),
    (60, "4 45-59"),
    (75, "5 60-74"),
    (90, "6 75-89"),
)


def _banded(age: Column, bands, last: str, strict: bool) -> Column:
    out = F.when(age.isNull(), F.lit(None).cast("string")) if strict else F
    for upper, label in bands:
        out = out.when(age < upper, label)
    return out.otherwise(last)


def age_band(age: Column, strict: bool = False) -> Column:
    """Seven bands; strict=True leaves an unknown age NULL instead of '75+'."""
    return _banded(age, _BANDS, "75+", strict)


def age_band8(age: Column, strict: bool = False) -> Column:
    return _banded(age, _BANDS8, "7 90+", strict)


def age_from_dates(birth: Column, at: Column) -> Column:
    return (F.datediff(at, birth) / F.lit(365.25)).cast("int")
