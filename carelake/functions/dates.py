"""Dates, periods and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.casting import to_int


# Eight digits naming a day its month can have. The text is then cast as an ISO
# date, which needs no formatter; only 29 February of a common year is left for
# the failing path of the cast, which is slow.
_D28, _D30, _D31 = "(0[1-9]|[12][0-9])", "(0[1-9]|[12][0-9]|30)", "(0[1-9]|[12][0-9]|3[01])"
_M31, _M30 = "(0[13578]|1[02])", "(0[469]|11)"
_YMD = f"^[0-9]{{4}}({_M31}{_D31}|{_M30}{_D30}|02{_D28})$"
_DMY = f"^({_D31}{_M31}|{_D30}{_M30}|{_D28}02)[0-9]{{4}}$"


def _iso(c: Column, year: int, month: int, day: int) -> Column:
    return F.concat_ws(
        "-", F.substring(c, year, 4), F.substring(c, month, 2), F.substring(c, day, 2)
    ).try_cast("date")


def parse_ymd(c: Column) -> Column:
    return F.when(c.rlike(_YMD), _iso(c, 1, 5, 7))


def parse_dmy(c: Column) -> Column:
    return F.when(c.rlike(_DMY), _iso(c, 5, 3, 1))


def period_date(year: Column, month: Column) -> Column:
    """First day of the period; NULL, not an error, for a month outside 1-12."""
    return F.when(
        month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1))
    )


def period_year(yyyymm: Column) -> Column:
    return to_int(F.substring(yyyymm.cast("string"), 1, 4))


def period_month(yyyymm: Column) -> Column:
    return to_int(F.substring(yyyymm.cast("string"), 5, 2))


# Notification weeks are YYYYWW and restart each year; they are not ISO weeks.
def epi_year(yyyyww: Column) -> Column:
    return period_year(yyyyww)


def epi_week(yyyyww: Column) -> Column:
    return period_month(yyyyww)


def stay_days(entry: Column, leave: Column) -> Column:
    return F.datediff(leave, entry)


def dow_sunday0(c: Column) -> Column:
    return F.dayofweek(c) - 1
