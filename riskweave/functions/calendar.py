"""Quarters, seasons and other calendar arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_start(year: Column, quarter: Column) -> Column:
    return F.make_date(year, quarter * 3 - 2, F.lit(1))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.date_sub(F.add_months(quarter_start(year, quarter), 3), 1)


def ordinal(year: Column, quarter: Column) -> Column:
    """Quarters counted without gaps, so that they can be compared and subtracted."""
    return year * 4 + quarter - 1


def from_ordinal(n: Column) -> tuple[Column, Column]:
    return F.floor(n / 4).cast("int"), (n % 4 + 1).cast("int")


def last_complete_quarter(today: Column) -> Column:
    """The ordinal of the last quarter that ended before ``today``."""
    return ordinal(F.year(today), F.quarter(today)) - 1


def month_of_decimal_year(t: Column) -> Column:
    return F.greatest(F.ceil((t - F.floor(t)) * 12), F.lit(1)).cast("int")


def in_season(day: Column, first: tuple[int, int], last: tuple[int, int]) -> Column:
    """True between two (month, day) pairs; a season may run over the new year."""
    at, a, b = F.month(day) * 100 + F.day(day), first[0] * 100 + first[1], last[0] * 100 + last[1]
    return at.between(a, b) if a <= b else (at >= a) | (at <= b)


def day_key(day: Column) -> Column:
    """Month and day as MM_DD."""
    return F.date_format(day, "MM_dd")


def nearest_minutes(time: Column, minutes: int = 10) -> Column:
    """A time rounded to whole steps of minutes; half a step goes up."""
    step = minutes * 60_000_000
    return F.timestamp_micros(F.floor((F.unix_micros(time) + step // 2) / step) * step)


def quarter_name(day: Column) -> Column:
    """The quarter of a day, such as 2021Q3."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def quarter_days(name: Column) -> Column:
    """All days of a quarter that is named as by ``quarter_name``."""
    first = F.make_date(F.substring(name, 1, 4).cast("int"), F.substring(name, 6, 1).cast("int") * 3 - 2, F.lit(1))
    return F.sequence(first, F.date_sub(F.add_months(first, 3), 1))


def in_quarters(day: Column, first: Column, last: Column) -> Column:
    """True for a day from the first to the last of two named quarters; names sort as their times do."""
    return quarter_name(day).between(first, last)
