"""Number and date functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def minutes_to_hours(c: Column) -> Column:
    return c / 60


def clamp_negative(c: Column) -> Column:
    """Negative to 0; a missing value stays missing."""
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def scale_where(c: Column, condition: Column, factor: float) -> Column:
    return F.when(condition, c * factor).otherwise(c)


def to_number(c: Column, kind: str = "double") -> Column:
    """The number in a text, NULL where it is none."""
    return c.try_cast(kind)


def key_text(c: Column) -> Column:
    """Whole number as text without ".0", for use as a key."""
    return c.cast("bigint").cast("string")


def add_days_where(date: Column, condition: Column, days: int) -> Column:
    return F.when(condition, F.date_add(date, days)).otherwise(date)


def weeks_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start) / 7


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def academic_year(year: Column) -> Column:
    """2021 to "2021-2022"."""
    year = year.cast("int")
    return F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string"))
