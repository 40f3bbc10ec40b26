"""Calendar expressions."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

SUNDAY = 6  # Spark's weekday(): Monday is 0


def as_date_id(day: Column) -> Column:
    """Date as the integer yyyyMMdd."""
    return (F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def month_key(day: Column) -> Column:
    """`yyyy-MM` of a date."""
    return F.substring(day.cast("string"), 1, 7)


def sunday_week(day: Column) -> Column:
    """Week of the year with weeks starting on Sunday; days before the first
    Sunday are in week 0 (`%U`, not the ISO week)."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def weekend(day: Column, weekend_days: Sequence[int] = (SUNDAY,)) -> Column:
    """Whether the weekday (Monday 0 … Sunday 6) is a weekend day. Only Sunday
    counts by default; pass (5, 6) for Saturday and Sunday."""
    return F.weekday(day).isin(*weekend_days)


def time_of_hour(hour: Column) -> Column:
    return F.format_string("%02d:00:00", hour)


def calendar_day(year: Column, month: Column, day: Column) -> Column:
    """Date from its three numbers, NULL when there is no such date."""
    return F.try_to_date(F.format_string("%04d%02d%02d", year, month, day), "yyyyMMdd")
