"""The date and time dimensions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions import as_date_id, sunday_week, time_of_hour, weekend
from tallyhouse.functions.calendar import SUNDAY
from tallyhouse.schemas import DIM_DATE_END, DIM_DATE_START
from tallyhouse.sources.spines import date_bounds, date_spine, hour_spine


def dim_date(spine: DataFrame, weekend_days: Sequence[int] = (SUNDAY,)) -> DataFrame:
    """The ten calendar attributes of each `date` of a spine."""
    day = F.col("date")
    return spine.select(
        as_date_id(day).alias("date_id"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        sunday_week(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekend(day, weekend_days).alias("is_weekend"),
    )


def dim_date_between(
    spark: SparkSession, start: str = DIM_DATE_START, end: str = DIM_DATE_END,
    weekend_days: Sequence[int] = (SUNDAY,),
) -> DataFrame:
    """dim_date for all dates from start to end."""
    return dim_date(date_spine(date_bounds(spark, start, end)), weekend_days)


def dim_time(hours: DataFrame, column: str = "hour") -> DataFrame:
    """time_id and its `HH:00:00` text for the given hours."""
    return hour_spine(hours, column).select(
        "time_id", time_of_hour(F.col("time_id")).alias("time_creation")
    )
