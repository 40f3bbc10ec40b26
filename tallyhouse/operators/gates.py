"""Completeness gates: days with their 24 dumps, months with all their days."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import days_in_month, month_key
from tallyhouse.operators.parse import dumps_of
from tallyhouse.schemas import HOURS_PER_DAY


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def complete_days(files: DataFrame) -> DataFrame:
    """Dates (`file_date`) with exactly the 24 dumps of a day.

    `files` has a file_name per dump; repeats do not matter. The hours seen are
    OR-ed into one bitmap per date, which is a single aggregate with one small
    row per date and task, where a distinct count would shuffle twice.
    """
    hour = F.substring("file_time", 1, 2).cast("int")
    on_the_hour = F.col("file_time").endswith("0000") & (hour < HOURS_PER_DAY)
    seen = F.bit_or(F.when(on_the_hour, _bit(hour)))
    return (
        dumps_of(files).groupBy("file_date")
        .agg(F.bit_count(seen).alias("hours"), F.count("*").alias("files"))
        .where((F.col("hours") == HOURS_PER_DAY) & (F.col("files") == HOURS_PER_DAY))
        .select("file_date")
    )


def complete_months(days: DataFrame) -> DataFrame:
    """Months (`file_month`, yyyy-MM) of which every date is in `days.file_date`."""
    day = F.col("file_date")
    seen = F.bit_or(_bit(F.dayofmonth(day)))
    return (
        days.where(day.isNotNull())
        .groupBy(F.trunc(day, "month").alias("first_day"))
        .agg(F.bit_count(seen).alias("days"))
        .where(F.col("days") == days_in_month(F.col("first_day")))
        .select(month_key(F.col("first_day")).alias("file_month"))
    )


# The gates broadcast at most one small row per calendar day or month of the
# four-digit years a file name can hold: 3.7 million at the very worst, a few
# thousand for decades of dumps. The gated side is never shuffled.

def gate_days(rows: DataFrame, complete: DataFrame) -> DataFrame:
    """Rows whose file_date is complete."""
    return rows.join(F.broadcast(complete.select("file_date")), "file_date", "left_semi")


def gate_months(rows: DataFrame, complete: DataFrame) -> DataFrame:
    """Rows whose file_month is complete; adds file_month from file_date if absent."""
    if "file_month" not in rows.columns:
        rows = rows.withColumn("file_month", month_key(F.col("file_date")))
    return rows.join(F.broadcast(complete.select("file_month")), "file_month", "left_semi")


def hour_violations(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose hour is NULL or outside 0..23."""
    hour = F.col(column)
    return rows.where(hour.isNull() | ~hour.between(0, HOURS_PER_DAY - 1))
