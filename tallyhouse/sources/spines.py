"""Date and hour spines, the generated sources under the dimensions."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import HOURS_PER_DAY


def date_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row (start, end) from two ISO dates, for date_spine."""
    return spark.range(1).select(
        F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end")
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every date from start to end, both included; none when end < start.

    `bounds` is a one-row frame, so the range may come from an aggregate over
    the data without passing through the driver. Years are made first and dealt
    out; the days of each year are made where it is.
    """
    years = bounds.where("start <= end").select(
        "start", "end", F.explode(F.sequence(F.year("start"), F.year("end"))).alias("year")
    ).repartition(bounds.sparkSession.sparkContext.defaultParallelism, "year")
    first = F.greatest("start", F.make_date("year", F.lit(1), F.lit(1)))
    last = F.least("end", F.make_date("year", F.lit(12), F.lit(31)))
    return years.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))


def hours_between(spark: SparkSession, first: int = 0, last: int = HOURS_PER_DAY - 1) -> DataFrame:
    """The hours first..last as a frame for hour_spine."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("hour"))


def hour_spine(hours: DataFrame, column: str = "hour") -> DataFrame:
    """The given hours as `time_id`, refusing any that is no integer in 0..23."""
    if not isinstance(hours.schema[column].dataType, T.IntegralType):
        raise ValueError(f"hours must be integers, {column} is {hours.schema[column].dataType}")
    hour: Column = F.col(column)
    checked = F.when(hour.between(0, HOURS_PER_DAY - 1), hour).otherwise(
        F.raise_error(F.concat(
            F.lit("hour out of 0..23: "), F.coalesce(hour.cast("string"), F.lit("NULL"))
        ))
    )
    return hours.select(checked.cast("int").alias("time_id"))
