"""The given tables as dump lines: (value, file_name), the input of the parser.

Whole tables, one line per row; nothing is sampled or left out.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions import dump_name

PAGES = ["page0", "page1", "page2", "page3", "page4", "page5"]


def _line(domain: Column, page_number: Column, views: Column) -> Column:
    return F.concat_ws(
        " ", domain, F.concat(F.lit("page"), page_number.cast("string")),
        F.floor(views).cast("string"), F.lit("0"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def event_line(domain: Column | None = None) -> Column:
    return _line(
        F.col("event_type") if domain is None else domain, F.col("user_id") % 10, F.col("value")
    )


def raw(spark: SparkSession, sf_dir: str, hour_shift: int = 0, domain: Column | None = None) -> DataFrame:
    """Events as lines of the dump of their hour: 30 days with all their hours."""
    return events(spark, sf_dir).select(
        event_line(domain).alias("value"),
        dump_name(F.col("ts").cast("date"), F.hour("ts") + hour_shift).alias("file_name"),
    )


def raw_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW with planted short lines, bad counts and bad file names."""
    event = F.col("event_id")
    page = F.concat(F.lit("page"), (F.col("user_id") % 10).cast("string"))
    value = (
        F.when(event % 97 == 0, F.concat_ws(" ", "event_type", page))
        .when(event % 89 == 0, F.concat_ws(" ", "event_type", page, F.lit("x"), F.lit("0")))
        .otherwise(event_line())
    )
    name = F.when(event % 83 == 0, "pageviews_20240101.gz").otherwise(
        dump_name(F.col("ts").cast("date"), F.hour("ts"))
    )
    return events(spark, sf_dir).select(value.alias("value"), name.alias("file_name"))


def _item_line() -> Column:
    return _line(F.col("l_returnflag"), F.col("l_partkey") % 10, F.col("l_quantity"))


def _item_hour() -> Column:
    return (F.col("l_orderkey") + F.col("l_linenumber")) % 24


def raw_long(spark: SparkSession, sf_dir: str, years: int = 20) -> DataFrame:
    """Line items as lines of dumps over seven years, moved by whole years."""
    day = F.add_months(F.col("l_shipdate").cast("date"), 12 * years)
    return lineitem(spark, sf_dir).select(
        _item_line().alias("value"), dump_name(day, _item_hour()).alias("file_name")
    )


def raw_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as lines of dumps over 84 days, 30 ship dates on one day: January
    and February 2015 have all their days and hours, March is incomplete."""
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    day = F.date_add(F.lit("2015-01-01").cast("date"), F.floor(days / 30).cast("int"))
    return lineitem(spark, sf_dir).select(
        _item_line().alias("value"), dump_name(day, _item_hour()).alias("file_name")
    )
