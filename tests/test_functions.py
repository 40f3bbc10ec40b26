import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import (
    calendar_day, clock_text, collection_date, collection_time, file_clock_of, file_date_of,
    path_dump_name, view_count,
)


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expression.alias("x")).first().x


@pytest.mark.parametrize("name, day, clock", [
    ("pageviews-20150901-010000.gz", datetime.date(2015, 9, 1), "010000"),
    ("pageviews-20160229-235959.gz", datetime.date(2016, 2, 29), "235959"),
    ("pageviews-20151301-010000.gz", None, "010000"),
    ("pageviews-20150229-010000.gz", None, "010000"),
    ("pageviews_20150901-010000.gz", None, None),
    ("pageviews-20150901_010000.gz", None, None),
    ("pageviews-2015 901-010000.gz", None, None),
    ("pageviews-20150901-01000x.gz", None, None),
    ("pageviews-20150901-010000.gzip", None, None),
    ("pageviews--2010901-010000.gz", None, None),
    ("projects-20150901-0100000.gz", None, None),
    ("", None, None),
])
def test_dump_name(spark, name, day, clock):
    assert one(spark, file_date_of(F.col("n")), n=name) == day
    assert one(spark, clock_text(file_clock_of(F.col("n"))), n=name) == clock


@pytest.mark.parametrize("day, clock, stamped", [
    ("2015-09-01", "000000", ("2015-08-31", "00:00:00")),
    ("2016-03-01", "000000", ("2016-02-29", "00:00:00")),
    ("2015-01-01", "000000", ("2014-12-31", "00:00:00")),
    ("2015-09-01", "010000", ("2015-09-01", "01:00:00")),
    ("2015-09-01", "000500", ("2015-09-01", "00:05:00")),
])
def test_midnight_belongs_to_the_day_before(spark, day, clock, stamped):
    both = F.struct(
        collection_date(F.col("d").cast("date"), F.col("t")), collection_time(F.col("t"))
    )
    assert tuple(one(spark, both, d=day, t=clock)) == stamped


@pytest.mark.parametrize("raw, count", [
    ("7", 7), ("-3", -3), ("3000000000", 3_000_000_000), ("10.5", 10), ("10.", 10),
    ("x", None), ("", None), ("1e3", None), ("12x", None), (None, None),
])
def test_view_count(spark, raw, count):
    assert one(spark, view_count(F.col("r")), r=raw) == count


def test_path_dump_name(spark):
    name = path_dump_name(F.col("p"))
    plain = "file:/a-b/c/pageviews-20150901-010000.gz"
    landed = "file:/a-b/file_name=pageviews-20150901-010000.gz/part-0.txt.gz"
    assert one(spark, name, p=plain) == "pageviews-20150901-010000.gz"
    assert one(spark, name, p=landed) == "pageviews-20150901-010000.gz"


@pytest.mark.parametrize("y, m, d, day", [
    (2016, 2, 29, datetime.date(2016, 2, 29)), (2015, 2, 29, None), (2015, 13, 1, None),
])
def test_calendar_day(spark, y, m, d, day):
    found = spark.range(1).select(calendar_day(F.lit(y), F.lit(m), F.lit(d)).alias("x"))
    assert found.first().x == day
