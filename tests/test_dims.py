import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import dim_date_between, dim_time
from tallyhouse.sources import date_bounds, date_spine, expected_dumps, hours_between


@pytest.fixture(scope="module")
def calendar(spark):
    return {row.date_id: row for row in dim_date_between(spark).collect()}


def test_whole_calendar_against_strftime(calendar):
    assert len(calendar) == 4018
    for row in calendar.values():
        day = row.date
        assert row.date_id == int(day.strftime("%Y%m%d"))
        assert (row.year, row.month, row.day) == (day.year, day.month, day.day)
        assert row.quarter == (day.month + 2) // 3
        assert row.month_name == day.strftime("%B")
        assert row.day_name == day.strftime("%A")
        assert row.week_of_year == int(day.strftime("%U"))
        assert row.is_weekend == (day.weekday() == 6)


def test_two_day_weekend(spark):
    rows = dim_date_between(spark, "2015-09-04", "2015-09-07", weekend_days=(5, 6)).collect()
    assert [row.is_weekend for row in rows] == [False, True, True, False]


def test_spine_bounds(spark):
    assert date_spine(date_bounds(spark, "2015-01-02", "2015-01-01")).count() == 0
    assert date_spine(date_bounds(spark, "2015-01-02", "2015-01-02")).count() == 1
    long = date_spine(date_bounds(spark, "0001-12-30", "9999-01-02"))
    days = (datetime.date(9999, 1, 2) - datetime.date(1, 12, 30)).days + 1
    found = long.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("date").alias("n")).collect()
    assert sum(row.n for row in found) == long.count() == days and len(found) > 1


def test_dim_time(spark):
    rows = dim_time(hours_between(spark)).collect()
    assert [tuple(row) for row in rows] == [(h, f"{h:02d}:00:00") for h in range(24)]


@pytest.mark.parametrize("hour", [-1, 24, None])
def test_hours_out_of_range_are_refused(spark, hour):
    hours = spark.createDataFrame([(3,), (hour,)], "hour int")
    with pytest.raises(Exception, match="out of 0..23"):
        dim_time(hours).collect()


def test_hours_must_be_integers(spark):
    with pytest.raises(ValueError, match="must be integers"):
        dim_time(spark.createDataFrame([("3",)], "hour string"))


def test_expected_dumps(spark):
    days = spark.createDataFrame([(datetime.date(2015, 9, 2),), (None,)], "date date")
    rows = expected_dumps(days).orderBy("hour").collect()
    assert len(rows) == 24
    assert rows[1].file_name == "pageviews-20150902-010000.gz"
    assert rows[1].url.endswith("/pageviews/2015/2015-09/pageviews-20150902-010000.gz")


def test_no_time_type_needed(spark):
    assert dict(dim_time(hours_between(spark)).dtypes) == {"time_id": "int", "time_creation": "string"}
    assert dim_time(hours_between(spark)).where(F.col("time_creation") == "23:00:00").count() == 1
