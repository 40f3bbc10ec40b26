import datetime

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from dumpfiles import write_day, write_dump
from tallyhouse.operators import (
    between_dates, calendar_keys, dim_date_between, dim_time, hourly_pageviews, load_frame, ordered_hours,
    pk_violations, split_lines, views_by, with_broken_rules, with_fact_id,
)
from tallyhouse.plans import (
    ConstraintError, RunAudit, Warehouse, append_months, build_dimensions, convert,
    ingest_folder, ingest_stream, load_fact, load_jdbc, load_months, log_lines, report, sweep_warehouse, write_hours,
)
from tallyhouse.schemas import FACT_COLUMNS, LOAD_COLUMNS
from tallyhouse.sinks import land_dumps, write_daily, write_monthly
from tallyhouse.sources import (
    hours_between, read_daily, read_dumps, read_fact, read_hourly, read_ledger, read_monthly, read_refused,
    read_rejects, read_rollups,
    read_tally,
)
from tallyhouse.streaming import ingest_available, stream_dumps, stream_hourly


def february(folder):
    for day in range(1, 29):
        write_day(folder, f"201502{day:02d}")


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dumps")
    february(folder)
    write_day(folder, "20150301")
    write_day(folder, "20150302", hours=range(23))
    write_dump(folder, "pageviews-201503.gz", ["en Google 1000 0"])
    return folder


@pytest.fixture(scope="module")
def house(spark, dumps, tmp_path_factory):
    house = Warehouse(str(tmp_path_factory.mktemp("house")))
    audit = RunAudit(spark, house.audit, "first")
    assert ingest_folder(spark, str(dumps), house, "1", audit=audit) == 29 * 24
    build_dimensions(spark, house)
    load_months(spark, house, "1", audit=audit)
    return house


def test_days_and_months(spark, house):
    days = read_daily(spark, house.daily).select("file_date").distinct().collect()
    assert len(days) == 29
    months = read_monthly(spark, house.monthly)
    assert [r.file_month for r in months.select("file_month").distinct().collect()] == ["2015-02"]
    assert months.count() == 28 * 24
    assert months.where("year = 2015 AND month = 1").count() == 1  # the first midnight


def test_fact(spark, house):
    fact = read_fact(spark, house.fact)
    assert fact.count() == 28 * 24
    assert fact.agg(F.sum("sumpageviewcount")).first()[0] == 28 * sum(range(1, 25))
    assert fact.select("fact_id").distinct().count() == 28 * 24
    first = fact.where("date_id = 20150131").first()
    assert (first.time_id, first.load_month, first.year, first.month) == (0, "2015-02", 2015, 1)


def test_nothing_new_means_nothing_done(spark, house, dumps):
    before = sorted(map(tuple, read_fact(spark, house.fact).collect()))
    assert ingest_folder(spark, str(dumps), house, "2") == 0
    load_months(spark, house, "2")
    load_months(spark, house, "3", reload=["2015-02"])
    assert sorted(map(tuple, read_fact(spark, house.fact).collect())) == before


def test_ledger_and_audit(spark, house):
    ledger = read_ledger(spark, house.ledger).where("batch_id = '1'")
    counts = {r.stage: r["count"] for r in ledger.groupBy("stage").count().collect()}
    assert counts == {"hourly": 29 * 24, "daily": 29, "monthly": 1, "fact": 1}
    audit = RunAudit(spark, house.audit, "first").read()
    metrics = {}
    for row in audit.collect():
        metrics[row.stage] = metrics.get(row.stage, 0) + row.metrics["rows"]
    assert metrics == {"hourly": 29 * 48, "daily": 29 * 24, "monthly": 28 * 24, "fact": 28 * 24}
    # The dumps of two months were tallied apart.
    assert log_lines(audit).where(r"value rlike '^\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d : .+'").count() == 5


def test_damaged_dump_leaves_out_its_day(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    write_day(folder, "20150901")
    write_day(folder, "20150902")
    damaged = folder / "pageviews-20150902-050000.gz"
    damaged.write_bytes(damaged.read_bytes()[:-6])
    house = Warehouse(str(tmp_path / "house"))
    audit = RunAudit(spark, house.audit)
    assert ingest_folder(spark, str(folder), house, "1", check=True, audit=audit) == 24
    days = read_daily(spark, house.daily).select("file_date").distinct().collect()
    assert [r.file_date for r in days] == [datetime.date(2015, 9, 1)]
    assert "truncated" in audit.read().where("stage = 'check'").first().message
    write_day(folder, "20150902")
    assert ingest_folder(spark, str(folder), house, "2", check=True) == 24
    assert read_daily(spark, house.daily).select("file_date").distinct().count() == 2


def test_date_range(spark, dumps, tmp_path):
    house = Warehouse(str(tmp_path / "house"))
    assert ingest_folder(spark, str(dumps), house, "1", start="2015-02-03", end="2015-02-04") == 48


def test_stream_in_several_runs_equals_batch(spark, house, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    streamed = Warehouse(str(tmp_path / "house"))

    def run(batch):
        lines = stream_dumps(spark, str(folder), files_per_batch=300)
        return ingest_stream(spark, lines, streamed, batch)

    write_day(folder, "20150201", hours=range(5))
    assert run("1").count() == 0
    february(folder)
    months = run("2")
    want = sorted(map(tuple, read_monthly(spark, house.monthly).collect()))
    assert sorted(map(tuple, months.collect())) == want
    assert sorted(map(tuple, run("3").collect())) == want
    assert stream_hourly(spark, streamed.tally, "2015-02-03", "2015-02-04").count() == 48


def test_archived_dumps_are_not_counted_twice(spark, tmp_path):
    folder, archive = tmp_path / "in", tmp_path / "archive"
    folder.mkdir()
    tallies, checkpoint = str(tmp_path / "tally"), str(tmp_path / "checkpoint")
    for day in ("20150901", "20150902", "20150903"):
        write_day(folder, day, hours=range(2))
        lines = stream_dumps(spark, str(folder), archive=str(archive))
        ingest_available(lines, tallies, checkpoint)
    rows = stream_hourly(spark, tallies).collect()
    assert len(rows) == 6 and sum(r.sumpageviewcount for r in rows) == 9


def month_rows(spark, *rows):
    hourly = spark.createDataFrame(
        rows, "domain string, pagename string, sumpageviewcount long, date_collection string, "
        "time_collection string, file_month string",
    )
    return calendar_keys(hourly)


GOOD = ("en", "Google", 5, "2015-09-01", "03:00:00", "2015-09")
BAD = [
    ("e" * 31, "Google", 5, "2015-09-01", "03:00:00", "2015-09"),
    ("en", "Google", None, "2015-09-01", "04:00:00", "2015-09"),
    ("en", "Google", 5, "2026-09-01", "05:00:00", "2026-09"),
    ("en", "Google", 5, "2031-01-01", "05:00:00", "2031-01"),
    ("en", "Google", 5, "2015-09-01", "24:00:00", "2015-09"),
    (None, "Google", 5, "2014-12-31", "00:00:00", "2015-01"),
]


@pytest.fixture(scope="module")
def dims(spark):
    return dim_date_between(spark), dim_time(hours_between(spark))


def test_rules(spark, dims):
    rows = month_rows(spark, GOOD, *BAD).select(*LOAD_COLUMNS)
    checked = with_broken_rules(rows, *dims).collect()
    assert sorted(r.broken_rules for r in checked) == sorted([
        "", "length", "not_null", "fk_date", "partition_range,fk_date", "fk_time",
        "not_null,partition_range,fk_date",
    ])


def test_bad_rows_stop_the_load(spark, dims, tmp_path):
    path = str(tmp_path / "fact")
    with pytest.raises(ConstraintError, match="fk_date"):
        load_fact(spark, month_rows(spark, GOOD, *BAD), path, *dims)
    assert not (tmp_path / "fact").exists()


def test_bad_rows_set_aside(spark, dims, tmp_path):
    fact, refused = str(tmp_path / "fact"), str(tmp_path / "refused")
    load_fact(spark, month_rows(spark, GOOD, *BAD), fact, *dims, refused)
    assert read_fact(spark, fact).count() == 1
    assert read_refused(spark, refused, fact).count() == len(BAD)


def test_key_depends_on_its_row_alone(spark):
    """One hour holds all rows: other rows, and their order, change no id."""
    hot = spark.range(20_000).select(
        F.lit(20150901).alias("date_id"), F.lit(3).alias("time_id"),
        F.concat(F.lit("site"), F.col("id")).alias("domain"), F.lit("Google").alias("pagename"),
    )
    numbered = with_fact_id(hot)
    assert numbered.select("fact_id").distinct().count() == 20_000
    assert numbered.where("fact_id < 0").isEmpty()
    more = with_fact_id(hot.union(hot.select("date_id", "time_id", F.lit("aaa"), "pagename").limit(1)).repartition(7))
    assert numbered.exceptAll(more).isEmpty() and more.count() == 20_001
    assert pk_violations(numbered, ["fact_id"]).isEmpty()


def test_two_rows_of_one_key_are_both_refused(spark, dims, tmp_path, monkeypatch):
    fact, refused = str(tmp_path / "fact"), str(tmp_path / "refused")
    twice = month_rows(spark, GOOD, GOOD, (*GOOD[:3], "2015-09-02", *GOOD[4:]))
    with pytest.raises(ConstraintError, match="primary_key"):
        load_fact(spark, twice, fact, *dims)
    load_fact(spark, twice, fact, *dims, refused)
    assert read_fact(spark, fact).count() == 1
    assert [r.broken_rules for r in read_refused(spark, refused, fact).collect()] == ["primary_key"] * 2
    # Two pages of an hour whose hashes are the same: with no digits, all are.
    monkeypatch.setattr("tallyhouse.operators.keys.HASH_DIGITS", 0)
    with pytest.raises(ConstraintError, match="primary_key"):
        load_fact(spark, month_rows(spark, GOOD, ("de", *GOOD[1:])), fact, *dims)


def test_reload_of_a_month_keeps_its_neighbours_midnight(spark, dims, tmp_path):
    path = str(tmp_path / "fact")
    def load(*rows):
        load_fact(spark, month_rows(spark, *rows), path, *dims)
    september = ("en", "Google", 1, "2015-08-31", "00:00:00", "2015-09")
    august = ("en", "Google", 2, "2015-08-31", "01:00:00", "2015-08")
    load(september, GOOD)
    load(august)
    load(august)
    assert read_fact(spark, path).count() == 3
    assert read_fact(spark, path).where("year = 2015 AND month = 8").count() == 2


def test_jdbc_append(spark, house, monkeypatch):
    """What is handed to the writer; no database is started."""
    calls = []
    def record(self, url, table, mode=None, properties=None):
        calls.append((self._df.columns, url, table, mode, properties))
    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    load_jdbc(
        read_fact(spark, house.fact), "jdbc:postgresql://host/db", writers=4,
        properties={"user": "loader"},
    )
    assert calls == [(
        FACT_COLUMNS, "jdbc:postgresql://host/db", "fact_pageviews", "append",
        {"batchsize": "10000", "user": "loader", "numPartitions": "4"},
    )]


def months_of(spark, house):
    return sorted(map(tuple, read_monthly(spark, house.monthly).collect()))


def test_one_batch_id_for_two_runs(spark, house, dumps, tmp_path):
    again = Warehouse(str(tmp_path / "house"))
    assert ingest_folder(spark, str(dumps), again, "2015-02", end="2015-02-26") == 26 * 24
    assert ingest_folder(spark, str(dumps), again, "2015-02", start="2015-02-27", end="2015-02-28") == 48
    assert months_of(spark, again) == months_of(spark, house)
    counts = {r.stage: r["count"] for r in read_ledger(spark, again.ledger).groupBy("stage").count().collect()}
    assert counts == {"hourly": 28 * 24, "daily": 28, "monthly": 1}


@pytest.mark.parametrize("stop", ["write_daily", "write_monthly", "append_ledger"])
def test_a_stopped_run_is_finished_by_the_next(spark, house, dumps, tmp_path, monkeypatch, stop):
    again = Warehouse(str(tmp_path / "house"))

    def fail(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(f"tallyhouse.plans.jobs.{stop}", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            ingest_folder(spark, str(dumps), again, "1")
    assert ingest_folder(spark, str(dumps), again, "2") == 0
    assert months_of(spark, again) == months_of(spark, house)


def test_stopped_between_two_months_of_dumps(spark, tmp_path, monkeypatch):
    folder = tmp_path / "dumps"
    folder.mkdir()
    write_day(folder, "20150131")
    write_day(folder, "20150201")
    again = Warehouse(str(tmp_path / "house"))
    calls = []

    def once(*args, **options):
        if calls:
            raise RuntimeError("stopped")
        calls.append(1)
        return convert(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr("tallyhouse.plans.jobs.convert", once)
        with pytest.raises(RuntimeError, match="stopped"):
            ingest_folder(spark, str(folder), again, "1")
    assert ingest_folder(spark, str(folder), again, "1") == 24
    assert read_daily(spark, again.daily).count() == 48


def test_stream_and_folder_in_one_warehouse(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    both = Warehouse(str(tmp_path / "house"))
    write_day(folder, "20150901")
    write_day(folder, "20150902", hours=range(5))
    ingest_stream(spark, stream_dumps(spark, str(folder)), both, "0")
    write_day(folder, "20150902", hours=range(5, 24))
    write_day(folder, "20150903")
    # Five dumps of the second are tallied already and count for their day.
    assert ingest_folder(spark, str(folder), both, "0") == 19 + 24
    ingest_stream(spark, stream_dumps(spark, str(folder)), both, "1")
    # The same, had the checkpoint been lost.
    lost = Warehouse(str(tmp_path / "house"))
    ingest_available(stream_dumps(spark, str(folder)), lost.tally, str(tmp_path / "other-checkpoint"))
    rows = stream_hourly(spark, both.tally).collect()
    assert len(rows) == 72 and sum(r.sumpageviewcount for r in rows) == 3 * 300
    days = read_daily(spark, both.daily)
    assert days.count() == 72 and days.agg(F.sum("sumpageviewcount")).first()[0] == 900


@pytest.mark.parametrize("streamed", [False, True])
def test_a_dump_in_two_places_counts_once(spark, tmp_path, streamed):
    folder = tmp_path / "dumps"
    for below in ("2015/2015-09", "copies"):
        (folder / below).mkdir(parents=True)
        write_day(folder / below, "20150901")
    house = Warehouse(str(tmp_path / "house"))
    audit = RunAudit(spark, house.audit)
    if streamed:
        for run in ("1", "2"):
            ingest_stream(spark, stream_dumps(spark, str(folder), files_per_batch=30), house, run)
    else:
        assert ingest_folder(spark, str(folder), house, "1", audit=audit) == 24
        assert audit.read().where("stage = 'copies'").count() == 24
    days = read_daily(spark, house.daily)
    assert days.count() == 24 and days.agg(F.sum("sumpageviewcount")).first()[0] == 300


@pytest.mark.parametrize("streamed", [False, True])
def test_landed_dumps(spark, tmp_path, streamed):
    folder, landed = tmp_path / "dumps", str(tmp_path / "landed")
    folder.mkdir()
    write_day(folder, "20150901")
    lines = read_dumps(spark, str(folder))
    # Two writes: each dump lies in two parts.
    google = F.col("value").contains("Google")
    land_dumps(lines.where(google), landed)
    land_dumps(lines.where(~google), landed)
    house = Warehouse(str(tmp_path / "house"))
    if streamed:
        ingest_stream(spark, stream_dumps(spark, landed, files_per_batch=20), house, "1")
    else:
        assert ingest_folder(spark, landed, house, "1", check=True) == 24
    days = read_daily(spark, house.daily)
    assert days.count() == 24 and days.agg(F.sum("sumpageviewcount")).first()[0] == 300
    assert read_tally(spark, house.tally).agg(F.sum("lines")).first()[0] == 48


def test_empty_folder_is_no_error(spark, tmp_path):
    (tmp_path / "dumps").mkdir()
    house = Warehouse(str(tmp_path / "house"))
    assert ingest_folder(spark, str(tmp_path / "dumps"), house, "1") == 0
    assert ingest_stream(spark, stream_dumps(spark, str(tmp_path / "dumps")), house, "1").count() == 0


def test_a_dump_without_lines_is_noted(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    write_day(folder, "20150901", hours=range(23))
    write_dump(folder, "pageviews-20150901-230000.gz", [])
    house = Warehouse(str(tmp_path / "house"))
    assert ingest_folder(spark, str(folder), house, "1") == 24
    assert read_daily(spark, house.daily).count() == 23
    assert ingest_folder(spark, str(folder), house, "2") == 0


def test_rejects_and_hours(spark, tmp_path):
    folder = tmp_path / "dumps"
    folder.mkdir()
    write_day(folder, "20150901", hours=range(23))
    write_dump(folder, "pageviews-20150901-230000.gz", ["en Google x 0", "short Google", "short Google", "en Google 7 0"])
    house = Warehouse(str(tmp_path / "house"))
    ingest_folder(spark, str(folder), house, "1")
    rejects = {(r.reason, r.line, r.lines) for r in read_rejects(spark, house.rejects, house.tally).collect()}
    assert rejects == {("bad_count", "en Google x 0", 1), ("short_line", "short Google", 2)}
    write_hours(spark, house, "2015-09-01", "2015-09-01")
    hours = read_hourly(spark, house.hourly)
    assert hours.count() == 24 and hours.where("file_time = '230000'").first().sumpageviewcount == 7


def test_reload_with_fewer_rows_equals_a_fresh_load(spark, dims, tmp_path):
    midnight = ("en", "Google", 1, "2015-08-31", "00:00:00", "2015-09")
    bad = ("e" * 31, "Google", 5, "2015-09-01", "03:00:00", "2015-09")
    fact, refused = str(tmp_path / "fact"), str(tmp_path / "refused")
    load_fact(spark, month_rows(spark, midnight, GOOD, bad), fact, *dims, refused)
    assert read_fact(spark, fact).count() == 2 and read_refused(spark, refused, fact).count() == 1
    load_fact(spark, month_rows(spark, GOOD), fact, *dims, refused)
    assert [r.date_id for r in read_fact(spark, fact).collect()] == [20150901]
    load_fact(spark, month_rows(spark, GOOD).limit(0), fact, *dims, refused, months=["2015-09"])
    assert read_fact(spark, fact).count() == 0
    assert read_refused(spark, refused, fact).count() == 0


def test_append_is_noted(spark, house, monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **b: calls.append(self._df.count()))
    assert append_months(spark, house, "1", "jdbc:x") == ["2015-02"]
    assert append_months(spark, house, "2", "jdbc:x") == []
    assert append_months(spark, house, "3", "jdbc:x", months=["2015-02", "2015-03"]) == ["2015-02"]
    assert calls == [28 * 24] * 2


def test_filters_reach_the_folders_and_pass_the_sum(spark, house, dumps):
    """What is asked of dates is asked of the folders, and before anything is summed."""
    plan = stream_hourly(spark, house.tally, "2015-02-03", "2015-02-04")._jdf.queryExecution().executedPlan().toString()
    assert "file_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    lines = split_lines(read_dumps(spark, str(dumps)))
    hourly = hourly_pageviews(between_dates(lines, "2015-02-03", "2015-02-04"))
    steps = hourly._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")
    assert len(steps) == 2 and "20150203" in steps[1] and "20150203" not in steps[0]
    days = hourly.groupBy("file_date").count().collect()
    assert {(str(r.file_date), r["count"]) for r in days} == {("2015-02-03", 48), ("2015-02-04", 48)}


def test_order_in_files(spark, tmp_path):
    """Sorted sets are sorted in each partition that a task writes."""
    hourly = spark.range(3000).select(
        F.concat(F.lit("site"), F.col("id") * 7 % 100).alias("domain"), F.concat(F.lit("page"), F.col("id") % 13).alias("pagename"),
        F.col("id").alias("sumpageviewcount"), F.lit("2015-09-01").alias("date_collection"),
        F.concat(F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias("time_collection"),
        F.lit("2015-09-01").cast("date").alias("file_date"), F.concat(F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit("0000")).alias("file_time"),
    )
    def in_order(rows, keys):
        parts = rows.withColumn("part", F.spark_partition_id()).collect()
        last = {}
        for row in parts:
            key = tuple(row[k] for k in keys)
            assert last.get(row.part, key) <= key
            last[row.part] = key
        return len(parts)
    assert in_order(ordered_hours(hourly), ["file_date", "file_time", "domain", "pagename"]) == 3000
    assert in_order(load_frame(calendar_keys(hourly)), ["date_id", "time_id"]) == 3000


BAD_LINES = ["en Google x 0", "short Google", "short Google", "en Google 7 0"]


def rejected(spark, house):
    return sorted((r.file_name, r.reason, r.line, r.lines) for r in read_rejects(spark, house.rejects, house.tally).collect())


@pytest.mark.parametrize("streamed", [False, True])
@pytest.mark.parametrize("stop", ["write_rejects", "publish"])
def test_rejects_survive_a_stop(spark, tmp_path, monkeypatch, stop, streamed):
    folder = tmp_path / "dumps"
    folder.mkdir()
    write_day(folder, "20150901", hours=range(22))
    write_dump(folder, "pageviews-20150901-220000.gz", BAD_LINES)
    write_dump(folder, "pageviews-20150901-230000.gz", BAD_LINES[1:])

    def run(house, batch):
        if streamed:
            ingest_stream(spark, stream_dumps(spark, str(folder)), house, batch)
        else:
            ingest_folder(spark, str(folder), house, batch)

    whole, broken = Warehouse(str(tmp_path / "whole")), Warehouse(str(tmp_path / "broken"))
    run(whole, "1")

    def fail(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(f"tallyhouse.streaming.ingest.{stop}", fail)
        with pytest.raises(Exception, match="stopped"):
            run(broken, "1")
    assert read_tally(spark, broken.tally).count() == 0 and rejected(spark, broken) == []
    run(broken, "2")
    assert rejected(spark, broken) == rejected(spark, whole) != []
    assert read_tally(spark, broken.tally).agg(F.sum("lines")).first()[0] == read_tally(spark, whole.tally).agg(F.sum("lines")).first()[0]


def test_readers_see_the_old_month_or_the_new_one(spark, dims, tmp_path, monkeypatch):
    """A reload with other rows, stopped after each of its writes."""
    house = Warehouse(str(tmp_path / "house"))
    midnight = ("en", "Google", 1, "2015-08-31", "00:00:00", "2015-09")
    bad = ("e" * 31, "Google", 5, "2015-09-01", "03:00:00", "2015-09")
    other = ("de", "Apple", 2, "2015-09-05", "07:00:00", "2015-09")

    def load(*rows):
        load_fact(spark, month_rows(spark, *rows), house.fact, *dims, house.refused, rollups_path=house.rollups)

    def seen():
        fact = sorted((r.date_id, r.domain) for r in read_fact(spark, house.fact).collect())
        views = report(spark, house, "year", dim_date=dims[0], dim_time=dims[1]).collect()
        return fact, read_refused(spark, house.refused, house.fact).count(), [(r.year, r.views) for r in views]

    load(midnight, GOOD, bad)
    old = seen()
    assert old == ([(20150831, "en"), (20150901, "en")], 1, [(2015, 6)])

    def fail(*_, **__):
        raise RuntimeError("stopped")

    for stop in ("write_fact", "write_rollups", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(f"tallyhouse.plans.jobs.{stop}", fail)
            with pytest.raises(RuntimeError, match="stopped"):
                load(other)
        assert seen() == old
    load(other)
    assert seen() == ([(20150905, "de")], 0, [(2015, 2)])


@pytest.mark.parametrize("write, read, key", [(write_daily, read_daily, "file_date"), (write_monthly, read_monthly, "file_month")])
def test_sets_are_replaced_in_one_step(spark, tmp_path, monkeypatch, write, read, key):
    path = str(tmp_path / "sets")
    rows = spark.createDataFrame(
        [("en", "Google", n, "2015-09-01", f"{n:02d}:00:00", datetime.date(2015, 9, 1 + n % 2), f"{n:02d}0000") for n in range(24)],
        "domain string, pagename string, sumpageviewcount long, date_collection string, time_collection string, file_date date, file_time string",
    )
    if write is write_monthly:
        rows = calendar_keys(rows)
    write(rows, path)
    fewer = rows.where("sumpageviewcount < 3")
    with monkeypatch.context() as patch:
        patch.setattr("tallyhouse.sinks.tables.publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write(fewer, path)
    assert read(spark, path).count() == 24
    write(fewer, path)
    assert read(spark, path).count() == 3
    owned = rows.select("file_date").distinct() if key == "file_date" else spark.createDataFrame([("2015-09",)], "file_month string")
    write(rows.limit(0), path, None, owned)
    assert read(spark, path).count() == 0


def test_a_key_of_another_load_is_refused(spark, dims, tmp_path):
    fact, refused = str(tmp_path / "fact"), str(tmp_path / "refused")
    again = (*GOOD[:5], "2015-10")
    fresh = ("en", "Google", 5, "2015-10-01", "03:00:00", "2015-10")
    load_fact(spark, month_rows(spark, GOOD), fact, *dims)
    with pytest.raises(ConstraintError, match="primary_key"):
        load_fact(spark, month_rows(spark, again, fresh), fact, *dims)
    load_fact(spark, month_rows(spark, again, fresh), fact, *dims, refused)
    assert [r.load_month for r in read_refused(spark, refused, fact).collect()] == ["2015-10"]
    assert sorted(r.date_id for r in read_fact(spark, fact).collect()) == [20150901, 20151001]
    # The month that has the key is replaced: its own old row is no clash.
    load_fact(spark, month_rows(spark, GOOD), fact, *dims)
    assert read_fact(spark, fact).count() == 2


def test_a_hot_day_of_a_stream_is_cut(spark, tmp_path, monkeypatch):
    """Spark turns adaptive execution off for a stream; small days still share a file."""
    folder, tallies = tmp_path / "dumps", str(tmp_path / "tally")
    folder.mkdir()
    for hour in range(4):
        write_dump(folder, f"pageviews-20150901-{hour:02d}0000.gz", [f"site{n * 7919 % 100003}.{hour} Google {n} 0" for n in range(20_000)])
    for day in range(2, 6):
        write_day(folder, f"201509{day:02d}", hours=range(3))
    monkeypatch.setattr("tallyhouse.sinks.tables.FILE_ROWS", 10_000)
    ingest_available(stream_dumps(spark, str(folder)), tallies, str(tmp_path / "checkpoint"))
    files = spark.read.parquet(f"{tallies}/batch_id=*/version=*/file_month=2015-09/outcome=kept").select(
        F.input_file_name().alias("file"), "file_date"
    )
    sizes = {r.file: (r["rows"], r.days) for r in files.groupBy("file").agg(F.count("*").alias("rows"), F.countDistinct("file_date").alias("days")).collect()}
    assert len(sizes) >= 4 and max(rows for rows, _ in sizes.values()) < 40_000
    assert max(days for _, days in sizes.values()) >= 4
    assert stream_hourly(spark, tallies).count() == 80_012


def test_a_condition_on_a_dimension_prunes_the_fact(spark, house):
    """The condition is on an attribute that the fact's folders do not have."""
    dates, times = (spark.read.parquet(path) for path in (house.dim_date, house.dim_time))
    march = views_by(read_fact(spark, house.fact), dates.where("month_name = 'March'"), times, "day_name")
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "SubqueryAdaptiveBroadcast dynamicpruning" in plan
    assert march.count() == 0


def test_reports_from_kept_sums_equal_those_of_the_fact(spark, house):
    dates, times = (spark.read.parquet(path) for path in (house.dim_date, house.dim_time))
    fact = read_fact(spark, house.fact)
    for attributes in (["day_name"], ["time_creation", "month"], ["domain", "year"], ["pagename"], ["date_id", "domain", "pagename"]):
        want = sorted(map(tuple, views_by(fact, dates, times, *attributes).collect()))
        assert sorted(map(tuple, report(spark, house, *attributes).collect())) == want != []
    assert read_rollups(spark, house.rollups, house.fact).where("grain = 'hours'").count() == 28 * 24


def test_jobs_leave_no_scratch(spark, dims, tmp_path, monkeypatch):
    shared, made = tmp_path / "shared", []

    def folder(spark, purpose):
        made.append(f"{shared}/{purpose}-{len(made)}")
        return made[-1]

    monkeypatch.setattr("tallyhouse.session.scratch_folder", folder)
    (tmp_path / "dumps").mkdir()
    write_day(tmp_path / "dumps", "20150901")
    ingest_folder(spark, str(tmp_path / "dumps"), Warehouse(str(tmp_path / "house")), "1")
    load_fact(spark, month_rows(spark, GOOD), str(tmp_path / "fact"), *dims)
    assert len(made) == 5 and not any(shared.iterdir())


def test_sweeping_deletes_what_nobody_reads(spark, dims, tmp_path, monkeypatch):
    house = Warehouse(str(tmp_path / "house"))
    bad = ("e" * 31, "Google", 5, "2015-09-01", "03:00:00", "2015-09")
    other = ("de", "Apple", 2, "2015-10-05", "07:00:00", "2015-10")

    def load(*rows):
        load_fact(spark, month_rows(spark, *rows), house.fact, *dims, house.refused, rollups_path=house.rollups)

    load(GOOD, bad, other)
    load(GOOD, bad)
    with monkeypatch.context() as patch:
        patch.setattr("tallyhouse.plans.jobs.publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(other)

    def seen():
        return [sorted(map(tuple, rows.collect()), key=repr) for rows in (
            read_fact(spark, house.fact), read_refused(spark, house.refused, house.fact), read_rollups(spark, house.rollups, house.fact)
        )]

    before = seen()
    assert set(sweep_warehouse(spark, house).values()) == {0}
    # September's first version in three tables; October's that was not published in two.
    assert sweep_warehouse(spark, house, hours=0) == {
        "tally": 0, "rejects": 0, "daily": 0, "monthly": 0, "fact": 2, "refused": 1, "rollups": 2,
    }
    assert seen() == before and set(sweep_warehouse(spark, house, hours=0).values()) == {0}
