"""One query per operator, over the given tables.

Dates are shown as text, and -1 or '' stands for NULL, so that a comparison of
results needs no rule for either.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyhouse import operators as op
from tallyhouse import sinks, sources
from tallyhouse.functions import (
    calendar_day, clock_text, file_clock_of, file_date_of, month_key, path_dump_name,
)
from tallyhouse.plans import (
    RunAudit, Warehouse, combine_days, convert, load_fact, report, to_months,
)
from tallyhouse.schemas import DIM_DATE, DIM_DATE_TEXT_LIMITS, LOAD_COLUMNS
from tallyhouse.session import scratch_folder
from tallyhouse.streaming import ingest_available, stream_dumps, stream_hourly
from tallyhouse.workload.mapping import (
    PAGES, raw, raw_dense, raw_dirty, raw_long,
)

# Round trips write the dumps before this date first and the others later.
CUT = "2024-01-16"


def shown(rows: DataFrame) -> DataFrame:
    """Dates as text."""
    return rows.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType)
        else F.col(f.name)
        for f in rows.schema.fields
    ])


def hourly_of(lines: DataFrame) -> DataFrame:
    return op.hourly_pageviews(op.keep_pages(op.split_lines(lines), PAGES))


def fact_of(lines: DataFrame) -> DataFrame:
    return op.calendar_keys(hourly_of(lines)).select(*LOAD_COLUMNS)


def dump_names(lines: DataFrame) -> DataFrame:
    return lines.select("file_name").distinct()


def dims(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return op.dim_date_between(spark), op.dim_time(sources.hours_between(spark))


def before_cut(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    first_late = "pageviews-" + CUT.replace("-", "")
    return lines.where(F.col("file_name") < first_late), lines.where(F.col("file_name") >= first_late)


def data_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine over the dates of the line items' dumps."""
    dumps = op.dumps_of(raw_long(spark, sf_dir))
    return sources.date_spine(
        dumps.agg(F.min("file_date").alias("start"), F.max("file_date").alias("end"))
    )


def data_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours the events' dumps have."""
    hour = F.substring("file_time", 1, 2).cast("int")
    return op.dumps_of(raw(spark, sf_dir)).select(hour.alias("hour")).distinct()


# --- sources ----------------------------------------------------------------

def scan_dump_text(spark, sf_dir):
    folder = scratch_folder(spark, "dumps")
    sinks.land_dumps(raw(spark, sf_dir), folder)
    return sources.read_dumps(spark, folder)


def expected_hour_manifest(spark, sf_dir):
    days = op.dumps_of(raw_long(spark, sf_dir)).select("file_date").distinct()
    rebuilt = days.select(calendar_day(
        F.year("file_date"), F.month("file_date"), F.dayofmonth("file_date")
    ).alias("date"))
    return shown(sources.expected_dumps(rebuilt))


def missing_hours(spark, sf_dir):
    days = data_days(spark, sf_dir)
    missing = sources.missing_dumps(sources.expected_dumps(days), raw_long(spark, sf_dir))
    return shown(missing.select("file_date", "hour", "file_name"))


def gz_magic_audit(spark, sf_dir):
    folder = scratch_folder(spark, "audit")
    early, late = before_cut(raw(spark, sf_dir))
    sinks.land_dumps(early, folder)
    sinks.land_dumps(late, folder, compression="none")
    return sources.audit_dumps(spark, folder).select("file_name", "verdict").distinct()


def gz_deep_audit(spark, sf_dir):
    """The late dumps are cut short: each part of theirs lacks its last six bytes."""
    folder, whole = scratch_folder(spark, "audit"), scratch_folder(spark, "whole-dumps")
    early, late = before_cut(raw(spark, sf_dir))
    sinks.land_dumps(early, folder)
    sinks.land_dumps(late, whole)
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(whole)
    cut = F.expr("substring(content, 1, cast(length as int) - 6)").cast("string")
    short = parts.select(cut.alias("value"), path_dump_name(F.col("path")).alias("file_name"))
    short.write.mode("append").partitionBy("file_name").text(folder)
    return sources.audit_dumps(spark, folder, deep=True).select("file_name", "verdict").distinct()


def scan_hourly_schema(spark, sf_dir):
    folder = scratch_folder(spark, "hourly")
    sinks.write_hourly(hourly_of(raw(spark, sf_dir)), folder)
    return shown(sources.read_hourly(spark, folder))


def scan_daily_schema(spark, sf_dir):
    folder = scratch_folder(spark, "daily")
    sinks.write_daily(hourly_of(raw_dense(spark, sf_dir)), folder)
    daily = sources.read_daily(spark, folder)
    return shown(daily.withColumn("file_month", month_key(F.col("file_date"))))


def scan_month_schema(spark, sf_dir):
    folder = scratch_folder(spark, "monthly")
    keyed = op.calendar_keys(hourly_of(raw_long(spark, sf_dir)))
    sinks.write_monthly(keyed, folder)
    return sources.read_monthly(spark, folder)


def date_spine(spark, sf_dir):
    return shown(data_days(spark, sf_dir))


def hour_spine(spark, sf_dir):
    return sources.hour_spine(data_hours(spark, sf_dir))


# --- sinks ------------------------------------------------------------------

def write_hourly_roundtrip(spark, sf_dir):
    """First the early dumps, then those the ledger does not have, then nothing."""
    folder, ledger = scratch_folder(spark, "hourly"), scratch_folder(spark, "ledger")
    lines = raw(spark, sf_dir)
    early, _ = before_cut(lines)
    sinks.write_hourly(hourly_of(early), folder)
    sinks.append_ledger(op.ledger_rows(early, "hourly", "1"), ledger)
    for batch in ("2", "3"):
        done = sources.read_ledger(spark, ledger)
        waiting = op.pending(dump_names(lines), done, "hourly")
        sinks.write_hourly(hourly_of(lines.join(waiting, "file_name", "left_semi")), folder)
        sinks.append_ledger(op.ledger_rows(waiting, "hourly", batch), ledger)
    return shown(sources.read_hourly(spark, folder))


def write_daily_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark, "daily")
    hourly = hourly_of(raw(spark, sf_dir))
    sinks.write_daily(hourly, folder)
    sinks.write_daily(hourly, folder)
    return shown(sources.read_daily(spark, folder))


def write_month_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark, "monthly")
    keyed = op.calendar_keys(hourly_of(raw_dense(spark, sf_dir)))
    sinks.write_monthly(keyed, folder)
    sinks.write_monthly(keyed, folder)
    return sources.read_monthly(spark, folder)


def dim_replace_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark, "dim-date")
    days = data_days(spark, sf_dir)
    dim = op.dim_date(days)
    sinks.replace_dimension(op.dim_date(days, weekend_days=(5, 6)), folder)
    sinks.replace_dimension(dim, folder)
    return shown(spark.read.schema(dim.schema).parquet(folder))


def _long_fact(spark, sf_dir):
    """Facts of the line items with the month set each came from."""
    keyed = op.calendar_keys(hourly_of(raw_long(spark, sf_dir)))
    return op.with_fact_id(
        keyed.select(*LOAD_COLUMNS, month_key(F.col("file_date")).alias("load_month"))
    )


def fact_partitioned_write(spark, sf_dir):
    folder = scratch_folder(spark, "fact")
    sinks.write_fact(_long_fact(spark, sf_dir), folder)
    return sources.read_fact(spark, folder)


def fact_reload_idempotent(spark, sf_dir):
    folder = scratch_folder(spark, "fact")
    fact = _long_fact(spark, sf_dir)
    sinks.write_fact(fact, folder)
    sinks.write_fact(fact.where(F.col("load_month").startswith("2018-")), folder)
    return sources.read_fact(spark, folder)


def fact_reload_shrunk(spark, sf_dir):
    """Months of 2018 loaded again without their midnights: what was there goes."""
    folder = scratch_folder(spark, "fact")
    fact = _long_fact(spark, sf_dir)
    of_2018 = F.col("load_month").startswith("2018-")
    months = fact.where(of_2018).select("load_month").distinct()
    sinks.write_fact(fact, folder)
    sinks.write_fact(fact.where(of_2018 & (F.col("time_id") > 0)), folder, months=months)
    return sources.read_fact(spark, folder)


def processed_ledger(spark, sf_dir):
    folder = scratch_folder(spark, "ledger")
    early, late = before_cut(raw(spark, sf_dir))
    sinks.append_ledger(op.ledger_rows(early, "hourly", "1"), folder)
    sinks.append_ledger(op.ledger_rows(late, "hourly", "2"), folder)
    sinks.append_ledger(op.ledger_rows(early, "daily", "1"), folder)
    sinks.append_ledger(op.ledger_rows(late, "hourly", "2"), folder)
    return sources.read_ledger(spark, folder)


# --- parsing, stamps, keys, gates -------------------------------------------

def parse_lines(spark, sf_dir):
    parsed = op.split_lines(raw_dirty(spark, sf_dir))
    return parsed.select(
        "file_name", "domain", "pagename", F.coalesce("pageview", F.lit(-1)).alias("pageview")
    )


def page_filter(spark, sf_dir):
    kept = op.keep_pages(op.split_lines(raw(spark, sf_dir)), PAGES)
    return kept.select("file_name", "domain", "pagename", "pageview")


def page_filter_semi(spark, sf_dir):
    """The list is a table: the pages of customers in debt."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal < 0")
    listed = customers.select(
        F.concat(F.lit("page"), (F.col("c_custkey") * 3 % 15).cast("string")).alias("pagename")
    )
    kept = op.keep_listed_pages(op.split_lines(raw(spark, sf_dir)), listed)
    return kept.select("file_name", "domain", "pagename", "pageview")


def collection_stamp(spark, sf_dir):
    return shown(op.stamp(raw(spark, sf_dir)))


def file_name_parse(spark, sf_dir):
    name = F.col("file_name")
    return dump_names(raw_dirty(spark, sf_dir)).select(
        "file_name",
        F.coalesce(file_date_of(name).cast("string"), F.lit("")).alias("file_date"),
        F.coalesce(clock_text(file_clock_of(name)), F.lit("")).alias("file_time"),
    )


def calendar_keys(spark, sf_dir):
    return shown(op.calendar_keys(hourly_of(raw(spark, sf_dir))))


def load_frame(spark, sf_dir):
    return op.load_frame(op.calendar_keys(hourly_of(raw_long(spark, sf_dir))))


def complete_days(spark, sf_dir):
    return shown(op.complete_days(raw_dense(spark, sf_dir)))


def gate_day(spark, sf_dir):
    lines = raw(spark, sf_dir)
    return shown(op.gate_days(hourly_of(lines), op.complete_days(lines)))


def _long_days(spark, sf_dir):
    return op.dumps_of(raw_long(spark, sf_dir)).select("file_date").distinct()


def complete_months(spark, sf_dir):
    return op.complete_months(_long_days(spark, sf_dir))


def gate_month(spark, sf_dir):
    complete = op.complete_months(_long_days(spark, sf_dir))
    return shown(op.gate_months(hourly_of(raw_long(spark, sf_dir)), complete))


def hour_domain_check(spark, sf_dir):
    return op.hour_violations(fact_of(raw(spark, sf_dir, hour_shift=10)), "time_id")


# --- joins, aggregates, windows, unions -------------------------------------

def pending_files(spark, sf_dir):
    lines = raw(spark, sf_dir)
    early, _ = before_cut(lines)
    return op.pending(dump_names(lines), op.ledger_rows(early, "hourly", "1"), "hourly")


def star_join(spark, sf_dir):
    return shown(op.star_join(fact_of(raw(spark, sf_dir)), *dims(spark)))


def hourly_pageviews(spark, sf_dir):
    return shown(hourly_of(raw(spark, sf_dir)))


def hourly_pageviews_long(spark, sf_dir):
    return shown(hourly_of(raw_long(spark, sf_dir)))


def day_row_counts(spark, sf_dir):
    return shown(op.row_counts(hourly_of(raw_long(spark, sf_dir)), "file_date"))


def views_by_weekday(spark, sf_dir):
    return op.views_by(fact_of(raw(spark, sf_dir)), *dims(spark), "day_name", "is_weekend")


def views_by_month(spark, sf_dir):
    return op.views_by(
        fact_of(raw_long(spark, sf_dir)), *dims(spark), "year", "quarter", "month", "month_name"
    )


def views_by_hour(spark, sf_dir):
    return op.views_by(
        fact_of(raw_long(spark, sf_dir)), *dims(spark), "time_id", "time_creation", "domain"
    )


def views_of_quarter(spark, sf_dir):
    """Second quarters from the written fact: a condition on dim_date alone."""
    folder, dates = scratch_folder(spark, "fact"), scratch_folder(spark, "dim-date")
    sinks.write_fact(_long_fact(spark, sf_dir), folder)
    dim_date, dim_time = dims(spark)
    sinks.replace_dimension(dim_date, dates)
    second = spark.read.schema(DIM_DATE).parquet(dates).where("quarter = 2")
    return op.views_by(sources.read_fact(spark, folder), second, dim_time, "year", "month_name", "pagename")


def _kept_sums(spark, sf_dir):
    """All months loaded, and those of 2018 again without their midnights."""
    house, monthly = Warehouse(scratch_folder(spark, "warehouse")), _monthly(spark, sf_dir)
    of_2018 = F.col("file_month").startswith("2018-")
    load_fact(spark, monthly, house.fact, *dims(spark), rollups_path=house.rollups)
    load_fact(
        spark, monthly.where(of_2018 & (F.col("time_id") > 0)), house.fact, *dims(spark), rollups_path=house.rollups
    )
    return house


def kept_views_by_weekday(spark, sf_dir):
    """A report from kept sums, after a reload that shrinks months."""
    dim_date, dim_time = dims(spark)
    return report(spark, _kept_sums(spark, sf_dir), "day_name", "is_weekend", dim_date=dim_date, dim_time=dim_time)


def kept_views_by_page(spark, sf_dir):
    """The same by month and page, from the sums that have pages."""
    dim_date, dim_time = dims(spark)
    return report(spark, _kept_sums(spark, sf_dir), "year", "month", "pagename", dim_date=dim_date, dim_time=dim_time)


def fact_surrogate_key(spark, sf_dir):
    return op.with_fact_id(fact_of(raw_long(spark, sf_dir)))


def hourly_sorted(spark, sf_dir):
    return shown(op.ordered_hours(hourly_of(raw(spark, sf_dir))))


def combine_day(spark, sf_dir):
    """The hourly sets of the early and the late dumps as one."""
    early, late = before_cut(raw(spark, sf_dir))
    return shown(op.combine(hourly_of(early), hourly_of(late)))


def combine_month(spark, sf_dir):
    """Day sets of the complete months, with calendar keys."""
    lines = raw_dense(spark, sf_dir)
    months = op.complete_months(op.complete_days(lines))
    return shown(op.calendar_keys(op.gate_months(hourly_of(lines), months)))


def dim_date(spark, sf_dir):
    return shown(op.dim_date(data_days(spark, sf_dir)))


def dim_date_two_day_weekend(spark, sf_dir):
    weekend_days = op.dim_date(data_days(spark, sf_dir), weekend_days=(5, 6))
    return weekend_days.select("date_id", "day_name", "is_weekend")


def dim_time(spark, sf_dir):
    return op.dim_time(data_hours(spark, sf_dir))


# --- constraints ------------------------------------------------------------

def not_null_violations(spark, sf_dir):
    """Groups with malformed counts only, and each column set NULL at some hours."""
    hour = F.col("time_id") % 8
    planted = fact_of(raw_dirty(spark, sf_dir)).select(*[
        F.when(hour != n, F.col(name)).alias(name) for n, name in enumerate(LOAD_COLUMNS)
    ])
    broken = op.not_null_violations(planted)
    return broken.select(
        *[F.coalesce(name, F.lit("" if kind == "string" else -1)).alias(name) for name, kind in planted.dtypes],
        "null_columns",
    )


def length_violations(spark, sf_dir):
    """Domains and pages made longer by repeating them, some over the limit."""
    fact = fact_of(raw(spark, sf_dir, domain=F.repeat("event_type", F.lit(5))))
    return op.length_violations(fact.withColumn("pagename", F.repeat("pagename", F.col("time_id") % 8 + 1)))


def dim_text_violations(spark, sf_dir):
    """Names of months and days repeated, some over the limits of dim_date."""
    dates = op.dim_date(data_days(spark, sf_dir)).withColumns({
        "month_name": F.repeat("month_name", F.col("quarter")), "day_name": F.repeat("day_name", F.col("day") % 2 + 1),
    })
    broken = op.length_violations(dates, DIM_DATE_TEXT_LIMITS)
    return broken.select("date_id", "month_name", "day_name", "long_columns")


def partition_range_violations(spark, sf_dir):
    """Line items moved to 2027-2033: from 2031 on there is no partition."""
    return op.partition_range_violations(fact_of(raw_long(spark, sf_dir, years=32)))


def pk_violations(spark, sf_dir):
    """Facts and, once more, those of midnight."""
    fact = op.with_fact_id(fact_of(raw(spark, sf_dir)))
    return op.pk_violations(fact.union(fact.where("time_id = 0")), ["fact_id", "year", "month"])


def pk_natural_violations(spark, sf_dir):
    """The key that fact_id is made from, over the same rows."""
    fact = fact_of(raw(spark, sf_dir))
    return op.pk_violations(fact.union(fact.where("time_id = 0")), ["date_id", "time_id", "domain", "pagename"])


def pk_dim_violations(spark, sf_dir):
    """Both dimensions and, once more, part of their rows."""
    dates = op.dim_date(data_days(spark, sf_dir)).select(F.col("date_id").alias("key"))
    times = op.dim_time(data_hours(spark, sf_dir)).select(F.col("time_id").alias("key"))
    twice = [(name, rows.union(rows.where("key % 7 = 0"))) for name, rows in (("dim_date", dates), ("dim_time", times))]
    found = [op.pk_violations(rows, ["key"]).select(F.lit(name).alias("dimension"), "key", "copies") for name, rows in twice]
    return found[0].union(found[1])


def fk_date_violations(spark, sf_dir):
    """Line items moved to 2023-2029: dim_date ends with 2025."""
    fact = fact_of(raw_long(spark, sf_dir, years=28))
    return op.fk_violations(fact, dims(spark)[0], "date_id")


def fk_time_violations(spark, sf_dir):
    """Hours moved by ten: those over 23 are not in dim_time."""
    fact = fact_of(raw(spark, sf_dir, hour_shift=10))
    return op.fk_violations(fact, dims(spark)[1], "time_id")


def broken_rules(spark, sf_dir):
    """All constraints at once, each planted at an hour of the day."""
    hour = F.col("time_id")
    fact = fact_of(raw_long(spark, sf_dir))
    planted = fact.union(fact.where(hour == 6)).select(
        F.when(hour == 4, F.col("date_id") + 300_000).otherwise(F.col("date_id")).alias("date_id"),
        F.when(hour == 5, hour + 24).otherwise(hour).alias("time_id"),
        F.when(hour != 1, F.col("domain")).alias("domain"),
        F.when(hour == 2, F.repeat("pagename", F.lit(8))).otherwise(F.col("pagename")).alias("pagename"),
        "sumpageviewcount", F.when(hour == 3, F.col("year") + 100).otherwise(F.col("year")).alias("year"), "month",
    )
    folder, keys = scratch_folder(spark, "checked-facts"), ["fact_id", "year", "month"]
    op.with_broken_rules(op.with_fact_id(planted), *dims(spark)).write.parquet(folder)
    checked = spark.read.parquet(folder)
    return op.rule_counts(op.with_repeated_keys(checked, op.repeated_keys(checked, keys), keys))


def _monthly(spark, sf_dir):
    """Month sets of the line items, by the month of their dumps."""
    keyed = op.calendar_keys(hourly_of(raw_long(spark, sf_dir)))
    return keyed.select(*LOAD_COLUMNS, month_key(F.col("file_date")).alias("file_month"))


def pk_load_violations(spark, sf_dir):
    """The months before 2018-03 are loaded, then the others; among these are some rows
    of 2018-02 once more. Their keys are reported with both months."""
    folder, monthly = scratch_folder(spark, "fact"), _monthly(spark, sf_dir)
    load_fact(spark, monthly.where("file_month < '2018-03'"), folder, *dims(spark))
    planted = monthly.where("file_month = '2018-02' and time_id = 3").withColumn("file_month", F.lit("2018-03"))
    later = monthly.where("file_month >= '2018-03'").unionByName(planted)
    rows = op.with_fact_id(later.select(*LOAD_COLUMNS, F.col("file_month").alias("load_month")))
    return op.key_clashes(rows, sources.read_fact(spark, folder), ["fact_id", "year", "month"])


def fact_load_refused(spark, sf_dir):
    """The same rows through the load: the planted ones are refused, the others are in."""
    house, monthly = Warehouse(scratch_folder(spark, "warehouse")), _monthly(spark, sf_dir)
    load_fact(spark, monthly.where("file_month < '2018-03'"), house.fact, *dims(spark))
    planted = monthly.where("file_month = '2018-02' and time_id = 3").withColumn("file_month", F.lit("2018-03"))
    later = monthly.where("file_month >= '2018-03'").unionByName(planted)
    load_fact(spark, later, house.fact, *dims(spark), house.refused)
    refused = sources.read_refused(spark, house.refused, house.fact)
    return sources.read_fact(spark, house.fact).withColumn("broken_rules", F.lit("")).unionByName(refused)


def line_rejects(spark, sf_dir):
    return op.line_rejects(op.split_lines(raw_dirty(spark, sf_dir)))


def line_tally(spark, sf_dir):
    """Lines by outcome and dump, from the one-pass tally."""
    tallies = op.tally(raw_dirty(spark, sf_dir), PAGES)
    return tallies.groupBy("file_name", "outcome").agg(
        F.sum("lines").alias("lines"),
        F.sum(F.coalesce("sumpageviewcount", F.lit(0))).alias("views"),
    )


# --- streaming, audit, jobs --------------------------------------------

def incremental_ingest(spark, sf_dir):
    """Early dumps land and are ingested, then the late ones; a last run finds none."""
    folder, tallies = scratch_folder(spark, "dumps"), scratch_folder(spark, "tally")
    checkpoint = scratch_folder(spark, "stream")
    for part in before_cut(raw(spark, sf_dir)):
        sinks.land_dumps(part, folder)
        ingest_available(stream_dumps(spark, folder), tallies, checkpoint, PAGES)
    ingest_available(stream_dumps(spark, folder), tallies, checkpoint, PAGES)
    return shown(stream_hourly(spark, tallies))


def run_audit(spark, sf_dir):
    """The first midnight dump belongs to 2014, before dim_date: it is refused."""
    house = Warehouse(scratch_folder(spark, "warehouse"))
    audit = RunAudit(spark, house.audit)
    monthly = to_months(spark, raw_dense(spark, sf_dir), house, "1", PAGES, audit=audit)
    load_fact(spark, monthly, house.fact, *dims(spark), house.refused, audit)
    return audit.read().select("stage", "message", F.col("metrics")["rows"].alias("rows"))


def dumps_to_months(spark, sf_dir):
    house = Warehouse(scratch_folder(spark, "warehouse"))
    return to_months(spark, raw_dense(spark, sf_dir), house, "1", PAGES)


def ingest_twice_same_batch(spark, sf_dir):
    """First some dumps, then all of them under the same batch id."""
    house = Warehouse(scratch_folder(spark, "warehouse"))
    lines = raw_dense(spark, sf_dir)
    to_months(spark, lines.where(F.col("file_name") < "pageviews-20150120"), house, "1", PAGES)
    return to_months(spark, lines, house, "1", PAGES)


def ingest_resumed(spark, sf_dir):
    """One run stops before its rejects are written, one after the conversion, the next
    after the days; the last goes on."""
    house = Warehouse(scratch_folder(spark, "warehouse"))
    lines = raw_dense(spark, sf_dir)
    sinks.write_tally(op.tally(lines, PAGES), house.tally, "0", version="stopped")
    convert(spark, lines.where(F.col("file_name") < "pageviews-20150120"), house, "1", PAGES)
    convert(spark, lines, house, "2", PAGES)
    combine_days(spark, house, "2")
    return to_months(spark, lines, house, "3", PAGES)


def months_to_fact(spark, sf_dir):
    house = Warehouse(scratch_folder(spark, "warehouse"))
    complete = op.complete_months(_long_days(spark, sf_dir))
    gated = op.gate_months(hourly_of(raw_long(spark, sf_dir)), complete)
    sinks.write_monthly(op.calendar_keys(gated), house.monthly)
    monthly = sources.read_monthly(spark, house.monthly)
    load_fact(spark, monthly, house.fact, *dims(spark))
    return sources.read_fact(spark, house.fact)


QUERIES = {
    query.__name__: query
    for query in (
        scan_dump_text, expected_hour_manifest, missing_hours, gz_magic_audit, gz_deep_audit,
        scan_hourly_schema, scan_daily_schema, scan_month_schema, date_spine, hour_spine,
        write_hourly_roundtrip, write_daily_roundtrip, write_month_roundtrip,
        dim_replace_roundtrip, fact_partitioned_write, fact_reload_idempotent, fact_reload_shrunk,
        processed_ledger, parse_lines, page_filter, page_filter_semi, collection_stamp,
        file_name_parse, calendar_keys, load_frame, complete_days, gate_day, complete_months,
        gate_month, hour_domain_check, pending_files, star_join, hourly_pageviews,
        hourly_pageviews_long, day_row_counts, views_by_weekday, views_by_month,
        views_by_hour, views_of_quarter, kept_views_by_weekday, kept_views_by_page, fact_surrogate_key, hourly_sorted, combine_day, combine_month,
        dim_date, dim_date_two_day_weekend, dim_time, not_null_violations, length_violations, dim_text_violations,
        partition_range_violations, pk_violations, pk_natural_violations, pk_dim_violations,
        pk_load_violations, fact_load_refused, fk_date_violations, fk_time_violations,
        broken_rules, line_rejects, line_tally, incremental_ingest, run_audit,
        dumps_to_months, ingest_twice_same_batch, ingest_resumed, months_to_fact,
    )
}
