"""The warehouse's jobs: dumps to month sets, month sets to facts, dimensions.

A stage's work is what the stage before has and its ledger lacks, and the ledger is
written last. So a job that was stopped goes on where it was, whatever its batch id,
and one that runs again finds nothing to do.
"""

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyhouse.functions import file_date_of, month_key
from tallyhouse.operators import (
    calendar_keys, complete_days, complete_months, dim_date_between, dim_time, gate_days,
    gate_months, grain_for, hourly_of_tally, ledger_rows, length_violations, pending, pk_violations,
    repeated_keys, rollups_of, rule_counts, tally, views_by, views_from_rollups, with_broken_rules,
    with_fact_id, with_repeated_keys,
)
from tallyhouse.plans.audit import RunAudit
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.schemas import (
    COMPANY_PAGES, DIM_DATE, DIM_DATE_END, DIM_DATE_START, DIM_DATE_TEXT_LIMITS, DIM_TIME,
    FACT_COLUMNS, LOAD_COLUMNS,
)
from tallyhouse.session import scratch_folders
from tallyhouse.sinks import (
    append_jdbc, append_ledger, observed, replace_dimension, write_daily, write_fact,
    write_hourly, write_monthly, write_refused, write_rollups,
)
from tallyhouse.sources import (
    audit_dumps, hours_between, list_dumps, one_place_each, read_daily, read_dumps, read_fact,
    read_ledger, read_monthly, read_rollups, read_tally,
)
from tallyhouse.streaming import ingest_available, stream_hourly, tally_new
from tallyhouse.versions import key_text, new_version, publish, sweep


class ConstraintError(ValueError):
    """Rows break a constraint of the warehouse."""


FACT_KEY = ["fact_id", "year", "month"]


def _staged(rows: DataFrame, folder: str) -> DataFrame:
    """The rows, written to a folder and read from there."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _noted(spark: SparkSession, warehouse: Warehouse, stage: str) -> DataFrame:
    return read_ledger(spark, warehouse.ledger).where(F.col("stage") == stage).select("file_name")


def _names(rows: DataFrame, column: str) -> list[str]:
    """Values of a column of days or months, in order: as many as the calendar has."""
    return sorted(row[column] for row in rows.select(column).distinct().collect())


def convert(
    spark: SparkSession, lines: DataFrame, warehouse: Warehouse, batch_id: str,
    pages: Sequence[str] = COMPANY_PAGES, files: DataFrame | None = None,
    audit: RunAudit | None = None,
) -> None:
    """Dump lines to tallies: hourly sums, rejects, and the names of all dumps.

    The lines are read once. Dumps that are in the tally already are left out.
    `files` lists the dumps present (file_name), so that one without a single line
    is noted too. Each call writes a part of its own, so a batch id may be used
    again.
    """
    seen, attempt = Observation(), f"{batch_id}-{uuid.uuid4().hex}"
    tally_new(spark, tally(lines, pages), warehouse.tally, attempt, attempt, warehouse.rejects, seen, files)
    if audit:
        audit.record("hourly", "lines tallied by hour", rows=observed(seen)["rows"])


def _open_tallies(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Tallies of well-named dumps, without the months that are done: their folders
    are not read."""
    done = _names(_noted(spark, warehouse, "monthly"), "file_name")
    return read_tally(spark, warehouse.tally).where(~F.col("file_month").isin(done))


def combine_days(
    spark: SparkSession, warehouse: Warehouse, batch_id: str, audit: RunAudit | None = None
) -> None:
    """Tallies to day sets, for the days that have all their dumps and are in no
    ledger. The gate is asked of the dumps that were tallied, after they were."""
    tallies = _open_tallies(spark, warehouse)
    files = tallies.select("file_name", "file_date").distinct()
    done = _noted(spark, warehouse, "daily").select(F.col("file_name").cast("date").alias("file_date"))
    found = _names(complete_days(files).join(done, "file_date", "left_anti"), "file_date")
    days = spark.createDataFrame([(day,) for day in found], "file_date date")
    months = sorted({day.strftime("%Y-%m") for day in found})
    seen = Observation()
    waiting = gate_days(tallies.where(F.col("file_month").isin(months)), days)
    write_daily(hourly_of_tally(waiting), warehouse.daily, seen, days)
    hours = gate_days(files, days)
    named = days.select(F.col("file_date").cast("string").alias("file_name"))
    noted = ledger_rows(hours, "hourly", batch_id).union(ledger_rows(named, "daily", batch_id))
    append_ledger(noted, warehouse.ledger)
    if audit:
        audit.record("daily", "day sets written", rows=observed(seen)["rows"])


def combine_months(
    spark: SparkSession, warehouse: Warehouse, batch_id: str, audit: RunAudit | None = None
) -> None:
    """Day sets to month sets, for the months that have all their days and are in no
    ledger."""
    days = _noted(spark, warehouse, "daily").select(F.col("file_name").cast("date").alias("file_date"))
    done = _noted(spark, warehouse, "monthly").select(F.col("file_name").alias("file_month"))
    found = _names(complete_months(days).join(done, "file_month", "left_anti"), "file_month")
    months = spark.createDataFrame([(month,) for month in found], "file_month string")
    keyed = calendar_keys(gate_months(read_daily(spark, warehouse.daily), months))
    seen = Observation()
    write_monthly(keyed, warehouse.monthly, seen, months)
    append_ledger(ledger_rows(months.select(F.col("file_month").alias("file_name")), "monthly", batch_id), warehouse.ledger)
    if audit:
        audit.record("monthly", "month sets written", rows=observed(seen)["rows"])


def to_months(
    spark: SparkSession, lines: DataFrame, warehouse: Warehouse, batch_id: str,
    pages: Sequence[str] = COMPANY_PAGES, files: DataFrame | None = None,
    audit: RunAudit | None = None,
) -> DataFrame:
    """Dump lines to hourly sums, day and month sets; returns the month sets."""
    convert(spark, lines, warehouse, batch_id, pages, files, audit)
    combine_days(spark, warehouse, batch_id, audit)
    combine_months(spark, warehouse, batch_id, audit)
    return read_monthly(spark, warehouse.monthly)


def ingest_stream(
    spark: SparkSession, lines: DataFrame, warehouse: Warehouse, batch_id: str,
    pages: Sequence[str] = COMPANY_PAGES, audit: RunAudit | None = None,
) -> DataFrame:
    """to_months for a stream of dumps: tallies what is new, then combines the
    days that have become complete with it."""
    ingest_available(lines, warehouse.tally, warehouse.stream_checkpoint, pages, warehouse.rejects)
    combine_days(spark, warehouse, batch_id, audit)
    combine_months(spark, warehouse, batch_id, audit)
    return read_monthly(spark, warehouse.monthly)


def ingest_folder(
    spark: SparkSession, folder: str, warehouse: Warehouse, batch_id: str,
    pages: Sequence[str] = COMPANY_PAGES, start: str | None = None, end: str | None = None,
    check: bool = False, audit: RunAudit | None = None,
) -> int:
    """Convert the dumps of a folder, and all below it, that are not tallied yet.

    Only days with all 24 dumps are read; dumps that are tallied already count for
    their day. A dump that lies there twice is read from one place, and the audit
    tells of the other. `start` and `end` (ISO dates, both included) narrow the file
    dates. With `check`, dumps that do not decompress are found first and their days
    left out; without it such a dump fails the job. Returns how many dumps were
    converted.

    Dumps are converted a month at a time, so the driver holds the paths of one
    month, and a stopped job keeps the months it has finished.
    """
    found = list_dumps(spark, folder).withColumn("file_date", file_date_of(F.col("file_name")))
    found = found.where(F.col("file_date").isNotNull())
    if start:
        found = found.where(F.col("file_date") >= F.lit(start).cast("date"))
    if end:
        found = found.where(F.col("file_date") <= F.lit(end).cast("date"))
    with scratch_folders(spark) as scratch:
        found = _staged(found.withColumn("file_month", month_key(F.col("file_date"))), scratch("dumps-found"))
        places = one_place_each(found)
        if audit:
            copies = found.join(places, ["file_name", "place"], "left_anti").select("file_name", "place").distinct()
            named = [f"{row.file_name} lies also at {row.place}" for row in copies.toLocalIterator()]
            if named:
                audit.record_each("copies", named)
        tallied = _staged(
            read_tally(spark, warehouse.tally).where("file_date is not null").select("file_name").distinct(), scratch("tallied")
        )
        waiting = places.join(tallied, "file_name", "left_anti")
        converted = 0
        for month in _names(waiting, "file_month"):
            own = waiting.where(F.col("file_month") == month)
            paths = _paths_of_complete_days(own, tallied)
            if check and paths:
                verdicts = audit_dumps(spark, paths, deep=True).where("verdict <> 'ok'")
                damaged = [(row.file_name, row.verdict) for row in verdicts.collect()]
                if damaged:
                    bad = spark.createDataFrame(damaged, "file_name string, verdict string")
                    paths = _paths_of_complete_days(own.join(bad, "file_name", "left_anti"), tallied)
                    if audit:
                        audit.record_each("check", [f"{name} is {verdict}" for name, verdict in damaged])
            if paths:
                files = own.where(F.col("path").isin(paths)).select("file_name").distinct()
                convert(spark, read_dumps(spark, paths), warehouse, batch_id, pages, files, audit)
                converted += files.count()
    combine_days(spark, warehouse, batch_id, audit)
    combine_months(spark, warehouse, batch_id, audit)
    return converted


def _paths_of_complete_days(files: DataFrame, tallied: DataFrame) -> list[str]:
    """Paths of a month's files whose days are complete with what is tallied."""
    ready = gate_days(files, complete_days(files.select("file_name").union(tallied)))
    return [row.path for row in ready.select("path").collect()]


def write_hours(
    spark: SparkSession, warehouse: Warehouse, start: str | None = None, end: str | None = None
) -> None:
    """Hourly sets, a folder for each dump, from the tallies of these dates."""
    write_hourly(stream_hourly(spark, warehouse.tally, start, end), warehouse.hourly)


def build_dimensions(
    spark: SparkSession, warehouse: Warehouse,
    start: str = DIM_DATE_START, end: str = DIM_DATE_END,
) -> None:
    """Build, check and replace dim_date and dim_time."""
    dates = dim_date_between(spark, start, end)
    times = dim_time(hours_between(spark))
    broken = {
        "dim_date.date_id": pk_violations(dates, ["date_id"]),
        "dim_time.time_id": pk_violations(times, ["time_id"]),
        "dim_date text": length_violations(dates, DIM_DATE_TEXT_LIMITS),
    }
    for what, rows in broken.items():
        if not rows.isEmpty():
            raise ConstraintError(f"{what}: constraint broken")
    replace_dimension(dates, warehouse.dim_date)
    replace_dimension(times, warehouse.dim_time)


def checked_months(
    spark: SparkSession, monthly: DataFrame, dim_date: DataFrame, dim_time: DataFrame,
    scratch: Callable[[str], str], fact_path: str, months: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, int], list[str]]:
    """Month sets with `load_month`, fact_id and the constraints each row breaks; the
    rows that break each; and the months that have rows or are in `months`.

    Keys have to be unique in these rows and in what is loaded at `fact_path` from other
    months, as these are replaced. Of that the partitions of these rows are read, and of
    those the key. The rows are checked once and written to scratch.
    """
    rows = monthly.select(*LOAD_COLUMNS, F.col("file_month").alias("load_month"))
    checked = _staged(with_broken_rules(with_fact_id(rows), dim_date, dim_time), scratch("checked-facts"))
    partition = F.col("year") * 100 + F.col("month")
    found = checked.agg(
        F.collect_set(key_text("load_month")).alias("months"), F.collect_set(partition).alias("partitions"),
        F.count_if(F.col("broken_rules") != "").alias("broken"),
    ).first()
    owned = sorted({*(months or []), *found.months})
    loaded = read_fact(spark, fact_path).where(~F.col("load_month").isin(owned)).where(partition.isin(found.partitions))
    repeated = _staged(repeated_keys(checked, FACT_KEY, loaded), scratch("repeated-keys"))
    if found.broken == 0 and repeated.isEmpty():
        return checked, {}, owned
    checked = with_repeated_keys(checked, repeated, FACT_KEY)
    return checked, {row["rule"]: row["rows"] for row in rule_counts(checked).collect()}, owned


def load_fact(
    spark: SparkSession, monthly: DataFrame, fact_path: str,
    dim_date: DataFrame, dim_time: DataFrame, refused_path: str | None = None,
    audit: RunAudit | None = None, months: Sequence[str] | None = None,
    rollups_path: str | None = None,
) -> None:
    """Month sets to the partitioned fact table.

    Rows that break a constraint, the primary key's included, stop the load before
    anything is written, as they would in a database; with `refused_path` they are
    kept there instead and the rest is loaded. Each of the `months` (yyyy-MM, by
    default those that have rows) is replaced whole, in all tables: facts, refused rows
    and, with `rollups_path`, kept sums are one version, published at the end.
    """
    with scratch_folders(spark) as scratch:
        checked, counts, owned = checked_months(spark, monthly, dim_date, dim_time, scratch, fact_path, months)
        if counts and refused_path is None:
            raise ConstraintError(f"rows breaking constraints: {counts}")
        version = new_version()
        if refused_path is not None:
            write_refused(checked.where(F.col("broken_rules") != ""), refused_path, version)
        good = checked.where(F.col("broken_rules") == "").drop("broken_rules")
        seen = Observation()
        write_fact(good, fact_path, seen, version=version)
        if rollups_path is not None:
            write_rollups(rollups_of(good), rollups_path, version)
        publish(spark, fact_path, owned, version)
        if audit:
            audit.record("fact", "facts loaded", rows=observed(seen)["rows"])


def report(
    spark: SparkSession, warehouse: Warehouse, *attributes: str,
    dim_date: DataFrame | None = None, dim_time: DataFrame | None = None,
) -> DataFrame:
    """Views by any attributes of fact and dimensions, from the kept sums if these have
    them. The fact is asked where not, and for months that were loaded without sums. A
    part of a dimension asks for a part of the months."""
    if dim_date is None:
        dim_date = spark.read.schema(DIM_DATE).parquet(warehouse.dim_date)
    if dim_time is None:
        dim_time = spark.read.schema(DIM_TIME).parquet(warehouse.dim_time)
    fact = read_fact(spark, warehouse.fact)
    if grain_for(attributes) is None:
        return views_by(fact, dim_date, dim_time, *attributes)
    kept = read_rollups(spark, warehouse.rollups, warehouse.fact)
    others = fact.where(~F.col("load_month").isin(_names(kept, "load_month")))
    return views_from_rollups(kept.unionByName(rollups_of(others)), dim_date, dim_time, *attributes)


def load_months(
    spark: SparkSession, warehouse: Warehouse, batch_id: str, reload: Sequence[str] = (),
    quarantine: bool = False, audit: RunAudit | None = None,
) -> None:
    """Load the month sets not loaded yet, and those named in `reload` (yyyy-MM)."""
    monthly = read_monthly(spark, warehouse.monthly)
    made = _noted(spark, warehouse, "monthly").union(monthly.select(F.col("file_month").alias("file_name"))).distinct()
    waiting = pending(made, read_ledger(spark, warehouse.ledger), "fact")
    if reload:
        waiting = waiting.union(made.where(F.col("file_name").isin(*reload))).distinct()
    names = _names(waiting, "file_name")
    if not names:
        return
    load_fact(
        spark, monthly.where(F.col("file_month").isin(*names)), warehouse.fact,
        spark.read.schema(DIM_DATE).parquet(warehouse.dim_date),
        spark.read.schema(DIM_TIME).parquet(warehouse.dim_time),
        warehouse.refused if quarantine else None, audit, names, warehouse.rollups,
    )
    loaded = spark.createDataFrame([(name,) for name in names], "file_name string")
    append_ledger(ledger_rows(loaded, "fact", batch_id), warehouse.ledger)


def sweep_warehouse(spark: SparkSession, warehouse: Warehouse, hours: float = 24.0) -> dict[str, int]:
    """Delete versions that were replaced, or never published, and are older than `hours`;
    how many of each table went. Rejects go by the list of the tally, refused rows and
    kept sums by that of the fact."""
    tables = {
        "tally": (warehouse.tally, None), "rejects": (warehouse.rejects, warehouse.tally), "daily": (warehouse.daily, None),
        "monthly": (warehouse.monthly, None), "fact": (warehouse.fact, None), "refused": (warehouse.refused, warehouse.fact),
        "rollups": (warehouse.rollups, warehouse.fact),
    }
    return {name: sweep(spark, path, listed, hours) for name, (path, listed) in tables.items()}


def load_jdbc(
    fact: DataFrame, url: str, table: str = "fact_pageviews", *,
    writers: int | None = None, properties: Mapping[str, str] | None = None,
) -> None:
    """Append loaded facts to a database table, ordered for its partitions."""
    append_jdbc(
        fact.select(*FACT_COLUMNS).hint("rebalance", "year", "month")
        .sortWithinPartitions("date_id", "time_id"),
        url, table, writers=writers, properties=properties,
    )


def append_months(
    spark: SparkSession, warehouse: Warehouse, batch_id: str, url: str, table: str = "fact_pageviews",
    months: Sequence[str] = (), audit: RunAudit | None = None,
) -> list[str]:
    """Append the loaded months that were not appended yet, or just the named ones,
    to a database; returns them. The ledger notes them when the append is done."""
    loaded = _noted(spark, warehouse, "fact")
    if months:
        names = _names(loaded.where(F.col("file_name").isin(*months)), "file_name")
    else:
        names = _names(pending(loaded, read_ledger(spark, warehouse.ledger), "append"), "file_name")
    if names:
        load_jdbc(read_fact(spark, warehouse.fact).where(F.col("load_month").isin(*names)), url, table)
        done = spark.createDataFrame([(name,) for name in names], "file_name string")
        append_ledger(ledger_rows(done, "append", batch_id), warehouse.ledger)
        if audit:
            audit.record_each("append", [f"{name} appended to {table}" for name in names])
    return names
