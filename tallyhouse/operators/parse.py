"""Dump lines to typed rows, and the lines that cannot be one."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import (
    clock_text, collection_date, collection_time, field, fields, file_clock_of, file_date_of,
    view_count,
)
from tallyhouse.functions.names import DUMP_PREFIX
from tallyhouse.functions.text import USED_FIELDS


def split_lines(lines: DataFrame, *carried: Column) -> DataFrame:
    """(value, file_name) to (file_name, value, domain, pagename, pageview, fields),
    and what is carried along.

    Missing fields and counts that are no number give NULL. `fields` is how
    many fields the line has, counted up to four.
    """
    parts = F.col("parts")
    cut = lines.select("file_name", "value", fields(F.col("value")).alias("parts"), *carried)
    return cut.select(
        "file_name", "value", *cut.columns[3:],
        field(parts, 0).alias("domain"),
        field(parts, 1).alias("pagename"),
        view_count(field(parts, 2)).alias("pageview"),
        F.size(parts).alias("fields"),
    )


def keep_pages(parsed: DataFrame, pages: Sequence[str]) -> DataFrame:
    """Rows of the listed pages; exact and case-sensitive."""
    return parsed.where(F.col("pagename").isin(*pages))


def keep_listed_pages(parsed: DataFrame, pages: DataFrame) -> DataFrame:
    """keep_pages for a list that is itself a table with a `pagename` column.

    Adaptive execution chooses the join by the list's size. With a list too long
    to broadcast, sum the views first and filter after, since the page is a
    grouping key and only sums are shuffled then.
    """
    return parsed.join(pages.select("pagename").distinct(), "pagename", "left_semi")


def with_file_keys(rows: DataFrame) -> DataFrame:
    """Add file_date and file_time from file_name; file_date is NULL where the
    name is not a dump's."""
    name = F.col("file_name")
    return rows.withColumns({
        "file_date": file_date_of(name), "file_time": clock_text(file_clock_of(name)),
    })


def with_collection(rows: DataFrame) -> DataFrame:
    """Add date_collection and time_collection from file_date and file_time."""
    return rows.withColumns({
        "date_collection": collection_date(F.col("file_date"), F.col("file_time")),
        "time_collection": collection_time(F.col("file_time")),
    })


def stamp(rows: DataFrame) -> DataFrame:
    """Both of the above."""
    return with_collection(with_file_keys(rows))


def aggregate_by_dump(rows: DataFrame, *keys: str, **aggregates: Column) -> DataFrame:
    """Aggregate by dump and further keys, with file_date and file_time.

    The two come out as aggregates of themselves. Joins and filters on keys made
    from them then stay above the aggregate, on few rows. Grouped by the name and
    worked out after, they were moved below by the optimizer and worked out, several
    times over, for every line: a gate or star join of 600,000 lines took 20 seconds
    then and takes 3. To ask for some days only, filter the lines by between_dates.
    Both are numbers inside, so the hash aggregate stays. Names of no dump give no
    rows.
    """
    name = F.col("file_name")
    keyed = rows.withColumns({"dump_date": file_date_of(name), "dump_clock": file_clock_of(name)})
    found = keyed.groupBy("dump_date", "dump_clock", *keys).agg(
        F.max("dump_date").alias("file_date"), F.max("dump_clock").alias("clock"),
        *[value.alias(alias) for alias, value in aggregates.items()],
    )
    return (
        found.where(F.col("file_date").isNotNull())
        .withColumn("file_time", clock_text(F.col("clock")))
        .drop("dump_date", "dump_clock", "clock")
    )


def between_dates(lines: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Lines of dumps whose file date is from start to end (ISO dates, both included).

    Names of dumps are in the order of their dates, so this compares the names and
    works nothing out for a line; it passes below sums and shuffles.
    """
    name = F.col("file_name")
    if start:
        lines = lines.where(name >= DUMP_PREFIX + start.replace("-", ""))
    if end:
        # "." comes after the "-" that follows a date in a name.
        lines = lines.where(name < DUMP_PREFIX + end.replace("-", "") + ".")
    return lines


def dumps_of(lines: DataFrame) -> DataFrame:
    """The dumps that rows with a file_name come from, as (file_name, file_date, file_time)."""
    return aggregate_by_dump(lines, "file_name").select("file_name", "file_date", "file_time")


def line_outcome(pageview: Column, field_count: Column) -> Column:
    """short_line, bad_count, or NULL for a well-formed line."""
    return F.when(field_count < USED_FIELDS, "short_line").when(pageview.isNull(), "bad_count")


def with_reject_reason(parsed: DataFrame) -> DataFrame:
    """Add `reason`: bad_file_name, short_line, bad_count, or NULL for a good line."""
    bad_name = file_date_of(F.col("file_name")).isNull()
    return parsed.withColumn(
        "reason",
        F.when(bad_name, "bad_file_name").otherwise(line_outcome(F.col("pageview"), F.col("fields"))),
    )


def line_rejects(parsed: DataFrame) -> DataFrame:
    """Malformed lines and lines of badly named files, with the reason."""
    return with_reject_reason(parsed).where(F.col("reason").isNotNull()).select(
        "file_name", "value", "reason"
    )


def well_formed(parsed: DataFrame) -> DataFrame:
    """The lines line_rejects leaves."""
    return with_reject_reason(parsed).where(F.col("reason").isNull()).drop("reason")
