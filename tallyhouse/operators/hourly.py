"""Sums of views per dump, site and page."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions import file_date_of, month_key
from tallyhouse.operators.parse import (
    aggregate_by_dump, line_outcome, split_lines, with_collection,
)
from tallyhouse.schemas import FILE_KEYS, HOURLY

HOURLY_COLUMNS = [*HOURLY.names, *FILE_KEYS.names]


def hourly_pageviews(parsed: DataFrame) -> DataFrame:
    """Sum of views per (dump, domain, page), for all dumps at once.

    A group without any valid count keeps a NULL sum; dumps with another name
    pattern give no rows. Collection date and time follow from the file's, so
    they are added to the sums and not to the lines.
    """
    sums = aggregate_by_dump(
        parsed, "domain", "pagename", sumpageviewcount=F.sum("pageview")
    )
    return with_collection(sums).select(*HOURLY_COLUMNS)


def tally(lines: DataFrame, pages: Sequence[str]) -> DataFrame:
    """Where every line of every dump went, in one pass over the lines.

    Outcomes: `kept` rows hold the sum per (dump, domain, page); `short_line`
    and `bad_count` rows hold each distinct malformed line and how often it
    occurs; one `other` row per dump counts the lines of pages not asked for.
    The partial aggregate leaves one `other` row per dump and task, so the
    shuffle carries sums and rejects only, whatever the size of the dumps.
    """
    page, views = F.col("pagename"), F.col("pageview")
    malformed = line_outcome(views, F.col("fields"))
    place = F.col("place") if "place" in lines.columns else F.lit("")
    rows = split_lines(lines, place.alias("place")).withColumn(
        "outcome",
        F.coalesce(malformed, F.when(page.isin(*pages), "kept").otherwise("other")),
    )
    kept, other = F.col("outcome") == "kept", F.col("outcome") == "other"
    return (
        rows.groupBy(
            "file_name", "place", "outcome",
            F.when(kept, F.col("domain")).alias("domain"),
            F.when(kept, page).alias("pagename"),
            F.when(~kept & ~other, F.col("value")).alias("line"),
        )
        .agg(F.sum(F.when(kept, views)).alias("sumpageviewcount"), F.count("*").alias("lines"))
        .withColumn("file_date", file_date_of(F.col("file_name")))
        .withColumn("file_month", month_key(F.col("file_date")))
    )


def no_lines(files: DataFrame) -> DataFrame:
    """Tallies of dumps (file_name) that have not a single line."""
    text = F.lit(None).cast("string")
    return files.select(
        "file_name", F.lit("").alias("place"), F.lit("other").alias("outcome"), text.alias("domain"),
        text.alias("pagename"), text.alias("line"), F.lit(None).cast("bigint").alias("sumpageviewcount"),
        F.lit(0).cast("bigint").alias("lines"), file_date_of(F.col("file_name")).alias("file_date"),
    ).withColumn("file_month", month_key(F.col("file_date")))


def new_dumps(tallies: DataFrame, known: DataFrame, owner: str) -> DataFrame:
    """The tallies of dumps that are not in the known ones yet.

    A dump may come in parts, in several batches of one owner (a stream), as long
    as they lie in one place. What another owner has tallied, or the same one from
    another place, is a copy; of copies in these tallies the first place counts.
    """
    first = tallies.groupBy("file_name").agg(F.min("place").alias("place"))
    mine = F.col("batch_id").startswith(owner)
    taken = known.where(~mine).select("file_name").distinct()
    begun = known.where(mine).select(
        F.col("file_name").alias("begun_name"), F.col("place").alias("begun_place")
    ).distinct()
    return (
        tallies.join(first, ["file_name", "place"], "left_semi")
        .join(taken, "file_name", "left_anti")
        .join(begun, (F.col("file_name") == F.col("begun_name")) & (F.col("place") != F.col("begun_place")), "left_anti")
    )


def hourly_of_tally(tallies: DataFrame) -> DataFrame:
    """Hourly sums from tallies. The parts of a dump that were tallied in
    different batches are added up here, so the cut into batches is free."""
    sums = aggregate_by_dump(
        tallies.where("outcome = 'kept'").select("file_name", "domain", "pagename", "sumpageviewcount"),
        "domain", "pagename",
        sumpageviewcount=F.sum("sumpageviewcount"),
    )
    return with_collection(sums).select(*HOURLY_COLUMNS)


def rejects_of_tally(tallies: DataFrame) -> DataFrame:
    """Rejects as (file_name, reason, line, lines); a badly named dump is one
    reject with all its lines counted."""
    bad_name = F.col("file_date").isNull()
    reason = F.when(bad_name, "bad_file_name").otherwise(F.col("outcome"))
    return (
        tallies.select(
            "file_name", reason.alias("reason"),
            F.when(~bad_name, F.col("line")).alias("line"), "lines",
        )
        .where(F.col("reason").isin("bad_file_name", "short_line", "bad_count"))
        .groupBy("file_name", "reason", "line").agg(F.sum("lines").alias("lines"))
    )


def ordered_hours(hourly: DataFrame) -> DataFrame:
    """Sorted by domain and page within each hour, by local sorts: rows of an
    hour share a task (or several, when it is large), so no range exchange."""
    return hourly.hint("rebalance", "file_date", "file_time").sortWithinPartitions(
        "file_date", "file_time", "domain", "pagename"
    )


def combine(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Union-all of hourly, day or month sets by column name, duplicates kept."""
    for other in rest:
        first = first.unionByName(other)
    return first


def row_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"))
