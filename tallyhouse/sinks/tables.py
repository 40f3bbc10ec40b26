"""Writers of the warehouse tables.

The rows of a partition are brought together by a rebalance: about one file per
partition, several where adaptive execution finds it too big for one task. Tallies, day
and month sets and facts are written as a version of their own and published when all
is there (see tallyhouse.versions): a write replaces the keys its rows belong to, and
those it is told it owns. So repeating a stage, or running it again after a failure,
changes nothing, and a stop at any point leaves readers what they had. A function
that is given a version leaves the publishing to its caller. `seen` counts the rows
while they are written.
"""

from collections import Counter
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, Row, functions as F

from tallyhouse.functions import month_key
from tallyhouse.versions import key_text, new_version, publish


# Rows of a tally's file.
FILE_ROWS = 500_000


def observed(seen: Observation) -> dict:
    """What a write has counted. Where the optimizer finds that there is nothing to
    write, it takes the counting out as well, and there is no row to get."""
    try:
        return seen.get
    except Py4JJavaError:
        return {"rows": 0, "keys": []}


def _partition_writer(rows: DataFrame, by: Sequence[str], order: Sequence[str] = ()) -> DataFrameWriter:
    return rows.hint("rebalance", *by).sortWithinPartitions(*by, *order).write.partitionBy(*by)


def _write_version(
    rows: DataFrame, path: str, by: Sequence[str], order: Sequence[str] = (),
    seen: Observation | None = None, owned: DataFrame | None = None, version: str | None = None,
) -> None:
    """Rows as a version of their keys, by[0]; published unless the caller names it."""
    seen, own = seen or Observation(), version or new_version()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(key_text(by[0])).alias("keys"))
    gathered = counted.hint("rebalance", *by).withColumn("version", F.lit(own))
    folders = [by[0], "version", *by[1:]]
    gathered.sortWithinPartitions(*folders, *order).write.partitionBy(*folders).mode("append").parquet(path)
    if version is None:
        mine = [row["key"] for row in owned.select(key_text(by[0]).alias("key")).distinct().collect()] if owned is not None else []
        publish(rows.sparkSession, path, [*observed(seen)["keys"], *mine], own)


def tally_sizes(tallies: DataFrame) -> list[Row]:
    """(file_month, outcome, file_date, rows) of tallies: a few rows a day."""
    return tallies.groupBy("file_month", "outcome", "file_date").agg(F.count("*").alias("rows")).collect()


def _in_files(tallies: DataFrame, sizes: Sequence[Row]) -> DataFrame:
    """Tallies dealt to tasks so that a folder's files have about FILE_ROWS rows each.

    A day gets as many places in its folder as it has rows, days one after the other,
    and a row one of its day's by a hash. A file holds FILE_ROWS places, so small days
    share one and a day that is too big for one task is cut, without adaptive execution.
    """
    placed, taken = [], Counter()
    for row in sorted(sizes, key=lambda r: (str(r.file_month), r.outcome, str(r.file_date))):
        folder = (row.file_month, row.outcome)
        placed.append((*folder, row.file_date, taken[folder], row.rows))
        taken[folder] += row.rows
    days = tallies.sparkSession.createDataFrame(placed, "m string, o string, d date, before long, own long")
    day = F.col("file_month").eqNullSafe(F.col("m")) & (F.col("outcome") == F.col("o")) & F.col("file_date").eqNullSafe(F.col("d"))
    place = F.col("before") + F.pmod(F.xxhash64("file_name", "domain", "pagename", "line"), F.col("own"))
    # The days of a batch, as the calendar has them, are few enough to send to all tasks.
    rows = tallies.join(F.broadcast(days), day).withColumn("file", F.floor(place / FILE_ROWS))
    files = sum(-(-rows // FILE_ROWS) for rows in taken.values())
    return rows.repartition(max(1, files), "file_month", "outcome", "file").drop("m", "o", "d", "before", "own", "file")


def write_tally(
    tallies: DataFrame, path: str, batch_id: str, seen: Observation | None = None, version: str | None = None,
    sizes: Sequence[Row] | None = None,
) -> None:
    """The tallies of one batch, replacing an earlier attempt at that batch. With `sizes`,
    the tally_sizes of these rows or of more, files are cut by them; otherwise adaptive
    execution cuts what is too big."""
    if seen is not None:
        tallies = tallies.observe(seen, F.count(F.lit(1)).alias("rows"))
    if sizes is None:
        gathered = tallies.hint("rebalance", "file_month", "outcome", "file_date")
    else:
        gathered = _in_files(tallies, sizes)
    ordered = gathered.sortWithinPartitions(
        "file_month", "outcome", "file_date", "file_name", "domain", "pagename", "line"
    )
    own = version or new_version()
    ordered.write.partitionBy("file_month", "outcome").parquet(f"{path}/batch_id={batch_id}/version={own}")
    if version is None:
        publish(tallies.sparkSession, path, [batch_id], own)


def write_rejects(rejects: DataFrame, path: str, batch_id: str, version: str) -> None:
    """The malformed lines of one batch. They are read when the tally of that version
    is published, so a batch has both or neither."""
    ordered = rejects.hint("rebalance").sortWithinPartitions("file_name", "reason", "line")
    ordered.write.parquet(f"{path}/batch_id={batch_id}/version={version}")


def write_hourly(hourly: DataFrame, path: str) -> None:
    """Hourly sets, one partition per dump, sorted by domain and page. A dump's
    partition is replaced by Spark itself, folder by folder."""
    writer = _partition_writer(hourly, ["file_date", "file_time"], ["domain", "pagename"]).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_daily(
    hourly: DataFrame, path: str, seen: Observation | None = None, days: DataFrame | None = None
) -> None:
    """Day sets: the hourly rows of a file date as one partition. `days` (file_date)
    are replaced whole, also where they have no rows now."""
    _write_version(hourly, path, ["file_date"], ["file_time", "domain", "pagename"], seen, days)


def write_monthly(
    keyed: DataFrame, path: str, seen: Observation | None = None, months: DataFrame | None = None
) -> None:
    """Month sets: day sets with calendar keys, one partition per file month."""
    if "file_month" not in keyed.columns:
        keyed = keyed.withColumn("file_month", month_key(F.col("file_date")))
    _write_version(
        keyed.drop("file_date", "file_time"), path, ["file_month"],
        ["date_id", "time_id", "domain", "pagename"], seen, months,
    )


def write_fact(
    fact: DataFrame, path: str, seen: Observation | None = None, months: DataFrame | None = None,
    version: str | None = None,
) -> None:
    """The fact by (load_month, year, month).

    A month set holds the last midnight of the month before. With load_month,
    the month set a row came from, as first key, replacing a month leaves the
    rest of that earlier month alone. `months` (load_month) are replaced whole.
    """
    _write_version(
        fact, path, ["load_month", "year", "month"], ["date_id", "time_id", "domain", "pagename"],
        seen, months, version,
    )


def write_refused(refused: DataFrame, path: str, version: str) -> None:
    """Rows a load refused, by load_month. They are read when the fact of that version is
    published, so a clean load removes what an earlier one refused."""
    _write_version(refused, path, ["load_month"], ["date_id", "time_id"], version=version)


def write_rollups(rollups: DataFrame, path: str, version: str) -> None:
    """Kept sums of a load's facts, by load_month, read with the fact of that version."""
    _write_version(rollups, path, ["load_month", "grain"], ["date_id"], version=version)


def replace_dimension(dimension: DataFrame, path: str) -> None:
    """Replace a whole dimension table."""
    dimension.write.mode("overwrite").parquet(path)


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add the files of a (stage, batch). Nothing is taken out of a ledger, and what
    is noted again is one row when read."""
    _partition_writer(rows, ["stage", "batch_id"]).mode("append").parquet(path)


def land_dumps(lines: DataFrame, path: str, compression: str = "gzip") -> None:
    """Stage (value, file_name) lines as gzip text, a folder per dump.

    A large dump becomes several files, which are then read in parallel.
    """
    writer = _partition_writer(lines.select("value", "file_name"), ["file_name"])
    writer.mode("append").option("compression", compression).text(path)
