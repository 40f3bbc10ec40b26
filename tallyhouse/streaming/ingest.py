"""Incremental ingest: each run takes the dumps that came since the last one."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyhouse.functions import month_key, path_dump_name, path_place
from tallyhouse.operators import hourly_of_tally, new_dumps, no_lines, rejects_of_tally, tally
from tallyhouse.schemas import COMPANY_PAGES, TALLY
from tallyhouse.session import scratch_folders
from tallyhouse.sinks import tally_sizes, write_rejects, write_tally
from tallyhouse.sources import read_tally
from tallyhouse.versions import new_version, publish


def stream_dumps(
    spark: SparkSession, folder: str, *, files_per_batch: int | None = None, archive: str | None = None
) -> DataFrame:
    """Lines of the dumps in a folder, and all below it, as a stream of
    (value, file_name, place). Plain and landed dumps may lie side by side.

    With `archive`, finished dumps move there during a later run; the last batch
    of a run stays in the folder till then, so a file's presence says nothing.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    path = F.col("_metadata.file_path")
    return reader.load(folder).select(
        "value", path_dump_name(path).alias("file_name"), path_place(path).alias("place")
    )


def tally_new(
    spark: SparkSession, sums: DataFrame, tally_path: str, batch_id: str, owner: str,
    rejects_path: str | None = None, seen: Observation | None = None, files: DataFrame | None = None,
) -> None:
    """Write tallies as one batch, without the dumps that are in the table already.

    Tallies and rejects are written under one version and published together at the
    end: a batch that was stopped before has neither, and is done again. The sums are
    written to scratch first, as they are looked at twice, and read from there in the
    session `spark`. Only the months they belong to are read from the table. Of `files`
    (file_name) those without any line are noted as well.
    """
    with scratch_folders(spark) as scratch:
        folder, version = scratch("sums"), new_version()
        sums.write.parquet(folder)
        sums = spark.read.schema(sums.schema).parquet(folder)
        if files is not None:
            sums = sums.unionByName(no_lines(files.join(sums, "file_name", "left_anti")))
        sizes = tally_sizes(sums)
        months = {row["file_month"] for row in sizes}
        known = read_tally(spark, tally_path).where(
            F.col("file_month").isin([m for m in months if m]) | F.col("file_month").isNull()
        ).where(F.col("batch_id") != batch_id)
        write_tally(new_dumps(sums, known, owner), tally_path, batch_id, seen, version, sizes)
        if rejects_path:
            written = spark.read.schema(TALLY).parquet(f"{tally_path}/batch_id={batch_id}/version={version}")
            write_rejects(rejects_of_tally(written), rejects_path, batch_id, version)
        publish(spark, tally_path, [batch_id], version)


def ingest_available(
    lines: DataFrame, tally_path: str, checkpoint: str, pages: Sequence[str] = COMPANY_PAGES,
    rejects_path: str | None = None,
) -> None:
    """Tally all dumps that are new since the checkpoint, then stop.

    Each micro-batch owns the folder of its number in its stream, whose id lies in
    the checkpoint, so one that is repeated after a failure replaces its own output
    and nothing is counted twice; nor are dumps that another stream or a job over
    a folder has tallied before.

    Spark turns adaptive execution off in the session it gives to a micro-batch. The
    lines are summed there, and what follows reads the sums in the caller's session, where
    small tables are joined without a shuffle. Files are cut by the sizes of the days.
    """
    spark = lines.sparkSession

    def tally_batch(batch: DataFrame, number: int) -> None:
        owner = f"stream-{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-"
        tally_new(spark, tally(batch, pages), tally_path, f"{owner}{number}", owner, rejects_path)

    query = (
        lines.writeStream.foreachBatch(tally_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_hourly(
    spark: SparkSession, tally_path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Hourly sums of everything ingested; the months of the dates prune the folders read."""
    tallies = read_tally(spark, tally_path)
    day, month = F.col("file_date"), F.col("file_month")
    if start:
        first = F.lit(start).cast("date")
        tallies = tallies.where((day >= first) & (month >= month_key(first)))
    if end:
        last = F.lit(end).cast("date")
        tallies = tallies.where((day <= last) & (month <= month_key(last)))
    return hourly_of_tally(tallies)
