"""Hourly dump files: reading, listing, and checking what is there."""

import re
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions import dump_name, file_date_of, path_dump_name, path_place
from tallyhouse.schemas import DUMP_BASE_URL, HOURS_PER_DAY

# Bytes that a check holds of a file at once.
CHUNK = 1 << 20


def read_dumps(
    spark: SparkSession, paths: str | Sequence[str], *, skip_corrupt: bool = False
) -> DataFrame:
    """Lines of all dumps in one scan, as (value, file_name).

    `paths` is a folder, a glob, or a list of files. Folders are read with all
    below them. A dump is one `pageviews-….gz`, which one task reads, or the
    parts that `land_dumps` wrote, which several can. A dump that lies there
    twice is read twice; list_dumps tells.

    A dump that is no gzip or is cut short fails the scan. `skip_corrupt` reads
    on, but keeps the lines before the damage, so use it only together with
    `audit_dumps(deep=True)` and leave out the dumps it reports.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("ignoreCorruptFiles", skip_corrupt).option("pathGlobFilter", "*.gz")
    lines = reader.option("recursiveFileLookup", True).text(paths)
    return lines.select("value", path_dump_name(F.col("_metadata.file_path")).alias("file_name"))


def list_dumps(spark: SparkSession, path: str) -> DataFrame:
    """Files under a folder as (file_name, path, place, length), without reading them.

    place is where the whole dump lies: its path, or the folder of its parts.
    Files of no bytes are not listed.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.gz").load(path)
    )
    return found.select(
        path_dump_name(F.col("path")).alias("file_name"), "path", path_place(F.col("path")).alias("place"), "length"
    )


def one_place_each(files: DataFrame) -> DataFrame:
    """Of each dump the files in one place, the first by name; copies elsewhere go."""
    first = files.groupBy("file_name").agg(F.min("place").alias("place"))
    return files.join(first, ["file_name", "place"], "left_semi")


def _gzip_intact(first: bytes, rest: pa.NativeFile) -> bool:
    """Whether every gzip member decompresses to its end and checksum."""
    member, piece = zlib.decompressobj(wbits=31), first
    try:
        while piece:
            while piece:
                if member.eof:
                    member = zlib.decompressobj(wbits=31)
                # What a chunk decompresses to may be long; it is dropped in pieces.
                member.decompress(piece, CHUNK)
                piece = member.unused_data if member.eof else member.unconsumed_tail
            piece = rest.read(CHUNK)
    except zlib.error:
        return False
    return member.eof


def _checked(path: str, deep: bool) -> tuple[bool, bool]:
    """Whether a file begins as gzip does, and whether it is intact, read in chunks."""
    # Hadoop shows a local path as file:/…, which is short for file:///….
    system, place = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
    with system.open_input_stream(place, compression=None) as file:
        first = file.read(CHUNK if deep else 2)
        is_gzip = first[:2] == b"\x1f\x8b"
        return is_gzip, not deep or (is_gzip and _gzip_intact(first, file))


def audit_dumps(
    spark: SparkSession, paths: str | Sequence[str], *, deep: bool = False
) -> DataFrame:
    """Verdict per file: ok, not_gzip, truncated (with `deep`) or bad_name.

    Spark lists the files, and a task that gets a path reads it as a stream: its first
    two bytes, or with `deep` all of it, a chunk at a time, so a file may have any
    length. Tasks get files of about the same total length. Executors have to reach the
    files by Arrow's file systems (local, HDFS, S3, GCS). Spark's file sources pass over
    files of no bytes, so those count as missing.
    """
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_checked(path, deep) for path in batch["path"]]
            yield batch.assign(is_gzip=[gzip for gzip, _ in found], intact=[intact for _, intact in found])

    paths = [paths] if isinstance(paths, str) else list(paths)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    files = listed.select(path_dump_name(F.col("path")).alias("file_name"), "path", "length")
    found = files.mapInPandas(check, "file_name string, path string, length long, is_gzip boolean, intact boolean")
    verdict = (
        F.when(~F.col("is_gzip"), "not_gzip")
        .when(~F.col("intact"), "truncated")
        .when(file_date_of(F.col("file_name")).isNull(), "bad_name")
        .otherwise("ok")
    )
    return found.select("file_name", "path", "length", verdict.alias("verdict"))


def expected_dumps(days: DataFrame, base_url: str = DUMP_BASE_URL) -> DataFrame:
    """The 24 dumps each date should have, with name and URL. NULL dates have none."""
    hourly = (
        days.select("date").where(F.col("date").isNotNull())
        .select("date", F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1))).alias("hour"))
    )
    name = dump_name(F.col("date"), F.col("hour"))
    url = F.concat(
        F.lit(base_url), F.date_format("date", "/yyyy/yyyy-MM/"), F.col("file_name"),
    )
    return (
        hourly.select(F.col("date").alias("file_date"), "hour", name.alias("file_name"), "date")
        .select("file_date", "hour", "file_name", url.alias("url"))
    )


def missing_dumps(expected: DataFrame, seen: DataFrame) -> DataFrame:
    """Expected dumps without a file; `seen` may name a dump many times, as lines do."""
    return expected.join(seen.select("file_name").distinct(), "file_name", "left_anti")
