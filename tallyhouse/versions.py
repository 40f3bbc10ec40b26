"""Versions: what the readers of a table see changes in one step.

A write puts its rows into folders of its own, `<key>=<value>/version=<version>`,
that nobody reads. Publishing adds one small file to the list of versions in the table's
folder; it names the keys the write stands for, and their version. Readers take each
key's last published version. So a write that stops half-way changes nothing, whatever
it has left, and one that is published has replaced its keys whole, also those that
have no rows any more. Several tables written under one version are published by one list.

Keys are days, months or batches: as many as the calendar or the runs have.
"""

import time
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyhouse.session import folder_exists, folders_in, remove_folder

# Spark passes over names that begin with an underscore when it lists a table.
LIST = "_versions"
VERSIONS = T.StructType([
    T.StructField("nth", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("version", T.StringType()),
])
VERSION = T.StructField("version", T.StringType())


def new_version() -> str:
    return uuid.uuid4().hex


def key_text(key: str) -> Column:
    """A key as the list of versions has it."""
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def _listed(spark: SparkSession, path: str) -> DataFrame | None:
    there = f"{path}/{LIST}"
    return spark.read.schema(VERSIONS).parquet(there) if folder_exists(spark, there) else None


def published_versions(spark: SparkSession, path: str) -> dict[str, str]:
    """The version to read of each key. Of two that were published at once the one
    with the greater name counts."""
    listed = _listed(spark, path)
    if listed is None:
        return {}
    last = listed.groupBy("key").agg(F.max(F.struct("nth", "version")).alias("last"))
    return {row["key"]: row["version"] for row in last.select("key", "last.version").collect()}


def publish(spark: SparkSession, path: str, keys: Iterable[str], version: str) -> None:
    """Make a version the one to read for these keys: one file, which is there or not."""
    keys = sorted(set(keys))
    if not keys:
        return
    listed = _listed(spark, path)
    last = listed.agg(F.max("nth")).first()[0] if listed is not None else None
    rows = spark.createDataFrame([((last or 0) + 1, key, version) for key in keys], VERSIONS)
    rows.coalesce(1).write.mode("append").parquet(f"{path}/{LIST}")


def published(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Of a table with its column `version` the rows to read, by the list at `path`.

    The condition is on folders only, so others are not opened. A table without a list
    was written before there were versions: its rows, which have none, are read.
    """
    versions = published_versions(rows.sparkSession, path)
    live = F.concat(key_text(key), F.lit("/"), F.col("version")).isin([f"{k}/{v}" for k, v in versions.items()])
    return rows.where(live if versions else F.col("version").isNull()).drop("version")


def sweep(spark: SparkSession, path: str, listed: str | None = None, hours: float = 24.0) -> int:
    """Delete the versions of a table that nobody reads: replaced ones, and what stopped
    writes have left. `listed` is the path whose list counts, if not the table's own.

    Only folders that were last written to more than `hours` ago go, as a newer one may
    be about to be published, and one just replaced may still be read. Returns how many
    went. A table without a list is left alone.
    """
    live = published_versions(spark, listed or path)
    if not live:
        return 0
    before, removed = (time.time() - hours * 3600) * 1000, 0
    for folder, _ in folders_in(spark, path):
        key = unquote(folder.rsplit("/", 1)[1].partition("=")[2]).replace("__HIVE_DEFAULT_PARTITION__", "")
        for version, written in folders_in(spark, folder):
            name = version.rsplit("/version=", 1)
            if len(name) == 2 and live.get(key) != name[1] and written < before:
                remove_folder(spark, version)
                removed += 1
    return removed
