"""Readers of the warehouse tables, each with its explicit schema.

The partition columns are part of the schema, so no read infers types, and a
filter on them prunes folders. Of tables with versions the published ones are read
(see tallyhouse.versions).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyhouse.schemas import (
    FACT, FILE_KEYS, HOURLY, LEDGER, MONTHLY, REFUSED, REJECTS, ROLLUPS, TALLY,
)
from tallyhouse.session import folder_exists
from tallyhouse.versions import VERSION, published

FILE_MONTH = T.StructField("file_month", T.StringType())


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """Hourly sets, partitioned by file_date and file_time."""
    return spark.read.schema(T.StructType(HOURLY.fields + FILE_KEYS.fields)).parquet(path)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Day sets, partitioned by file_date."""
    schema = T.StructType([*HOURLY.fields, FILE_KEYS["file_time"], FILE_KEYS["file_date"]])
    return _published(spark, schema, path, "file_date")


def read_monthly(spark: SparkSession, path: str, schema: T.StructType = MONTHLY) -> DataFrame:
    """Month sets, partitioned by file_month. Columns the files lack are NULL."""
    return _published(spark, T.StructType([*schema.fields, FILE_MONTH]), path, "file_month")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Fact table, partitioned by load_month, year and month."""
    return _published(spark, FACT, path, "load_month")


def read_refused(spark: SparkSession, path: str, fact_path: str) -> DataFrame:
    """Rows that the loads of the fact's months have refused."""
    return _published(spark, REFUSED, path, "load_month", fact_path)


def read_rollups(spark: SparkSession, path: str, fact_path: str) -> DataFrame:
    """Kept sums of the fact's months, partitioned by load_month and grain."""
    return _published(spark, ROLLUPS, path, "load_month", fact_path)


def _published(
    spark: SparkSession, schema: T.StructType, path: str, key: str, listed: str | None = None
) -> DataFrame:
    """The published versions of a table, by its own list or the one at `listed`."""
    return published(_or_empty(spark, T.StructType([*schema.fields, VERSION]), path), listed or path, key)


def _or_empty(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The table, empty before its first write."""
    if folder_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger of processed files, partitioned by stage and batch_id. A file that an
    attempt at a batch has noted again is one row."""
    return _or_empty(spark, LEDGER, path).distinct()


def read_tally(spark: SparkSession, path: str) -> DataFrame:
    """Line tallies, partitioned by batch_id, file_month and outcome: a filter on
    months prunes folders."""
    return _published(spark, TALLY, path, "batch_id")


def read_rejects(spark: SparkSession, path: str, tally_path: str) -> DataFrame:
    """Malformed lines of the batches in the tally, partitioned by batch_id."""
    return _published(spark, REJECTS, path, "batch_id", tally_path)
