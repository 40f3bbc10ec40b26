"""What several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read from there."""
    folder = scratch_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def free_name(rows: DataFrame, base: str) -> str:
    """A column name that no column of the rows has, whatever its case."""
    taken = {name.lower() for name in rows.columns}
    while base in taken:
        base += "_"
    return base


def as_bytes(text: Column) -> Column:
    """A text for Python code that works on UTF-8 bytes; a null one stays null."""
    return text.cast("binary")


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, version, text): version tells apart texts under one id.

    Rows with the same id and text are alike in every result, so (doc_id, version)
    is a key to join results by. Joins on it treat null ids as equal.
    """
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["version"] == right["version"])
