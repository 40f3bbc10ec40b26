"""Which files a stage has dealt with."""

from pyspark.sql import DataFrame, functions as F


def ledger_rows(files: DataFrame, stage: str, batch_id: str) -> DataFrame:
    """One ledger row per file."""
    return files.select(
        "file_name", F.lit(stage).alias("stage"), F.lit(batch_id).alias("batch_id")
    ).distinct()


def pending(files: DataFrame, ledger: DataFrame, stage: str) -> DataFrame:
    """Files the stage has not dealt with."""
    done = ledger.where(F.col("stage") == stage).select("file_name")
    return files.join(done, "file_name", "left_anti")
