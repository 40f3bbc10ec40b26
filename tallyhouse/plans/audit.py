"""The run audit: an append-only table of what each stage did."""

import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.schemas import AUDIT


class RunAudit:
    """Events of one run, each appended when it happens. A new run gets a new
    run_id; nothing is ever truncated."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None) -> None:
        self.spark = spark
        self.path = path
        self.run_id = run_id or uuid.uuid4().hex

    def record(self, stage: str, message: str, **metrics: int) -> None:
        self._append([(datetime.now(timezone.utc), stage, message, metrics, self.run_id)])

    def record_each(self, stage: str, messages: Iterable[str]) -> None:
        """Several events of a stage, written together."""
        now = datetime.now(timezone.utc)
        self._append([(now, stage, message, {}, self.run_id) for message in messages])

    def _append(self, events: list[tuple]) -> None:
        rows = self.spark.createDataFrame(events, AUDIT)
        rows.write.mode("append").partitionBy("run_id").parquet(self.path)

    def read(self) -> DataFrame:
        """Events of this run."""
        events = self.spark.read.schema(AUDIT).parquet(self.path)
        return events.where(F.col("run_id") == self.run_id)


def log_lines(events: DataFrame) -> DataFrame:
    """Events as `yyyy-MM-dd HH:mm:ss : message` text lines."""
    return events.select(F.concat(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" : "), F.col("message")
    ).alias("value"))
