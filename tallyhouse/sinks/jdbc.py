"""Append to a warehouse database."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tallyhouse.schemas import FACT_COLUMNS, JDBC_BATCH_ROWS


def append_jdbc(
    fact: DataFrame, url: str, table: str = "fact_pageviews", *,
    writers: int | None = None, properties: Mapping[str, str] | None = None,
) -> None:
    """Append fact rows over JDBC in batches of 10,000, by at most `writers` connections.

    Every task commits for itself, so a failed job may leave part of its rows.
    The fact_id of a row is made from the row alone: with the table's primary key
    on (fact_id, year, month) a second load of a row is refused, not doubled.
    """
    options = {"batchsize": str(JDBC_BATCH_ROWS), **(properties or {})}
    if writers is not None:
        options["numPartitions"] = str(writers)
    fact.select(*FACT_COLUMNS).write.jdbc(url, table, mode="append", properties=options)
