"""Calendar keys, the load frame and the fact's surrogate key."""

from pyspark.sql import DataFrame, functions as F

from tallyhouse.schemas import LOAD_COLUMNS

# fact_id, from the highest bit: 0, day of the month (5 bits), hour (5 bits), the
# first 13 hex digits (52 bits) of a hash of domain and page. With year and month,
# as the table's primary key has them, it names one row.
HASH_DIGITS, HASH_BITS = 13, 52


def calendar_keys(rows: DataFrame) -> DataFrame:
    """Add date_id, time_id, year and month from the two collection strings."""
    date_part = lambda n: F.split_part("date_collection", F.lit("-"), F.lit(n)).cast("int")
    return rows.withColumns({
        "date_id": F.replace("date_collection", F.lit("-"), F.lit("")).cast("int"),
        "time_id": F.split_part("time_collection", F.lit(":"), F.lit(1)).cast("int"),
        "year": date_part(1),
        "month": date_part(2),
    })


def load_frame(monthly: DataFrame) -> DataFrame:
    """The columns to load, together by month and sorted by date and time inside.

    A rebalance rather than a plain hash partitioning: adaptive execution cuts
    a month too big for one task and merges small ones.
    """
    return (
        monthly.select(*LOAD_COLUMNS)
        .hint("rebalance", "year", "month")
        .sortWithinPartitions("date_id", "time_id")
    )


def with_fact_id(rows: DataFrame) -> DataFrame:
    """Add a fact_id that depends on its row's date, hour, domain and page alone.

    No row is looked at but its own, so other rows never change it, and nothing is
    shuffled. Equal keys get equal ids. So do, one time in thousands of billions,
    two different pages of one hour; a load refuses both by the rule `primary_key`.
    """
    hour_of_month = (F.col("date_id") % 100 * 32 + F.col("time_id")).cast("bigint")
    digest = F.substring(F.md5(F.concat_ws(" ", "domain", "pagename")), 1, HASH_DIGITS)
    fact_id = F.shiftleft(hour_of_month, HASH_BITS) + F.conv(digest, 16, 10).cast("bigint")
    return rows.select(fact_id.alias("fact_id"), *rows.columns)
