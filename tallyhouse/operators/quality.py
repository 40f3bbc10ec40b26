"""The warehouse's constraints as queries for the rows that break them."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.schemas import (
    FACT_TEXT_LIMITS, FIRST_PARTITION_YEAR, LAST_PARTITION_YEAR, LOAD_COLUMNS,
)


def not_null_violations(rows: DataFrame, columns: Sequence[str] = LOAD_COLUMNS) -> DataFrame:
    """Rows with a NULL in any column, and those columns in `null_columns`."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return rows.withColumn("null_columns", names).where(F.col("null_columns") != "")


def length_violations(
    rows: DataFrame, limits: Mapping[str, int] = FACT_TEXT_LIMITS
) -> DataFrame:
    """Rows with a text longer than its column, and those columns in `long_columns`."""
    names = F.concat_ws(
        ",", *[F.when(F.length(c) > n, F.lit(c)) for c, n in limits.items()]
    )
    return rows.withColumn("long_columns", names).where(F.col("long_columns") != "")


def _has_partition() -> Column:
    return F.col("year").between(FIRST_PARTITION_YEAR, LAST_PARTITION_YEAR) & F.col(
        "month"
    ).between(1, 12)


def partition_range_violations(rows: DataFrame) -> DataFrame:
    """Rows whose (year, month) has no partition, or is NULL."""
    return rows.where(~F.coalesce(_has_partition(), F.lit(False)))


def pk_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values found more than once, and how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def fk_violations(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the dimension."""
    return rows.join(dimension.select(key), key, "left_anti")


def with_broken_rules(rows: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Add `broken_rules`, the constraints each load row breaks ('' for none).

    All rules that a row can break by itself, in one pass; with_repeated_keys
    adds the one about several rows.
    """
    dates = dim_date.select("date_id", F.lit(True).alias("known_date"))
    times = dim_time.select("time_id", F.lit(True).alias("known_time"))
    any_null = F.lit(False)
    for column in LOAD_COLUMNS:
        any_null = any_null | F.col(column).isNull()
    too_long = F.lit(False)
    for column, limit in FACT_TEXT_LIMITS.items():
        too_long = too_long | F.coalesce(F.length(column) > limit, F.lit(False))
    rules = {
        "not_null": any_null,
        "length": too_long,
        "partition_range": ~F.coalesce(_has_partition(), F.lit(False)),
        "fk_date": F.col("known_date").isNull() & F.col("date_id").isNotNull(),
        "fk_time": F.col("known_time").isNull() & F.col("time_id").isNotNull(),
    }
    broken = F.concat_ws(",", *[F.when(test, F.lit(rule)) for rule, test in rules.items()])
    return (
        rows.join(dates, "date_id", "left").join(times, "time_id", "left")
        .select(*[F.col(c) for c in rows.columns], broken.alias("broken_rules"))
    )


def repeated_keys(rows: DataFrame, keys: Sequence[str], loaded: DataFrame | None = None) -> DataFrame:
    """Keys that several rows have, or a row and one that is `loaded` already.

    Only keys are shuffled, after a partial count, so a key may have any number of rows.
    """
    mine = rows.select(*keys, F.lit(1).alias("mine"))
    if loaded is not None:
        mine = mine.unionByName(loaded.select(*keys, F.lit(0).alias("mine")))
    counts = mine.groupBy(*keys).agg(F.count("*").alias("copies"), F.max("mine").alias("mine"))
    return counts.where("copies > 1 and mine = 1").drop("mine")


def with_repeated_keys(checked: DataFrame, repeated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `primary_key` to the broken rules of all rows whose key is in repeated_keys."""
    names = {key: f"repeated_{key}" for key in keys}
    few = repeated.select(*[F.col(key).alias(name) for key, name in names.items()], F.lit("primary_key").alias("repeated"))
    same = F.lit(True)
    for key, name in names.items():
        same = same & F.col(key).eqNullSafe(F.col(name))
    rules = F.concat_ws(",", F.when(F.col("broken_rules") != "", F.col("broken_rules")), F.col("repeated"))
    return checked.join(few, same, "left").withColumn("broken_rules", rules).drop("repeated", *names.values())


def key_clashes(rows: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `rows` that are loaded already, from another month set: (keys, load_month,
    loaded_month), a row for each pair of month sets."""
    mine = rows.select(*keys, "load_month").distinct()
    theirs = loaded.select(*keys, F.col("load_month").alias("loaded_month")).distinct()
    return mine.join(theirs, list(keys)).where("load_month <> loaded_month")


def rule_counts(checked: DataFrame) -> DataFrame:
    """Rows per broken rule, from with_broken_rules."""
    broken = checked.where(F.col("broken_rules") != "")
    rules = broken.select(F.explode(F.split("broken_rules", ",")).alias("rule"))
    return rules.groupBy("rule").agg(F.count("*").alias("rows"))
