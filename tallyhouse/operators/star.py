"""Facts joined to their dimensions, and sums of them that are kept."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.schemas import DIM_DATE, DIM_TIME, ROLLUPS

# What kept sums are by, besides the date: the hour, the site or the page. A day has 24
# rows by the hour, whatever its traffic.
GRAINS = {"hours": "time_id", "sites": "domain", "pages": "pagename"}


def star_join(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Facts with all date and time attributes.

    The join is on date_id and on the fact's partition columns, which dim_date has for
    each of its dates, so a condition on dim_date keeps Spark from opening the other
    months' folders: by itself where it names year or month, by dynamic pruning where
    it is on anything else. Spark broadcasts the dimensions where their size allows, as
    it does for centuries of days; the fact is neither shuffled nor sorted then.
    """
    return fact.join(dim_date, ["date_id", "year", "month"]).join(dim_time, "time_id")


def views_by(
    fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame, *attributes: str
) -> DataFrame:
    """Views summed by any attributes of fact and dimensions."""
    return star_join(fact, dim_date, dim_time).groupBy(*attributes).agg(
        F.sum("sumpageviewcount").alias("views")
    )


def rollups_of(fact: DataFrame) -> DataFrame:
    """Sums to keep: facts by load month and date, and in turn by each of GRAINS.

    They are sums of whole loads, so a reload of a month replaces its own and no other's.
    """
    own = ["load_month", "year", "month", "date_id"]
    others = list(GRAINS.values())
    sets = [[F.col(name) for name in (*own, finer)] for finer in others]
    grain = F.lit(None).cast("string")
    for name, finer in GRAINS.items():
        grain = F.when(F.grouping(finer) == 0, name).otherwise(grain)
    sums = fact.groupingSets(sets, *own, *others).agg(
        F.sum("sumpageviewcount").alias("sumpageviewcount"), grain.alias("grain")
    )
    return sums.select(*ROLLUPS.names)


def grain_for(attributes: Sequence[str]) -> str | None:
    """The kept sums that can answer for these attributes, None if the fact has to."""
    times = [name for name in DIM_TIME.names if name in attributes]
    finer = [*(["time_id"] if times else []), *[name for name in ("domain", "pagename") if name in attributes]]
    known = {*DIM_DATE.names, *DIM_TIME.names, "domain", "pagename"}
    if len(finer) > 1 or not known.issuperset(attributes):
        return None
    return next(name for name, column in GRAINS.items() if not finer or column == finer[0])


def views_from_rollups(
    rollups: DataFrame, dim_date: DataFrame, dim_time: DataFrame, *attributes: str
) -> DataFrame:
    """views_by from kept sums: equal to it over the facts they were made of."""
    grain = grain_for(attributes)
    if grain is None:
        raise ValueError(f"no kept sums have {attributes}; ask the fact")
    rows = rollups.where(F.col("grain") == grain).join(dim_date, ["date_id", "year", "month"])
    if grain == "hours":
        rows = rows.join(dim_time, "time_id")
    return rows.groupBy(*attributes).agg(F.sum("sumpageviewcount").alias("views"))
