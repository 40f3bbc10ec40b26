"""What a dump's file name says about its rows.

These expressions run on lines, so they cut the name at its fixed positions and
cast, rather than use a pattern and a date formatter.
"""

from pyspark.sql import Column, functions as F

# --- fixed values: pageviews-YYYYMMDD-HHMMSS.gz -------------------------------
NAME_LENGTH = 28
DUMP_PREFIX = "pageviews-"
DATE_AT, DATE_LENGTH = 11, 8
TIME_AT, TIME_LENGTH = 20, 6
DIGITS = "0123456789"
# ------------------------------------------------------------------------------


def dump_name(day: Column, hour: Column) -> Column:
    """Name of the hourly dump of a date."""
    return F.concat(
        F.lit(DUMP_PREFIX), F.replace(day.cast("string"), F.lit("-"), F.lit("")),
        F.lit("-"), F.lpad(hour.cast("string"), 2, "0"), F.lit("0000.gz"),
    )


def path_dump_name(path: Column) -> Column:
    """Dump name from a full path.

    A dump lies in the folder as one `pageviews-….gz`, or as the parts of a
    `file_name=pageviews-….gz` folder that Spark wrote.
    """
    landed = F.regexp_extract(path, r"/file_name=([^/]+)/[^/]+$", 1)
    plain = F.substring_index(path, "/", -1)
    return F.when(landed == "", plain).otherwise(landed)


def path_place(path: Column) -> Column:
    """Where a dump lies: the path of a plain one, the folder of a landed one's parts."""
    folder = F.regexp_extract(path, r"^(.*/file_name=[^/]+)/[^/]+$", 1)
    return F.when(folder == "", path).otherwise(folder)


def _date_text(name: Column) -> Column:
    return F.substring(name, DATE_AT, DATE_LENGTH)


def _time_text(name: Column) -> Column:
    return F.substring(name, TIME_AT, TIME_LENGTH)


def _is_dump_name(name: Column) -> Column:
    digits = F.concat(_date_text(name), _time_text(name))
    return (
        (F.length(name) == NAME_LENGTH)
        & name.startswith(DUMP_PREFIX)
        & (F.substring(name, DATE_AT + DATE_LENGTH, 1) == "-")
        & name.endswith(".gz")
        & (F.translate(digits, DIGITS, "") == "")
    )


def file_date_of(name: Column) -> Column:
    """Date in the name; NULL for another name pattern or an impossible date."""
    text = _date_text(name)
    iso = F.concat(
        F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"),
        F.substring(text, 7, 2),
    )
    return F.when(_is_dump_name(name), iso.try_cast("date"))


def file_clock_of(name: Column) -> Column:
    """Time in the name as the number HHmmss; NULL for another name pattern."""
    return F.when(_is_dump_name(name), _time_text(name).cast("int"))


def clock_text(clock: Column) -> Column:
    """`HHmmss` of such a number."""
    return F.lpad(clock.cast("string"), TIME_LENGTH, "0")


def collection_date(file_date: Column, file_time: Column) -> Column:
    """`yyyy-MM-dd` the views belong to: a midnight dump closes the day before."""
    midnight = (file_time == "000000").cast("int")
    return F.date_sub(file_date, midnight).cast("string")


def collection_time(file_time: Column) -> Column:
    """`HHmmss` as `HH:mm:ss`."""
    return F.concat(
        F.substring(file_time, 1, 2), F.lit(":"), F.substring(file_time, 3, 2), F.lit(":"),
        F.substring(file_time, 5, 2),
    )
