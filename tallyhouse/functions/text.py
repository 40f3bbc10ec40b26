"""Field access on a dump line."""

from pyspark.sql import Column, functions as F


USED_FIELDS = 3  # domain, page, views


def fields(line: Column) -> Column:
    """Split on single spaces; two spaces in a row give an empty field.

    What follows the used fields stays in one piece, as nothing reads it.
    """
    return F.split(line, " ", USED_FIELDS + 1)


def field(parts: Column, position: int) -> Column:
    """Field at a 0-based position, NULL past the end of a short line."""
    return F.get(parts, F.lit(position))


def view_count(raw: Column) -> Column:
    """Count as bigint, NULL when the text is no number.

    A decimal count is cut to its whole part; only text that fails the plain
    cast pays for the pattern.
    """
    whole_part = F.regexp_extract(raw, r"^([+-]?\d+)\.\d*$", 1)
    return F.coalesce(raw.try_cast("bigint"), whole_part.try_cast("bigint"))
