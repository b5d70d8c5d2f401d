"""Date expressions over text parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years a DATETIME column of the published list can hold.
FIRST_YEAR, LAST_YEAR = 1753, 9999


def partial_date(year: Column, month: Column, day: Column, null_parts: str = "null") -> Column:
    """``Y-M-D`` as text without padding, or ``Y`` alone if month and day are blank.

    A NULL part makes the result NULL; ``null_parts="year"`` reads NULL month
    and day as blank instead.
    """
    if null_parts not in ("null", "year"):
        raise ValueError(f"unknown null_parts {null_parts!r}")
    if null_parts == "year":
        month, day = F.coalesce(month, F.lit("")), F.coalesce(day, F.lit(""))
    year_only = (F.length(F.trim(month)) < 1) & (F.length(F.trim(day)) < 1)
    return F.when(year_only, year).otherwise(
        F.concat(year, F.lit("-"), month, F.lit("-"), day)
    )


def safe_date(text: Column) -> Column:
    """Midnight of a ``Y-M-D`` text; NULL if it is no date in the allowed years."""
    day = F.try_to_date(text, "y-M-d")
    return F.when(F.year(day).between(FIRST_YEAR, LAST_YEAR), day).cast("timestamp_ntz")
