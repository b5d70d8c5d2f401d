"""Text expressions: width fitting, length, names, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fit(column: Column, width: int, mode: str = "truncate", label: str = "value") -> Column:
    """Bring text to at most ``width`` characters.

    ``truncate`` cuts. ``error`` fails the job on visible text beyond the
    width, as a narrowing insert does; blanks beyond the width are cut.
    """
    cut = F.substring(column, 1, width)
    if mode == "truncate":
        return cut
    if mode != "error":
        raise ValueError(f"unknown mode {mode!r}")
    too_long = F.length(F.rtrim(column)) > width
    message = F.lit(f"{label} is longer than {width} characters")
    return F.when(too_long, F.raise_error(message).cast("string")).otherwise(cut)


def visible_length(column: Column) -> Column:
    """Characters without trailing blanks; 0 for NULL."""
    return F.coalesce(F.length(F.rtrim(column)), F.lit(0))


def full_name(first: Column, second: Column) -> Column:
    """Two name parts with one blank between them; a NULL part counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(second, F.lit("")))


