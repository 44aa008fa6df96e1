"""Date arguments, rounding and calendar buckets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: date | str | None) -> Column:
    """A DATE literal, or today when no day is given.

    A literal keeps comparisons in the column's own type, so they reach partition pruning and the
    Parquet scan.
    """
    if value is None:
        return F.current_date()
    return F.lit(date.fromisoformat(value) if isinstance(value, str) else value)


def month_bucket(column: Column) -> Column:
    """First day of the month."""
    return F.trunc(column, "MM")


def round_half_up(column: Column, places: int = 1) -> Column:
    """Round half away from zero."""
    return F.round(column, places)
