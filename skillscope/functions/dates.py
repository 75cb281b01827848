"""Column expressions on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillscope.defaults import CREATED_FORMAT


def parse_created(c: Column, on_bad: str = "error") -> Column:
    """ISO text ending in a literal Z to a timestamp without zone.

    ``on_bad="error"`` fails the job on malformed text (under ANSI mode), ``"null"`` gives NULL.
    """
    if on_bad == "error":
        return F.to_timestamp_ntz(c, F.lit(CREATED_FORMAT))
    if on_bad == "null":
        shaped = F.when(c.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"), F.substring(c, 1, 19))
        return shaped.try_cast("timestamp_ntz")
    raise ValueError(f"on_bad must be 'error' or 'null', not {on_bad!r}")


def month_of(c: Column) -> Column:
    return F.trunc(c, "MONTH")


def month_index(c: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(c) * F.lit(12) + F.month(c)
