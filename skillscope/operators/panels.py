"""The aggregations behind dashboard panels: top terms, and top terms per date bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillscope.defaults import PANEL_BUCKETS, PANEL_SERIES, PANEL_TERMS


def _metric(agg: str, field: str) -> Column:
    if agg == "avg":
        return F.avg(field)
    if agg == "sum":
        return F.coalesce(F.sum(field), F.lit(0))
    raise ValueError(f"agg must be 'avg' or 'sum', not {agg!r}")


def panel_terms(
    df: DataFrame, term: str, field: str, agg: str, size: int = PANEL_TERMS
) -> DataFrame:
    """The ``size`` terms with the largest metric; rows without a term do not count."""
    grouped = df.filter(F.col(term).isNotNull()).groupBy(term).agg(_metric(agg, field).alias(agg))
    return grouped.orderBy(F.desc_nulls_last(agg), F.asc(term)).limit(size)


# The steps that an automatic date histogram may take, from fine to coarse.
SECOND_STEPS = (1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200)
DAY_STEPS = (1, 7)
# From a century on steps double, up to one that holds every date.
MONTH_STEPS = (1, 3, 12, 60, 120, 240, 600, *(1200 << k for k in range(8)))


def _steps(c: Column, timed: bool) -> list[tuple[Column, int, Column]]:
    """(running unit number, step, start of the bucket) of ``c`` for every step."""
    out = []
    if timed:
        stamp = c.cast("timestamp_ntz")
        seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), stamp)
        for step in SECOND_STEPS:
            start = F.timestamp_add(
                "SECOND", F.floor(seconds / step) * step, F.lit("1970-01-01").cast("timestamp_ntz"))
            out.append((seconds, step, start))
    days = F.datediff(c, F.lit("1970-01-01").cast("date"))
    months = 12 * F.year(c) + F.month(c) - 1
    for step in DAY_STEPS:
        start = F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(days / step) * step).cast("int"))
        out.append((days, step, start))
    for step in MONTH_STEPS:
        first = (F.floor(months / step) * step).cast("int")
        start = F.make_date(F.floor(first / 12).cast("int"), F.pmod(first, F.lit(12)) + 1, F.lit(1))
        # A bucket that reaches back before the year 1 starts with it.
        start = F.when((first < 12) & (first + step > 12), F.lit("0001-01-01").cast("date")).otherwise(start)
        out.append((months, step, start))
    kind = "timestamp_ntz" if timed else "date"
    return [(number, step, start.cast(kind)) for number, step, start in out]


def date_bucket(
    moment: Column, first: Column, last: Column, timed: bool, target: int = PANEL_BUCKETS
) -> Column:
    """Start of the bucket of ``moment``, by the finest step that takes at most ``target`` buckets
    from ``first`` to ``last``; steps below a day need ``timed`` values."""
    ends = zip(_steps(first, timed), _steps(last, timed), _steps(moment, timed), strict=True)
    chosen = None
    for (low, step, _), (high, _, _), (_, _, start) in reversed(list(ends)):
        fits = F.floor(high / step) - F.floor(low / step) < target
        chosen = start if chosen is None else F.when(fits, start).otherwise(chosen)
    return chosen


def panel_histogram(
    df: DataFrame,
    date: str,
    term: str,
    field: str,
    agg: str,
    size: int = PANEL_SERIES,
    target: int = PANEL_BUCKETS,
) -> DataFrame:
    """The ``size`` largest terms inside each date bucket, of which there are at most ``target``;
    buckets without a row are absent. A date column gives dates, a time column times."""
    present = df.filter(F.col(date).isNotNull() & F.col(term).isNotNull())
    span = present.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    span = span.select(F.struct("first", "last").alias("s")).scalar()
    timed = df.schema[date].dataType.typeName() != "date"
    bucket = date_bucket(F.col(date), span["first"], span["last"], timed, target)
    grouped = present.groupBy(bucket.alias("bucket"), term).agg(_metric(agg, field).alias(agg))
    largest = Window.partitionBy("bucket").orderBy(F.desc_nulls_last(agg), F.asc(term))
    return grouped.withColumn("_place", F.row_number().over(largest)).filter(
        F.col("_place") <= size
    ).drop("_place")
