"""Quantiles from sketches that merge, so that a new landing needs no pass over the older ones.

A sketch is a KLL summary of a group's values in one binary column, built next to the scan. Stored per landing
date, sketches of any set of dates are merged into the quantiles of all their values. Ranks are off by
less than ``SKETCH_ERROR`` of the rows, but for a failure in hundreds; groups of up to ``SKETCH_SIZE`` values are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_SIZE = 400
SKETCH_ERROR = 0.015


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """(keys, sketch) of every group with values; NULL, NaN and infinite values count as missing."""
    v = F.col(value).cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return df.where(finite).groupBy(*keys).agg(F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, sketch) over all rows of equal keys; further columns, such as the landing date, go."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """(keys, n, a column for each named quantile) from stored sketches."""
    merged = merge_sketches(sketches, keys)
    return merged.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in quantiles.items()])
