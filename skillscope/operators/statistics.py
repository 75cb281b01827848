"""Count, mean, extremes and exact median per key, without gathering a key in one task.

``median()`` keeps a value -> count map of a whole group in one task. Here the first pass sums up
buckets of neighbouring values, combined before the shuffle; they give all statistics but the median
and tell which bucket holds the middle ranks. Each further pass splits that bucket's range of values
into ``SPLITS`` parts and sums them up again, until the part with the middle rank holds one distinct
value. No pass shuffles, sorts or gathers the values themselves, however they are spread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillscope.session import discard, materialise

# Buckets per e-fold of a value: a bucket is a thousandth of the values in it wide.
BUCKETS_PER_EFOLD = 1024

# Parts of a range in a further pass.
SPLITS = 4096


def _bucket(value: Column) -> Column:
    """A bucket number that never decreases as the value grows."""
    size = F.floor(F.log1p(F.abs(value)) * F.lit(float(BUCKETS_PER_EFOLD)))
    return F.coalesce(F.signum(value).cast("long") * size, F.lit(0))


def _part(value: Column) -> Column:
    """Which part of [least, most] a value lies in; halved, as the width may exceed a double."""
    share = (value / 2 - F.col("least") / 2) / (F.col("most") / 2 - F.col("least") / 2)
    return F.least(F.floor(share * F.lit(float(SPLITS))), F.lit(SPLITS - 1))


def _with_rank(parts: DataFrame, group: list[str], order: str) -> DataFrame:
    """The part of each group that holds its ``rank``, with the rows ``before`` it."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("upto", F.col("before") + F.sum("size").over(upto))
    parts = parts.withColumn("before", F.col("upto") - F.col("size"))
    return parts.filter(F.expr("upto >= rank AND before < rank")).drop("upto", "size", order)


def grouped_statistics(df: DataFrame, key: str, value: str, min_count: int = 1) -> DataFrame:
    """``n, mean, median, low, high`` per key with at least ``min_count`` rows.

    NaN and infinite values count as missing. Callers leave out NULL keys and values, and store
    ``df`` if it is costly: it is read once for each pass.
    """
    v = F.col(value)
    finite = ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    placed = df.select(key, value).filter(finite)
    per_key = Window.partitionBy(key)
    buckets = placed.withColumn("bucket", _bucket(v)).groupBy(key, "bucket").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(value).alias("total"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )
    whole = (
        buckets
        .withColumn("n", F.sum("size").over(per_key))
        .withColumn("mean", F.sum("total").over(per_key) / F.col("n"))
        .withColumn("low", F.min("least").over(per_key))
        .withColumn("high", F.max("most").over(per_key))
        .filter(F.col("n") >= min_count)
    )
    # Ranks are 1-based; an even count has two middle ranks, which may lie in two buckets.
    ranks = F.expr("inline(array(named_struct('which', 1, 'rank', (n + 1) div 2), "
                   "named_struct('which', 2, 'rank', n div 2 + 1)))")
    carried = ["n", "mean", "low", "high"]
    ranked = whole.select(key, "bucket", "size", "least", "most", *carried, ranks)
    ranked = ranked.withColumn("before", F.lit(0).cast("long"))
    group = [key, "which"]
    state = materialise(_with_rank(ranked, group, "bucket"), "middle")
    found, stores = [], [state]
    while state.filter("least < most").limit(1).count():
        found.append(state.filter("least = most"))
        wide = state.filter("least < most")
        inside = placed.join(wide, key).filter(F.col(value).between(F.col("least"), F.col("most")))
        parts = inside.withColumn("part", _part(F.col(value))).groupBy(
            *group, "rank", "before", "part", *carried
        ).agg(
            F.count(F.lit(1)).alias("size"), F.min(value).alias("least"),
            F.max(value).alias("most"),
        )
        state = materialise(_with_rank(parts, group, "part"), "middle")
        stores.append(state)
    names = [*group, "least", *carried]
    ends = reduce(DataFrame.unionAll, [part.select(*names) for part in [*found, state]])
    lower, upper = (F.max(F.when(F.col("which") == i, F.col("least"))) for i in (1, 2))
    result = materialise(ends.groupBy(key).agg(
        F.max("n").alias("n"),
        F.max("mean").alias("mean"),
        (lower + (upper - lower) * F.lit(0.5)).alias("median"),
        F.max("low").alias("low"),
        F.max("high").alias("high"),
    ), "statistics")
    for stored in stores:
        discard(stored)
    return result
