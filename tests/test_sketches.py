import random

import pytest
from pyspark.sql import functions as F

from skillscope.operators.sketches import SKETCH_ERROR, SKETCH_SIZE, merge_sketches, merged_quantiles, quantile_sketches


def values(spark, n, shape):
    rng = random.Random(n)
    draw = {"even": rng.random, "skewed": lambda: rng.lognormvariate(10, 2), "ties": lambda: float(rng.randint(0, 3))}[shape]
    return [(f"d{i % 9}", "a" if i % 3 else "b", draw()) for i in range(n)]


@pytest.mark.parametrize("shape", ["even", "skewed", "ties"])
def test_merged_ranks_are_within_the_stated_error(spark, shape):
    rows = values(spark, 60_000, shape)
    df = spark.createDataFrame(rows, "day string, key string, v double").repartition(6)
    daily = quantile_sketches(df, ["key", "day"], "v")
    assert daily.count() == 9
    names = {"low": 0.1, "median": 0.5, "high": 0.9}
    for stored in (daily, merge_sketches(daily, ["key"])):  # merging in steps changes no bound
        for r in merged_quantiles(stored, ["key"], names).collect():
            own = [v for _, k, v in rows if k == r["key"]]
            assert r["n"] == len(own)
            for name, q in names.items():
                below = sum(v < r[name] for v in own) / len(own)
                upto = sum(v <= r[name] for v in own) / len(own)
                assert below - SKETCH_ERROR <= q <= upto + SKETCH_ERROR


def test_small_groups_are_exact_and_missing_values_go(spark):
    rows = [("d", "a", float(i)) for i in range(SKETCH_SIZE - 1)] + [("e", "a", x) for x in (None, float("nan"), float("inf"))]
    df = spark.createDataFrame([*rows, ("d", "none", None)], "day string, key string, v double")
    got = merged_quantiles(quantile_sketches(df, ["key", "day"], "v"), ["key"], {"median": 0.5}).collect()
    assert [tuple(r) for r in got] == [("a", SKETCH_SIZE - 1, float((SKETCH_SIZE - 2) // 2))]
    assert quantile_sketches(df.where(F.lit(False)), ["key"], "v").count() == 0
