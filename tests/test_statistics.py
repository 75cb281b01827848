import random
import statistics

import pytest
from pyspark.sql import functions as F

from skillscope.operators.statistics import _with_rank, grouped_statistics


def stats(spark, rows, **options):
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    return {r["k"]: r for r in grouped_statistics(df, "k", "v", **options).collect()}


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    draws = {
        "one": lambda: 5.0,
        "two": lambda: rng.choice([1.0, 2.0]),
        "money": lambda: round(rng.uniform(10_000, 500_000), 2),
        "signed": lambda: rng.uniform(-3, 3),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12),
        "close": lambda: 1e6 + rng.random() * 1e-3,
        "zeros": lambda: rng.choice([0.0, 0.0, -1.0, 1.0]),
    }
    values = {k: [f() for _ in range(rng.randint(1, 400))] for k, f in draws.items()}
    rows = [(k, v) for k, vs in values.items() for v in vs]
    got = stats(spark, rows)
    assert set(got) == set(values)
    for k, vs in values.items():
        wanted = statistics.median(vs)
        assert got[k]["median"] == pytest.approx(wanted, rel=1e-12, abs=1e-15), k
        assert (got[k]["n"], got[k]["low"], got[k]["high"]) == (len(vs), min(vs), max(vs))
        assert got[k]["mean"] == pytest.approx(statistics.fmean(vs), rel=1e-9, abs=1e-9)


def test_hot_key(spark):
    """A key with most rows, all of one value but a few; agrees with the built-in aggregate."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("k"),
        F.when(F.col("id") % 5 == 0, F.col("id").cast("double")).otherwise(F.lit(42.0)).alias("v"),
    )
    got = grouped_statistics(df, "k", "v").select("k", "n", "median")
    want = df.groupBy("k").agg(F.count("v").alias("n"), F.median("v").alias("median"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_small_groups(spark):
    rows = [("single", 3.0), ("pair", 1.0), ("pair", 100_000.0)]
    got = stats(spark, rows)
    assert got["single"]["median"] == 3.0 and got["pair"]["median"] == 50_000.5
    assert set(stats(spark, rows, min_count=2)) == {"pair"}


@pytest.mark.parametrize("spread", ["50000 + id / 20000.0", "id * 4e-9", "-1e-300 * id", "(id % 7 - 3) / 3.0D * 1.7e308"])
def test_many_values_in_one_bucket(spark, spread):
    """200 000 values that one bucket holds: no task sorts or holds more rows than there are parts."""
    df = spark.range(200_000).selectExpr("'k' AS k", f"CAST({spread} AS DOUBLE) AS v")
    row = grouped_statistics(df, "k", "v").first()
    values = sorted(r["v"] for r in df.collect())
    assert row["median"] == pytest.approx((values[99_999] + values[100_000]) / 2, rel=1e-12)
    assert row["n"] == 200_000 and (row["low"], row["high"]) == (values[0], values[-1])


def test_windows_see_sums_only(spark):
    """Windows run over buckets or parts, never over values."""
    parts = spark.createDataFrame([("k", 1, 3, 0, 0, 2), ("k", 1, 3, 0, 5, 2)], "k string, which int, rank int, before int, part int, size int")
    assert [tuple(r) for r in _with_rank(parts, ["k", "which"], "part").collect()] == [("k", 1, 3, 2)]


def test_values_that_are_no_numbers(spark):
    got = stats(spark, [("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", float("inf")), ("b", 2.0), ("c", float("nan"))])
    assert {k: (r["n"], r["median"]) for k, r in got.items()} == {"a": (2, 2.0), "b": (1, 2.0)}


def test_scratch_is_left_clean(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("skillscope.session.scratch_dir", lambda s: str(tmp_path))
    grouped_statistics(spark.createDataFrame([("a", 1.0), ("a", 1.001)], "k string, v double"), "k", "v").collect()
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["statistics"]
