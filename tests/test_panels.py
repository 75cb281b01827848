import datetime as dt

import pytest
from pyspark.sql import functions as F

from skillscope.operators.panels import panel_histogram, panel_terms


def test_terms(spark):
    rows = [(f"s{i:02d}", float(i % 7)) for i in range(15)] + [("none", None), (None, 99.0)]
    df = spark.createDataFrame(rows, "skill string, v double")
    got = [tuple(r) for r in panel_terms(df, "skill", "v", "avg").collect()]
    want = sorted(((k, v) for k, v in rows if k and v is not None), key=lambda r: (-r[1], r[0]))
    assert got == want[:12]
    assert panel_terms(df, "skill", "v", "avg", 99).collect()[-1]["skill"] == "none"
    sums = panel_terms(df, "skill", "v", "sum", 99)
    assert {r["skill"]: r["sum"] for r in sums.collect()}["none"] == 0.0
    with pytest.raises(ValueError):
        panel_terms(df, "skill", "v", "max")


def histogram(spark, days, **options):
    df = spark.createDataFrame([(d, "a", 1) for d in days], "d date, skill string, v int")
    rows = panel_histogram(df, "d", "skill", "v", "sum", **options).collect()
    return {r["bucket"]: r["sum"] for r in rows}


def test_bucket_steps(spark):
    day = dt.date(2024, 1, 1)
    near = [day + dt.timedelta(i) for i in (0, 1, 49)]
    assert histogram(spark, near) == dict.fromkeys(near, 1), "50 days, 50 buckets"
    weeks = histogram(spark, [*near, day + dt.timedelta(50)])
    assert len(weeks) == 2 and all((b - dt.date(1970, 1, 1)).days % 7 == 0 for b in weeks)
    months = [dt.date(2020 + m // 12, m % 12 + 1, 5) for m in range(50)]
    assert histogram(spark, months) == {m.replace(day=1): 1 for m in months}
    quarters = histogram(spark, [*months, dt.date(2024, 3, 1)])
    assert set(quarters) == {dt.date(2020 + q // 4, 3 * (q % 4) + 1, 1) for q in range(17)}
    assert histogram(spark, [dt.date(1990, 5, 1), dt.date(2020, 3, 1), dt.date(2020, 4, 1)]) == {
        dt.date(1990, 1, 1): 1, dt.date(2020, 1, 1): 2,
    }
    assert set(histogram(spark, [dt.date(1903, 5, 1), dt.date(2020, 3, 1)])) == {dt.date(1900, 1, 1), dt.date(2020, 1, 1)}
    assert histogram(spark, []) == {}


@pytest.mark.parametrize("target", [1, 7, 50])
def test_never_more_buckets_than_asked_for(spark, target):
    for span in (1, 48, 49, 50, 51, 349, 350, 700, 5000, 30000):
        days = [dt.date(1990, 1, 31) + dt.timedelta(round(span * i / 400)) for i in range(401)]
        assert len(histogram(spark, days, target=target)) <= target


def test_steps_below_a_day(spark):
    start = dt.datetime(2024, 1, 1, 23, 59, 30)
    def of(seconds):
        df = spark.createDataFrame([(start + dt.timedelta(seconds=s), "a", 1) for s in seconds], "d timestamp_ntz, skill string, v int")
        return {r["bucket"]: r["sum"] for r in panel_histogram(df, "d", "skill", "v", "sum").collect()}
    assert of([0, 1, 1, 49]) == {start: 1, start + dt.timedelta(seconds=1): 2, start + dt.timedelta(seconds=49): 1}
    assert of([0, 3600]) == {dt.datetime(2024, 1, 1, 23, 55): 1, dt.datetime(2024, 1, 2, 0, 55): 1}
    assert of([0, 86400 * 40]) == {dt.datetime(2024, 1, 1): 1, dt.datetime(2024, 2, 10): 1}


def test_largest_terms_inside_each_bucket(spark):
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = [(jan, f"s{i}", i) for i in range(10)] + [(feb, f"s{i}", -i) for i in range(10)]
    rows += [(jan, "s9", 5), (None, "s1", 7), (jan, None, 100)]
    df = spark.createDataFrame(rows, "d date, skill string, v int")
    out = panel_histogram(df, "d", "skill", "v", "sum").collect()
    got = {b: {r["skill"] for r in out if r["bucket"] == b} for b in (jan, feb)}
    assert got == {jan: {f"s{i}" for i in range(2, 10)}, feb: {f"s{i}" for i in range(8)}}
    assert max(r["sum"] for r in out) == 14


@pytest.mark.parametrize("kind, target", [("date", 50), ("timestamp_ntz", 1)])
def test_every_date_has_a_bucket(spark, kind, target):
    days = [dt.date(1, 1, 1), *(dt.date(y, 5, 1) for y in range(4, 9999, 45)), dt.date(2024, 1, 1), dt.date(9999, 12, 31)]
    df = spark.createDataFrame([(d, "a", 1) for d in days], "d date, skill string, v int").withColumn("d", F.col("d").cast(kind))
    rows = panel_histogram(df, "d", "skill", "v", "sum", target=target).collect()
    starts = sorted((r["bucket"].year, r["bucket"].month, r["bucket"].day) for r in rows)
    assert starts == [(max(1, 200 * i), 1, 1) for i in range(50)] if target == 50 else starts == [(1, 1, 1)]
    assert sum(r["sum"] for r in rows) == len(days)
