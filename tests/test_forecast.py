import datetime as dt

import numpy as np
import pandas as pd
import pytest

from skillscope.operators.forecast import (
    fit_trend, forecast, forecast_coverage, piecewise_forecast, skipped_series, sparse_fit,
)
from skillscope.schemas import FORECAST_SCHEMA

SERIES = "skill string, month date, job_count bigint"


def series(spark, **values):
    rows = [
        (skill, dt.date(2023 + i // 12, i % 12 + 1, 1) if i is not None else None, y)
        for skill, points in values.items() for i, y in points
    ]
    return spark.createDataFrame(rows, SERIES).repartition(3)


def by_skill(df):
    out = {}
    for r in df.orderBy("skill", "forecast_date").collect():
        out.setdefault(r["skill"], []).append(r)
    return out


@pytest.mark.parametrize("method", ["linear", "piecewise"])
def test_gates_clipping_and_dates(spark, method):
    df = series(
        spark,
        two=[(0, 5), (1, 6)],
        two_dated=[(0, 5), (1, 6), (None, 9)],
        falling=[(i, 60 - 10 * i) for i in range(7)],
        gaps=[(0, 10), (5, 21), (11, 30)],
        flat=[(i, 4) for i in range(6)],
    )
    got = by_skill(forecast(df, method=method))
    assert set(got) == {"falling", "gaps", "flat"}
    assert all(len(rows) == 6 for rows in got.values())
    assert [r["forecast_date"] for r in got["gaps"]] == [dt.date(2024, m, 1) for m in range(1, 7)]
    assert [r["forecast_date"].month for r in got["falling"]] == [8, 9, 10, 11, 12, 1]
    assert all(r["predicted_demand"] == r["demand_lower"] == 0.0 for r in got["falling"])
    for r in got["flat"]:
        assert (r["predicted_demand"], r["demand_lower"], r["demand_upper"]) == (4.0, 4.0, 4.0)
    for rows in got.values():
        for r in rows:
            assert 0 <= r["demand_lower"] <= r["predicted_demand"] <= r["demand_upper"]
    assert forecast(df, method=method).schema.simpleString() == FORECAST_SCHEMA.simpleString()


def test_linear_against_numpy(spark):
    y = [3, 9, 4, 12, 15, 11, 20]
    rows = by_skill(forecast(series(spark, s=list(enumerate(y))), method="linear"))["s"]
    slope, offset = np.polyfit(range(7), y, 1)
    spread = 1.28155 * np.sqrt(np.sum((np.polyval([slope, offset], range(7)) - y) ** 2) / 5)
    for h, r in enumerate(rows):
        point = offset + slope * (7 + h)
        assert r["predicted_demand"] == pytest.approx(point)
        assert r["demand_upper"] == pytest.approx(point + spread)
        assert r["demand_lower"] == pytest.approx(max(point - spread, 0))


def test_empty_series(spark):
    empty = spark.createDataFrame([], SERIES)
    for method in ("linear", "piecewise"):
        assert forecast(empty, method=method).collect() == []
    with pytest.raises(ValueError):
        forecast(empty, method="seasonal")


def test_failing_series_is_skipped(spark):
    rows = [("bad", dt.date(2024, m, 1), float("nan")) for m in range(1, 6)]
    rows += [("good", dt.date(2024, m, 1), float(m)) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "skill string, month date, job_count double")
    got = by_skill(forecast(df))
    assert len(got["good"]) == 6
    assert "bad" not in got
    assert [tuple(r) for r in skipped_series(df, forecast(df)).collect()] == [("bad", 5)]


def test_piecewise_follows_a_bend():
    months = pd.Series(pd.date_range("2020-01-01", periods=40, freq="MS"))
    y = pd.Series(np.concatenate([10 + 3.0 * np.arange(20), 70 - 1.0 * np.arange(20)]))
    mixed = np.random.default_rng(1).permutation(40)
    out = piecewise_forecast("s", months.iloc[mixed], y.iloc[mixed], 6)
    assert out["predicted_demand"].to_numpy() == pytest.approx(50 - np.arange(6), abs=2.0)
    again = piecewise_forecast("s", months, y, 6)
    pd.testing.assert_frame_equal(out, again)
    width = (out["demand_upper"] - out["demand_lower"]).to_numpy()
    assert width[-1] > width[0]


def test_trend_is_the_most_probable_one():
    """No small step away from the fit has a higher posterior density."""
    rng = np.random.default_rng(3)
    t = np.linspace(0, 1, 30)
    y = np.clip(0.2 + t - 1.5 * np.maximum(t - 0.4, 0) + rng.normal(0, 0.05, 30), 0, 1)
    scale = 0.3
    beta, knots, variance = fit_trend(t, y, scale)

    def loss(b):
        fit = b[0] * t + b[1] + np.maximum(t[:, None] - knots, 0) @ b[2:]
        return (np.sum((y - fit) ** 2) / (2 * variance) + (b[0] ** 2 + b[1] ** 2) / 50
                + np.sum(np.abs(b[2:])) / scale)

    best = loss(beta)
    for _ in range(500):
        step = rng.normal(0, 10 ** rng.uniform(-4, -1), len(beta)) * (rng.random(len(beta)) < 0.3)
        assert loss(beta + step) >= best - 1e-4
    assert len(knots) == 23


def test_coverage(spark):
    df = series(spark, a=[(0, 1), (1, 2), (2, 3)], b=[(0, 1), (1, 2), (4, 3)], c=[(0, 1)])
    row = forecast_coverage(forecast(df, method="linear")).first()
    assert (row["skills"], row["forecast_rows"]) == (2, 12)
    assert (row["first_month"], row["last_month"]) == (dt.date(2023, 4, 1), dt.date(2023, 11, 1))


def test_linear_without_spread_gives_the_mean(spark):
    """Several rows of one month have no slope."""
    rows = [("s", dt.date(2024, 1, 1), v) for v in (4, 6, 8)]
    got = forecast(spark.createDataFrame(rows, SERIES), method="linear").collect()
    assert [r["predicted_demand"] for r in got] == [6.0] * 6
    assert all(r["demand_lower"] < 6 < r["demand_upper"] for r in got)


@pytest.mark.parametrize("seed", range(25))
def test_sparse_fit_meets_the_optimality_conditions(seed):
    """Random Poisson series, as the old fixed number of rounds did not suffice for them."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(4, 120))
    t, y = np.linspace(0, 1, n), rng.poisson(rng.uniform(1, 40), n).astype(float)
    y /= max(1.0, y.max())
    beta, knots, variance = fit_trend(t, y)
    design = np.column_stack([t, np.ones(n), np.maximum(t[:, None] - knots[None, :], 0.0)])
    penalty = np.r_[0, 0, np.full(len(knots), variance / 0.3)]
    gram = design.T @ design + variance * np.diag(np.r_[0.04, 0.04, np.zeros(len(knots))])
    best = sparse_fit(gram, design.T @ y, penalty)
    pull = gram @ best - design.T @ y
    on = best != 0
    assert np.abs(pull + penalty * np.sign(best))[on].max() < 1e-6
    assert (np.abs(pull) - penalty)[~on].max(initial=-1) < 1e-6
    assert best == pytest.approx(beta, abs=1e-4)
