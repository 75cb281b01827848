"""Demand forecasts per series of monthly counts.

``linear`` is one aggregate in the JVM. ``piecewise`` is the trend model of Taylor and Letham,
"Forecasting at scale" (2018), without seasonality: a straight line whose slope may change at up to
25 points, fitted per series in a grouped pandas function. A series holds one row per month, so a
group is bounded by the calendar, not by the postings behind it.
"""

from __future__ import annotations

import hashlib
import logging
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.defaults import CHANGEPOINT_SCALE, FORECAST_MONTHS, MIN_SERIES_POINTS
from skillscope.functions.dates import month_index
from skillscope.schemas import FORECAST_SCHEMA

log = logging.getLogger(__name__)

# 80 % interval, prior widths and changepoint layout of the published model.
INTERVAL_Z = 1.28155
INTERVAL = (0.1, 0.9)
CHANGEPOINTS, CHANGEPOINT_RANGE, SLOPE_SD, SAMPLES = 25, 0.8, 5.0, 1000
MIN_VARIANCE = 1e-6


def forecast(
    series: DataFrame,
    key: str = "skill",
    month: str = "month",
    y: str = "job_count",
    horizon: int = FORECAST_MONTHS,
    min_points: int = MIN_SERIES_POINTS,
    method: str = "piecewise",
) -> DataFrame:
    """The next ``horizon`` months per series with at least ``min_points`` months.

    Rows without a month are left out first. No value is below zero.
    """
    points = series.filter(F.col(month).isNotNull()).select(
        F.col(key).alias("skill"), F.col(month).alias("month"), F.col(y).cast("double").alias("y")
    )
    if method == "linear":
        return _linear(points, horizon, min_points)
    if method == "piecewise":
        return _piecewise(points, horizon, min_points)
    raise ValueError(f"method must be 'linear' or 'piecewise', not {method!r}")


def _linear(points: DataFrame, horizon: int, min_points: int) -> DataFrame:
    x = month_index(F.col("month")).cast("double")
    y = F.col("y")
    fitted = points.groupBy("skill").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("month").alias("last"),
        F.max(x).alias("x_last"),
        F.regr_avgx(y, x).alias("x_mean"),
        F.regr_avgy(y, x).alias("y_mean"),
        F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias("slope"),  # one month only: its mean
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_syy(y, x).alias("syy"),
    ).filter(F.col("n") >= min_points)
    unexplained = F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx")
    freedom = F.greatest(F.col("n") - 2, F.lit(1))
    spread = F.lit(INTERVAL_Z) * F.sqrt(F.greatest(unexplained, F.lit(0.0)) / freedom)
    ahead = fitted.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    point = F.col("y_mean") + F.col("slope") * (F.col("x_last") + F.col("h") - F.col("x_mean"))
    floor = F.lit(0.0)
    return ahead.select(
        "skill",
        F.add_months("last", F.col("h")).alias("forecast_date"),
        F.greatest(floor, point).alias("predicted_demand"),
        F.greatest(floor, point - spread).alias("demand_lower"),
        F.greatest(floor, point + spread).alias("demand_upper"),
    )


def sparse_fit(gram: np.ndarray, moment: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The least of b'Gb/2 - m'b + sum(penalty * |b|), by an active set with signs.

    Every step lowers the objective and so no set of signs comes twice: the search ends by itself.
    Raises where the result does not meet the optimality conditions.
    """
    def value(b: np.ndarray) -> float:
        return float(b @ gram @ b / 2 - moment @ b + penalty @ np.abs(b))

    b = np.zeros(len(moment))
    free, signs = penalty == 0, np.zeros(len(moment))
    active, slack = free.copy(), 1e-9 * max(1.0, float(np.max(np.abs(moment))))
    while True:
        pull = gram @ b - moment
        settled = np.where(active, np.abs(pull + penalty * signs), 0.0).max() <= slack
        if settled:
            excess = np.where(active, -np.inf, np.abs(pull) - penalty)
            worst = int(np.argmax(excess))
            if excess[worst] <= slack:
                return b
            active[worst], signs[worst] = True, -np.sign(pull[worst])
        chosen = np.flatnonzero(active)
        inner = gram[np.ix_(chosen, chosen)]
        goal = np.zeros(len(b))
        goal[chosen] = np.linalg.lstsq(inner, moment[chosen] - (penalty * signs)[chosen], rcond=None)[0]
        # Along the way to the goal, the best of the goal and of all places where a sign changes.
        crossing = [b[i] / (b[i] - goal[i]) for i in chosen if not free[i] and b[i] * goal[i] < 0]
        steps = [b + t * (goal - b) for t in crossing] + [goal]
        for t, place in zip(crossing, steps, strict=False):
            place[np.abs(place) < 1e-14 * max(1.0, float(np.max(np.abs(place))))] = 0.0
        best = min(steps, key=value)
        if value(best) >= value(b) - 1e-15 * max(1.0, abs(value(b))):
            if np.max(np.abs(best - b)) > 1e-6 * max(1.0, float(np.max(np.abs(b)))) or not settled:
                residual = np.where(active, np.abs(pull + penalty * signs), np.abs(pull) - penalty)
                if residual.max() > 1e-6 * max(1.0, float(np.max(np.abs(moment)))):
                    raise ArithmeticError("the trend fit does not meet its optimality conditions")
            return b
        b = best
        signs = np.where(free, 0.0, np.sign(b))
        active = free | (b != 0)


def fit_trend(t: np.ndarray, y: np.ndarray, scale: float = CHANGEPOINT_SCALE):
    """Most probable (slope, offset, slope changes), their places and the residual variance.

    Given the variance, the fit under normal and Laplace priors is exact; given the fit, the
    variance under its half-normal prior has a closed form. Both lower the same objective, and the
    rounds end when neither does any more.
    """
    early = int(np.floor(len(t) * CHANGEPOINT_RANGE))
    count = min(CHANGEPOINTS, early - 1)
    places = np.linspace(0, max(early - 1, 0), max(count, 0) + 1).round().astype(int)[1:]
    knots = t[places]
    design = np.column_stack([t, np.ones_like(t), np.maximum(t[:, None] - knots[None, :], 0.0)])
    gram, moment = design.T @ design, design.T @ y
    ridge = np.concatenate([np.full(2, 1.0 / SLOPE_SD**2), np.zeros(len(knots))])
    rate = np.concatenate([np.zeros(2), np.full(len(knots), 1.0 / scale)])
    variance, before = 0.25, np.inf
    while True:
        beta = sparse_fit(gram + variance * np.diag(ridge), moment, variance * rate)
        rss = float(np.sum((y - design @ beta) ** 2))
        variance = max((np.sqrt(len(t) ** 2 + 16.0 * rss) - len(t)) / 8.0, MIN_VARIANCE)
        loss = (rss / (2 * variance) + len(t) / 2 * np.log(variance) + 2 * variance
                + float(ridge @ beta**2) / 2 + float(rate @ np.abs(beta)))
        if loss >= before - 1e-12 * max(1.0, abs(loss)):
            return beta, knots, variance
        before = loss


def _simulate(t: np.ndarray, changes: np.ndarray, variance: float, seed: str) -> np.ndarray:
    """Deviations from the trend at ``t`` > 1: future slope changes as frequent and as large as
    past ones, plus noise; shape (samples, len(t))."""
    rng = np.random.default_rng(int(hashlib.md5(seed.encode()).hexdigest()[:16], 16))
    drift = np.zeros((SAMPLES, len(t)))
    if len(changes):
        size = float(np.mean(np.abs(changes))) + 1e-8
        happened = rng.poisson(len(changes) * (t[-1] - 1.0), SAMPLES)
        owner = np.repeat(np.arange(SAMPLES), happened)
        when = rng.uniform(1.0, t[-1], len(owner))
        step = rng.laplace(0.0, size, len(owner))
        np.add.at(drift, owner, step[:, None] * np.maximum(t[None, :] - when[:, None], 0.0))
    return drift + rng.normal(0.0, np.sqrt(variance), drift.shape)


def piecewise_forecast(skill: str, months: pd.Series, y: pd.Series, horizon: int) -> pd.DataFrame:
    """Point forecast and interval of one series, in month order."""
    days = pd.to_datetime(months)
    order = np.argsort(days.to_numpy())
    days, values = days.iloc[order], y.to_numpy(dtype=float)[order]
    if not np.isfinite(values).all():
        raise ValueError("a value is not finite")
    future = pd.date_range(days.iloc[-1], periods=horizon + 1, freq="MS")[1:]
    origin, width = days.iloc[0], days.iloc[-1] - days.iloc[0]
    ahead = ((future - origin) / width).to_numpy(dtype=float)
    top = float(np.max(np.abs(values))) or 1.0
    if np.ptp(values) == 0:
        point = low = high = np.full(horizon, values[0])
    else:
        t = ((days - origin) / width).to_numpy(dtype=float)
        beta, knots, variance = fit_trend(t, values / top)
        hinge = np.maximum(ahead[:, None] - knots[None, :], 0.0)
        trend = beta[0] * ahead + beta[1] + hinge @ beta[2:]
        noise = _simulate(ahead, beta[2:], variance, skill)
        low, high = (np.quantile(trend + noise, q, axis=0) * top for q in INTERVAL)
        point = trend * top
    return pd.DataFrame({
        "skill": skill,
        "forecast_date": future.date,
        "predicted_demand": np.maximum(point, 0.0),
        "demand_lower": np.maximum(low, 0.0),
        "demand_upper": np.maximum(high, 0.0),
    })


def _piecewise(points: DataFrame, horizon: int, min_points: int) -> DataFrame:
    columns = FORECAST_SCHEMA.names
    # The fitting code travels with the task, so executors need numpy and pandas, not this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame(columns=columns)
        if len(rows) < min_points:
            return empty
        try:
            return piecewise_forecast(key[0], rows["month"], rows["y"], horizon)
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as problem:
            log.warning("no forecast for %r: %s", key[0], problem)
            return empty

    return points.groupBy("skill").applyInPandas(fit, FORECAST_SCHEMA)


def skipped_series(
    series: DataFrame, forecasts: DataFrame, key: str = "skill", month: str = "month",
    min_points: int = MIN_SERIES_POINTS,
) -> DataFrame:
    """Series with enough months that got no forecast, because their fit failed."""
    enough = series.filter(F.col(month).isNotNull()).groupBy(F.col(key).alias("skill")).agg(
        F.count(F.lit(1)).alias("months")
    ).filter(F.col("months") >= min_points)
    return enough.join(forecasts.select("skill").distinct(), "skill", "left_anti")


def forecast_coverage(forecasts: DataFrame) -> DataFrame:
    """How many series got a forecast, and over which months."""
    return forecasts.agg(
        F.count_distinct("skill").alias("skills"),
        F.count(F.lit(1)).alias("forecast_rows"),
        F.min("forecast_date").alias("first_month"),
        F.max("forecast_date").alias("last_month"),
    )
