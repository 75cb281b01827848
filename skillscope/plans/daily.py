"""One day's run: landed files to tables, models, marts and document indexes, in that order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.defaults import (
    BENCHMARK_PAIRS, BENCHMARK_SPEC, COMPARISON_MAP, FORECAST_MONTHS, MIN_LABELLED, MIN_POSTINGS,
    MIN_SERIES_POINTS, PAY_MAX, PAY_MIN, SKILL_RULES, TREES, USD_TO_GBP,
)
from skillscope.operators import marts
from skillscope.operators.forecast import forecast, forecast_coverage, skipped_series
from skillscope.operators.predict import (
    feature_importance, fit_salary_model, labelled_postings, regression_metrics, score_holdout,
)
from skillscope.operators.staging import stage_postings, stage_survey
from skillscope.schemas import FORECAST_SCHEMA, PREDICTION_SCHEMA
from skillscope.session import discard, materialise
from skillscope.sinks import index_tables, replace_table, replace_view, write_parquet
from skillscope.sources.postings import flatten_postings, read_postings
from skillscope.sources.survey import read_survey, require_columns
from skillscope.sources.tables import read_parquet

# Index name -> table name.
INDEX_MAP = {
    "salary_by_skill": "mart_salary_by_skill",
    "skill_demand": "mart_skill_demand",
    "forecasts": "mart_forecasts",
    "salary_predictions": "mart_salary_predictions",
    "salary_comparison": "mart_salary_comparison",
}


@dataclass(frozen=True)
class DailyRun:
    """Where a run reads and writes, and every rule and threshold it goes by.

    ``spec`` and ``pairs`` price flags by survey names, ``label_map`` compares labels to them;
    a list of other ``rules`` needs its own three.
    """

    postings_path: str
    survey_path: str
    results_path: str
    index_path: str
    json_lines: bool = False
    multi_line: bool = True
    on_bad: str = "FAILFAST"
    rules: tuple = SKILL_RULES
    spec: Mapping = field(default_factory=lambda: BENCHMARK_SPEC)
    pairs: Mapping = field(default_factory=lambda: BENCHMARK_PAIRS)
    label_map: Mapping = field(default_factory=lambda: COMPARISON_MAP)
    min_postings: int = MIN_POSTINGS
    min_labelled: int = MIN_LABELLED
    min_points: int = MIN_SERIES_POINTS
    pay_range: tuple = (PAY_MIN, PAY_MAX)
    rate: float = USD_TO_GBP
    trees: int = TREES
    forecast_method: str = "piecewise"
    horizon: int = FORECAST_MONTHS
    tables_path: str | None = None


def load_raw(spark: SparkSession, run: DailyRun) -> None:
    """Replace both raw tables by the landed files."""
    postings = read_postings(spark, run.postings_path, run.json_lines)
    survey = read_survey(spark, run.survey_path, run.multi_line, run.on_bad)
    replace_table(flatten_postings(postings), "raw_postings", run.tables_path)
    replace_table(require_columns(survey), "raw_survey", run.tables_path)


def build_marts(spark: SparkSession, run: DailyRun) -> None:
    """Staging views, the enriched table, and the marts that need no model."""
    staged = replace_view(stage_postings(spark.table("raw_postings")), "stg_postings")
    low, high = run.pay_range
    survey = replace_view(stage_survey(spark.table("raw_survey"), low, high), "stg_survey")
    bench = materialise(
        marts.survey_benchmarks(survey, run.spec, run.label_map), "survey-benchmarks")
    root, rules = run.tables_path, run.rules
    enriched = marts.enrich_postings(staged, bench, rules, run.spec, run.pairs)
    enriched = replace_table(enriched, "int_jobs_enriched", root)
    for name, mart in {
        "mart_skill_demand": marts.skill_demand(enriched, rules, ordered=False),
        "mart_salary_by_skill": marts.salary_by_skill(
            enriched, rules, run.min_postings, ordered=False),
        "mart_salary_comparison": marts.salary_comparison(
            enriched, bench, rules, run.label_map, rate=run.rate, ordered=False
        ),
    }.items():
        replace_table(mart, name, root)
    discard(bench)


def run_models(spark: SparkSession, run: DailyRun) -> None:
    """Predictions and forecasts as parquet, then their marts and the table ``model_metrics``."""
    predictions, forecasts = (f"{run.results_path}/{n}" for n in ("predictions", "forecasts"))
    labelled = labelled_postings(spark.table("int_jobs_enriched"), run.rules)
    model, vectors = fit_salary_model(labelled, run.rules, run.trees, run.min_labelled)
    write_parquet(score_holdout(labelled, model, vectors, run.rules), predictions)
    demand = spark.table("mart_skill_demand").select("skill", "month", "job_count")
    ahead = forecast(
        demand, horizon=run.horizon, min_points=run.min_points, method=run.forecast_method)
    write_parquet(ahead, forecasts)
    predicted = read_parquet(spark, predictions, PREDICTION_SCHEMA)
    mart = marts.prediction_mart(predicted, ordered=False)
    replace_table(mart, "mart_salary_predictions", run.tables_path)
    ahead = read_parquet(spark, forecasts, FORECAST_SCHEMA)
    replace_table(marts.forecast_mart(ahead, ordered=False), "mart_forecasts", run.tables_path)
    metrics = model_metrics(predicted, demand, ahead, run.min_points)
    if model is not None:
        top = feature_importance(model, spark, run.rules)
        metrics = metrics.unionAll(top.select(
            F.lit("importance"), F.col("feature"), F.col("splits").cast("double")))
    replace_table(metrics, "model_metrics", run.tables_path)
    discard(vectors)


def model_metrics(predicted, demand, forecasts, min_points: int = MIN_SERIES_POINTS) -> DataFrame:
    """(metric, name, value): error of the predictions, coverage of the forecasts, and a row for
    each series that should have got a forecast and did not."""
    error = regression_metrics(predicted).select(
        F.lit("predictions").alias("metric"),
        F.inline(F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"))
            for n in ("n", "mae", "r2")
        ])),
    )
    cover = forecast_coverage(forecasts).select(
        F.lit("forecasts"),
        F.inline(F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"))
            for n in ("skills", "forecast_rows")
        ])),
    )
    skipped = skipped_series(demand, forecasts, min_points=min_points).select(
        F.lit("skipped_series"), "skill", F.col("months").cast("double"))
    return error.unionAll(cover).unionAll(skipped)


def run_daily(spark: SparkSession, run: DailyRun) -> list[str]:
    """Everything in dependency order; returns the indexes written."""
    load_raw(spark, run)
    build_marts(spark, run)
    run_models(spark, run)
    return index_tables(spark, INDEX_MAP, run.index_path)
