"""The result tables. ``ordered`` adds the reading order; stored copies do without the sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillscope.defaults import (
    BENCHMARK_PAIRS, BENCHMARK_SPEC, COMPARISON_MAP, MIN_POSTINGS, MIN_RESPONDENTS, SKILL_RULES,
    USD_TO_GBP, Rule,
)
from skillscope.operators.benchmarks import (
    benchmark_pivot, compare_to_benchmark, flag_stats, list_token_benchmark, masked_benchmark,
)
from skillscope.operators.statistics import grouped_statistics
from skillscope.operators.tagging import flag_columns, keyword_flags, unpivot_flags


def _sorted(df: DataFrame, ordered: bool, *order: Column) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def survey_benchmarks(
    survey: DataFrame,
    spec: Mapping[str, Sequence[str]] = BENCHMARK_SPEC,
    label_map: Mapping[str, str] = COMPARISON_MAP,
    min_count: int = MIN_RESPONDENTS,
) -> DataFrame:
    """Average survey pay of just the names that enrichment and comparison look up: never more rows
    than those two constants list."""
    names = {*label_map.values(), *(n for wanted in spec.values() for n in wanted)}
    return list_token_benchmark(survey, min_count=min_count, names=sorted(names))


def enrich_postings(
    staged: DataFrame,
    bench: DataFrame,
    rules: Sequence[Rule] = SKILL_RULES,
    spec: Mapping[str, Sequence[str]] = BENCHMARK_SPEC,
    pairs: Mapping[str, str] = BENCHMARK_PAIRS,
) -> DataFrame:
    """Staged postings with flags, skill total and survey benchmark, without the text.

    Postings that carry the flags already are not tagged again.
    """
    if set(flag_columns(rules)) <= set(staged.columns):
        flagged = staged.drop("description")
    else:
        keep = [c for c in staged.columns if c != "description"]
        flagged = keyword_flags(staged, "description", rules, keep)
    return masked_benchmark(flagged, benchmark_pivot(bench, spec), pairs, rules)


def skill_demand(
    enriched: DataFrame, rules: Sequence[Rule] = SKILL_RULES, ordered: bool = True
) -> DataFrame:
    """Postings per skill and month; months without a posting have no row."""
    tall = unpivot_flags(enriched, ["month"], rules)
    counted = tall.groupBy("skill", "month").agg(F.count(F.lit(1)).alias("job_count"))
    return _sorted(counted, ordered, F.asc_nulls_last("skill"), F.asc_nulls_last("month"))


def salary_by_skill(
    enriched: DataFrame,
    rules: Sequence[Rule] = SKILL_RULES,
    min_count: int = MIN_POSTINGS,
    ordered: bool = True,
) -> DataFrame:
    """Pay statistics per skill with at least ``min_count`` paid postings. Reads ``enriched``
    several times, so it should be a stored table."""
    paid = enriched.filter(F.col("salary_gbp").isNotNull())
    tall = unpivot_flags(paid, ["salary_gbp"], rules)
    stats = grouped_statistics(tall, "skill", "salary_gbp", min_count)
    mart = stats.select(
        "skill",
        F.col("n").alias("job_count"),
        F.round("mean", 0).alias("avg_salary_gbp"),
        F.round("median", 0).alias("median_salary_gbp"),
        F.round("low", 0).alias("min_salary_gbp"),
        F.round("high", 0).alias("max_salary_gbp"),
    )
    return _sorted(mart, ordered, F.desc_nulls_last("avg_salary_gbp"), F.asc("skill"))


def salary_comparison(
    enriched: DataFrame,
    bench: DataFrame,
    rules: Sequence[Rule] = SKILL_RULES,
    label_map: Mapping[str, str] = COMPARISON_MAP,
    rate: float = USD_TO_GBP,
    ordered: bool = True,
) -> DataFrame:
    """Posted against surveyed pay, one row per mapped skill whether or not it has postings."""
    mapped = [r for r in rules if r.label in label_map]
    mart = compare_to_benchmark(flag_stats(enriched, mapped), bench, label_map, rate)
    return _sorted(mart, ordered, F.desc_nulls_last("uk_avg_salary_gbp"), F.asc("skill"))


def forecast_mart(forecasts: DataFrame, ordered: bool = True) -> DataFrame:
    measures = ("predicted_demand", "demand_lower", "demand_upper")
    mart = forecasts.select("skill", "forecast_date", *[F.round(c, 1).alias(c) for c in measures])
    return _sorted(mart, ordered, F.asc_nulls_last("skill"), F.asc_nulls_last("forecast_date"))


def prediction_mart(predictions: DataFrame, ordered: bool = True) -> DataFrame:
    predicted, actual = F.col("predicted_salary_gbp"), F.col("actual_salary_gbp")
    mart = predictions.select(
        "job_id",
        "job_title",
        F.round(predicted, 0).alias("predicted_salary_gbp"),
        F.round(actual, 0).alias("actual_salary_gbp"),
        F.round(F.abs(predicted - actual), 0).alias("abs_error_gbp"),
    )
    return _sorted(mart, ordered, F.desc_nulls_last("abs_error_gbp"), F.asc_nulls_last("job_id"))
