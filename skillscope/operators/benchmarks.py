"""Pay per survey token, its attachment to postings, and the comparison of both sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.defaults import (
    ABOVE, BELOW, BENCHMARK_PAIRS, BENCHMARK_SPEC, COMPARISON_MAP, LEVEL, MIN_RESPONDENTS,
    SKILL_RULES, USD_TO_GBP, Rule,
)
from skillscope.functions.numbers import ratio
from skillscope.functions.text import split_list, trim_spaces
from skillscope.operators.statistics import grouped_statistics
from skillscope.operators.tagging import total_flags
from skillscope.sources.tables import constant_rows


def explode_list(
    df: DataFrame,
    list_col: str,
    ids: Sequence[str],
    out: str = "skill_name",
    sep: str = ";",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One row per non-empty trimmed token, or per token among ``names``; repeats inside a list
    stay."""
    tokens = df.select(*ids, F.explode(split_list(F.col(list_col), sep)).alias(out))
    trimmed = tokens.withColumn(out, trim_spaces(F.col(out)))
    if names is None:
        return trimmed.filter(F.col(out) != "")
    return trimmed.filter(F.col(out).isin([n for n in names if n]))


def list_token_benchmark(
    survey: DataFrame,
    list_col: str = "languages_used",
    value_col: str = "annual_comp_usd",
    sep: str = ";",
    min_count: int = MIN_RESPONDENTS,
    names: Sequence[str] | None = None,
    with_median: bool = False,
) -> DataFrame:
    """Average pay (and median) per token with at least ``min_count`` respondents.

    ``names`` keeps only these tokens, before anything is grouped. For the median the survey is read
    twice.
    """
    paid = survey.filter(F.col(value_col).isNotNull())
    tokens = explode_list(paid, list_col, [value_col], sep=sep, names=names)
    if with_median:
        stats = grouped_statistics(tokens, "skill_name", value_col, min_count)
        return stats.select(
            "skill_name",
            F.round("mean", 0).alias("so_avg_comp_usd"),
            F.round("median", 0).alias("so_median_comp_usd"),
            F.col("n").alias("so_respondent_count"),
        )
    return tokens.groupBy("skill_name").agg(
        F.round(F.avg(value_col), 0).alias("so_avg_comp_usd"),
        F.count(F.lit(1)).alias("so_respondent_count"),
    ).filter(F.col("so_respondent_count") >= min_count)


def benchmark_pivot(
    bench: DataFrame, spec: Mapping[str, Sequence[str]] = BENCHMARK_SPEC
) -> DataFrame:
    """Always one row: per column the best average among its names, NULL where none is known."""
    return bench.agg(*[
        F.max(F.when(F.col("skill_name").isin(list(names)), F.col("so_avg_comp_usd"))).alias(c)
        for c, names in spec.items()
    ])


def masked_benchmark(
    flagged: DataFrame,
    pivot: DataFrame,
    pairs: Mapping[str, str] = BENCHMARK_PAIRS,
    rules: Sequence[Rule] = SKILL_RULES,
) -> DataFrame:
    """Flagged postings plus their skill total and the mean benchmark of their priced skills.

    The one-row ``pivot`` is a scalar subquery: its values reach every task as constants, without a
    join, and a second row would fail the job instead of multiplying postings.
    """
    prices = pivot.select(F.struct(*sorted(set(pairs.values())))).scalar()
    terms = [(F.col(flag), F.col("_prices")[price]) for flag, price in pairs.items()]
    paid = reduce(add, [f * F.coalesce(p, F.lit(0.0)) for f, p in terms])
    priced = reduce(add, [f * p.isNotNull().cast("int") for f, p in terms])
    return flagged.withColumn("_prices", prices).select(
        *flagged.columns,
        total_flags([r.column for r in rules]).alias("total_skills_required"),
        F.round(ratio(paid, priced), 0).alias("so_market_benchmark_usd"),
    )


def flag_stats(
    postings: DataFrame, rules: Sequence[Rule], value: str = "salary_gbp"
) -> DataFrame:
    """Count and average per rule, one row per rule even where no posting hits.

    One global aggregate over a single scan, turned into rows afterwards.
    """
    hits = [(r, F.col(r.column) == 1) for r in rules]
    wide = postings.filter(F.col(value).isNotNull()).agg(*[
        F.struct(
            F.lit(r.label).alias("skill"),
            F.round(F.avg(F.when(hit, F.col(value))), 0).alias("uk_avg_gbp"),
            F.count_if(hit).alias("uk_job_count"),
        ).alias(r.column)
        for r, hit in hits
    ])
    return wide.select(F.inline(F.array(*[r.column for r in rules])))


def compare_to_benchmark(
    stats: DataFrame,
    bench: DataFrame,
    label_map: Mapping[str, str] = COMPARISON_MAP,
    rate: float = USD_TO_GBP,
) -> DataFrame:
    """Posted pay against survey pay per skill; 'Parity' also where a side is unknown."""
    spark = stats.sparkSession
    names = constant_rows(spark, ("_skill", "_name"), list(label_map.items()))
    converted = F.col("so_avg_comp_usd") * F.lit(rate)
    local = F.col("uk_avg_gbp")
    joined = (
        stats.join(names, F.col("skill") == F.col("_skill"), "left")
        .join(bench, F.col("_name") == F.col("skill_name"), "left")
    )
    return joined.select(
        "skill",
        "uk_job_count",
        local.alias("uk_avg_salary_gbp"),
        F.col("so_avg_comp_usd").alias("global_so_avg_salary_usd"),
        F.col("so_respondent_count").alias("global_so_respondents"),
        F.round(converted, 0).alias("global_so_avg_salary_gbp_equiv"),
        F.round(local - converted, 0).alias("uk_vs_global_gap_gbp"),
        F.when(local > converted, ABOVE).when(local < converted, BELOW).otherwise(LEVEL)
        .alias("market_position"),
    )
