"""One registered query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.defaults import SKILL_RULES
from skillscope.functions.numbers import midpoint
from skillscope.operators import marts, tagging
from skillscope.operators.benchmarks import (
    benchmark_pivot, explode_list, flag_stats, list_token_benchmark,
)
from skillscope.operators.forecast import forecast, forecast_coverage
from skillscope.operators.panels import panel_histogram, panel_terms
from skillscope.operators.predict import (
    feature_importance, fit_salary_model, holdout_split, labelled_postings, regression_metrics,
    salary_holdout,
)
from skillscope.operators.sketches import SKETCH_ERROR, merged_quantiles, quantile_sketches
from skillscope.operators.staging import stage_postings, stage_survey
from skillscope.operators.tagging import total_flags, unpivot_flags
from skillscope.plans.views import (
    KEYWORDS, LABEL_MAP, RULES, SPEC, benchmarks, enriched_postings, flagged_documents, pay_bounds,
    raw_postings, raw_survey, staged_survey, table, tagged_postings,
)
from skillscope.schemas import SURVEY_COLUMNS
from skillscope.session import materialise, scratch_dir
from skillscope.sinks import (
    documents, index_tables, land_json, replace_table, write_empty, write_parquet, write_survey_csv,
)
from skillscope.sources.postings import (
    explode_pages, flatten_postings, parse_postings, read_postings,
)
from skillscope.sources.survey import null_missing, read_survey, require_columns
from skillscope.sources.tables import read_parquet

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return register


def _nested(raw: DataFrame, title: str = "title"):
    return F.struct(
        "id",
        F.col(title).alias("title"),
        F.struct(F.col("company_name").alias("display_name")).alias("company"),
        F.struct(F.col("location_name").alias("display_name")).alias("location"),
        "salary_min",
        "salary_max",
        "contract_type",
        F.struct(F.col("category_label").alias("label")).alias("category"),
        "description",
        "created",
    )


@query("flatten_postings")
def flatten_postings_json(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    landed = raw.select(F.to_json(_nested(raw)).alias("line"))
    return flatten_postings(parse_postings(landed, "line"))


@query("flatten_pages")
def flatten_pages(spark, sf_dir):
    """Envelopes of two postings; pages in German lack their results."""
    raw = raw_postings(spark, sf_dir)
    results = F.array(_nested(raw), _nested(raw, "location_name"))
    envelope = F.struct(F.when(F.col("location_name") != "de", results).alias("results"))
    pages = raw.select(F.to_json(envelope).alias("page"))
    return flatten_postings(explode_pages(pages, "page"))


@query("stage_postings")
def stage_postings_rows(spark, sf_dir):
    return stage_postings(raw_postings(spark, sf_dir))


@query("salary_midpoint")
def salary_midpoint(spark, sf_dir):
    low, high = pay_bounds()
    return table(spark, sf_dir, "orders").select("o_orderkey", midpoint(low, high).alias("salary"))


@query("null_missing")
def survey_missing_cells(spark, sf_dir):
    return null_missing(raw_survey(spark, sf_dir))


@query("require_columns")
def require_survey_columns(spark, sf_dir):
    known = raw_survey(spark, sf_dir).drop("EdLevel", "PlatformHaveWorkedWith")
    return require_columns(known, SURVEY_COLUMNS)


@query("stage_survey")
def stage_survey_rows(spark, sf_dir):
    return stage_survey(raw_survey(spark, sf_dir))


@query("keyword_flags")
def keyword_flags(spark, sf_dir):
    return flagged_documents(spark, sf_dir).drop("lang", "source")


@query("total_skills")
def total_skills(spark, sf_dir):
    total = total_flags([r.column for r in RULES])
    return flagged_documents(spark, sf_dir).select("doc_id", total.alias("total_skills_required"))


@query("unpivot_flags")
def unpivot_flag_rows(spark, sf_dir):
    return unpivot_flags(flagged_documents(spark, sf_dir), ["doc_id"], RULES)


@query("skill_demand")
def skill_demand(spark, sf_dir):
    return marts.skill_demand(tagged_postings(spark, sf_dir), RULES)


def _salary_by_skill(spark, sf_dir, ordered=False):
    """Over a stored copy without texts, as it is in a daily run."""
    flags = [r.column for r in RULES]
    stored = materialise(tagged_postings(spark, sf_dir).select("salary_gbp", *flags), "postings")
    return marts.salary_by_skill(stored, RULES, ordered=ordered)


@query("salary_by_skill")
def salary_by_skill(spark, sf_dir):
    return _salary_by_skill(spark, sf_dir, ordered=True)


@query("explode_list")
def explode_survey_lists(spark, sf_dir):
    return explode_list(staged_survey(spark, sf_dir), "languages_used", ["response_id"])


@query("list_token_benchmark")
def list_token_benchmarks(spark, sf_dir):
    paid = staged_survey(spark, sf_dir).select("languages_used", "annual_comp_usd")
    return list_token_benchmark(materialise(paid, "survey"), with_median=True)


@query("benchmark_pivot")
def benchmark_pivot_row(spark, sf_dir):
    return benchmark_pivot(benchmarks(spark, sf_dir), SPEC)


@query("masked_benchmark")
def masked_benchmark(spark, sf_dir):
    return enriched_postings(spark, sf_dir).select(
        "job_id", "total_skills_required", "so_market_benchmark_usd"
    )


@query("enriched_jobs")
def enriched_jobs(spark, sf_dir):
    return enriched_postings(spark, sf_dir)


@query("uk_by_skill")
def uk_by_skill(spark, sf_dir):
    return flag_stats(tagged_postings(spark, sf_dir), RULES)


@query("salary_comparison")
def salary_comparison(spark, sf_dir):
    return marts.salary_comparison(
        tagged_postings(spark, sf_dir), benchmarks(spark, sf_dir), RULES, LABEL_MAP
    )


@query("holdout_split")
def holdout_split_rows(spark, sf_dir):
    paid = tagged_postings(spark, sf_dir).filter("salary_gbp IS NOT NULL")
    return holdout_split(paid.select("job_id", "salary_gbp"))


def _labelled(spark, sf_dir):
    """Written once, without the texts, for the passes that training and scoring take."""
    return materialise(labelled_postings(tagged_postings(spark, sf_dir), RULES), "labelled")


def _mean_predictions(spark, sf_dir):
    """Predictions that SQL can repeat: mean training pay of the same flags, else of all."""
    labelled = _labelled(spark, sf_dir)
    train = labelled.filter(~F.col("is_test"))
    # At most a row per combination of flags; stored, so that its size is known to the join.
    means = materialise(train.groupBy("flags").agg(F.avg("salary_gbp").alias("mean")), "means")
    overall = train.agg(F.avg("salary_gbp").alias("m")).scalar()
    return labelled.filter("is_test").join(means, "flags", "left").select(
        "job_id",
        "job_title",
        F.col("salary_gbp").alias("actual_salary_gbp"),
        F.coalesce("mean", overall).alias("predicted_salary_gbp"),
    )


@query("regression_metrics")
def regression_error(spark, sf_dir):
    metrics = regression_metrics(_mean_predictions(spark, sf_dir))
    return metrics.select(
        "n", F.round("mae", 1).alias("mae"), F.round(F.col("r2") * 100, 1).alias("r2_percent")
    )


@query("mart_predictions")
def mart_predictions(spark, sf_dir):
    return marts.prediction_mart(_mean_predictions(spark, sf_dir))


# Pay that a flag is worth where effects are planted.
WORTH = {"skill_red": 24_000, "skill_bolt": 18_000, "skill_gear": 12_000, "skill_hot": 8_000, "skill_blue": 6_000}
BASE_PAY, NEAR_PAY = 30_000, 10_000


def _planted(spark, sf_dir):
    """Postings whose flags are digits of their id's hash and whose pay is the sum of what flags are worth."""
    postings = tagged_postings(spark, sf_dir).select("job_id", "job_title")
    digest = F.md5("job_id")
    flags = {r.column: (F.substring(digest, 20 + i, 1) >= "8").cast("int") for i, r in enumerate(RULES)}
    postings = postings.withColumns(flags)
    pay = reduce(add, [F.col(c) * worth for c, worth in WORTH.items()]) + BASE_PAY
    return materialise(labelled_postings(postings.withColumn("salary_gbp", pay.cast("double")), RULES), "planted")


@query("salary_holdout")
def salary_holdout_rows(spark, sf_dir):
    """Held-out postings with planted pay of 30 000 to 98 000, and whether the prediction is near it."""
    scored = salary_holdout(_planted(spark, sf_dir), RULES)
    off = F.abs(F.col("predicted_salary_gbp") - F.col("actual_salary_gbp"))
    return scored.select("job_id", "job_title", "actual_salary_gbp", (off < NEAR_PAY).alias("near"))


@query("feature_importance")
def feature_importances(spark, sf_dir):
    """The five flags with most splits, which are those that planted pay depends on."""
    model, _ = fit_salary_model(_planted(spark, sf_dir), RULES, trees=60)
    return feature_importance(model, spark, RULES).select("feature", (F.col("splits") > 0).alias("used"))


@query("median_sketch")
def median_sketch(spark, sf_dir):
    """Median pay per contract from sketches of each month, merged; half of the pay lies below their median, within the stated error."""
    paid = tagged_postings(spark, sf_dir).where("salary_gbp IS NOT NULL").select("contract_type", "month", "salary_gbp")
    paid = materialise(paid, "paid")
    monthly = quantile_sketches(paid, ["contract_type", "month"], "salary_gbp")
    merged = merged_quantiles(monthly, ["contract_type"], {"median": 0.5})
    pay, median = F.col("salary_gbp"), F.col("median")
    shares = paid.join(merged, "contract_type").groupBy("contract_type").agg(
        F.max("n").alias("n"), F.avg((pay < median).cast("double")).alias("below"), F.avg((pay <= median).cast("double")).alias("upto"))
    near = (F.col("below") - SKETCH_ERROR <= 0.5) & (F.col("upto") + SKETCH_ERROR >= 0.5)
    return shares.select("contract_type", "n", near.alias("near"))


def _demand(spark, sf_dir):
    return marts.skill_demand(tagged_postings(spark, sf_dir), RULES, ordered=False)


def _linear(spark, sf_dir):
    return forecast(_demand(spark, sf_dir), method="linear")


@query("demand_forecast")
def demand_forecast(spark, sf_dir):
    """Rounded to what a sum of floats in another order still agrees on."""
    return _linear(spark, sf_dir).select(
        "skill",
        "forecast_date",
        F.round("predicted_demand", 1).alias("predicted_demand"),
        F.round("demand_lower", 1).alias("demand_lower"),
        F.round("demand_upper", 1).alias("demand_upper"),
    )


@query("demand_forecast_piecewise")
def demand_forecast_piecewise(spark, sf_dir):
    """Every forecast month, and whether its bounds stand in order, not below zero."""
    ahead = forecast(_demand(spark, sf_dir), method="piecewise")
    low, point, high = (F.col(c) for c in ("demand_lower", "predicted_demand", "demand_upper"))
    return ahead.select("skill", "forecast_date", (
        (low >= 0) & (low <= high) & (point >= 0) & (high < F.lit(float("inf")))).alias("in_order"))


@query("forecast_coverage")
def forecast_coverage_row(spark, sf_dir):
    return forecast_coverage(_linear(spark, sf_dir))


@query("mart_forecasts")
def mart_forecasts(spark, sf_dir):
    return marts.forecast_mart(_linear(spark, sf_dir))


@query("panel_salary")
def panel_salary(spark, sf_dir):
    return panel_terms(_salary_by_skill(spark, sf_dir), "skill", "avg_salary_gbp", "avg")


@query("panel_jobs")
def panel_jobs(spark, sf_dir):
    return panel_terms(_salary_by_skill(spark, sf_dir), "skill", "job_count", "sum")


@query("panel_demand")
def panel_demand(spark, sf_dir):
    mart = materialise(_demand(spark, sf_dir), "mart-skill-demand")
    return panel_histogram(mart, "month", "skill", "job_count", "sum")


@query("panel_forecast")
def panel_forecast(spark, sf_dir):
    mart = materialise(marts.forecast_mart(_linear(spark, sf_dir), ordered=False), "mart-forecasts")
    return panel_histogram(mart, "forecast_date", "skill", "predicted_demand", "avg")


@query("panel_gap")
def panel_gap(spark, sf_dir):
    mart = marts.salary_comparison(
        tagged_postings(spark, sf_dir), benchmarks(spark, sf_dir), RULES, LABEL_MAP,
        ordered=False,
    )
    return panel_terms(mart, "skill", "uk_vs_global_gap_gbp", "avg")


@query("index_docs")
def index_docs(spark, sf_dir):
    """Documents of the demand table, read back field by field."""
    docs = documents(_demand(spark, sf_dir), "skill_demand")
    body = F.from_json("document", "skill STRING, month DATE, job_count BIGINT")
    return docs.select("index", body.alias("b")).select("index", "b.*")


@query("default_rules")
def default_rules(spark, sf_dir):
    """The default rules, on texts whose commonest words are swapped for the rules' keywords."""
    text = F.col("text")
    for word, keyword in KEYWORDS.items():
        text = F.replace(text, F.lit(f" {word} "), F.lit(f" {keyword} "))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return tagging.keyword_flags(docs, "text", SKILL_RULES, ["doc_id"])


def _folder(spark, name):
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("scan_postings_json")
def scan_postings_json(spark, sf_dir):
    """Postings landed as JSON lines, read back; a second landing of the day changes nothing."""
    raw, root = raw_postings(spark, sf_dir), _folder(spark, "landing")
    nested = raw.select(_nested(raw).alias("p")).select("p.*")
    path = land_json(nested, root, "2024-01-01")
    land_json(nested.limit(1), root, "2024-01-01", replace=False)
    return flatten_postings(read_postings(spark, path, json_lines=True))


@query("scan_survey_csv")
def scan_survey_csv(spark, sf_dir):
    """Two CSV folders, the second with its columns the other way round."""
    raw, root = raw_survey(spark, sf_dir), _folder(spark, "survey")
    write_survey_csv(raw.filter("RemoteWork = 'O'"), f"{root}/a")
    rest = raw.filter("RemoteWork <> 'O' OR RemoteWork IS NULL")
    write_survey_csv(rest.select(*reversed(raw.columns)), f"{root}/b")
    write_survey_csv(raw.limit(1), f"{root}/b")
    return require_columns(read_survey(spark, [f"{root}/a", f"{root}/b"], multi_line=False))


@query("store_table")
def store_table(spark, sf_dir):
    """A stored table that takes the place of an older one."""
    demand, root = _demand(spark, sf_dir), _folder(spark, "tables")
    replace_table(demand.limit(1), "stored_skill_demand", root)
    return replace_table(demand, "stored_skill_demand", root)


@query("store_parquet")
def store_parquet(spark, sf_dir):
    """Parquet written twice and read by its schema, together with an empty typed result."""
    demand, root = _demand(spark, sf_dir), _folder(spark, "parquet")
    write_parquet(demand.limit(1), f"{root}/full")
    write_parquet(demand, f"{root}/full")
    write_empty(spark, demand.schema, f"{root}/empty")
    return read_parquet(spark, f"{root}/full", demand.schema).unionAll(
        read_parquet(spark, f"{root}/empty", demand.schema))


@query("store_index")
def store_index(spark, sf_dir):
    """Index folders of stored tables, read back; an absent table is left out."""
    root = _folder(spark, "indexes")
    replace_table(_demand(spark, sf_dir), "indexed_skill_demand", f"{root}/tables")
    names = {"demand": "indexed_skill_demand", "nothing": "no_such_table"}
    index_tables(spark, names, root)
    written = index_tables(spark, names, root)
    lines = spark.read.schema("skill STRING, month DATE, job_count BIGINT").json(f"{root}/demand")
    return lines.withColumn("indexes", F.lit(",".join(written)))
