import datetime as dt

from skillscope.defaults import COMPARISON_MAP, SKILL_RULES
from skillscope.operators import marts
from skillscope.operators.tagging import flag_columns, keyword_flags

JOBS = "description string, month date, salary_gbp double"
JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def jobs(spark, *rows):
    return keyword_flags(spark.createDataFrame(list(rows), JOBS), "description")


def test_demand(spark):
    df = jobs(spark, ("python", FEB, 1.0), ("python rust", JAN, None), ("python", JAN, 1.0),
              ("python", None, 1.0), ("nothing", JAN, 1.0), (None, JAN, 1.0))
    mart = marts.skill_demand(df)
    assert [tuple(r) for r in mart.collect()] == [
        ("Python", JAN, 2), ("Python", FEB, 1), ("Python", None, 1), ("Rust", JAN, 1),
    ], "no zero rows, NULL months are a group and come last"
    assert [t for _, t in mart.dtypes] == ["string", "date", "bigint"]


def test_salary_by_skill(spark):
    rows = [("python", JAN, p) for p in (10_000.0, 20_000.4, 60_000.0, 60_000.0, None)]
    rows += [("rust", JAN, 50_000.0), ("rust", JAN, 50_001.0), ("rust", JAN, None)]
    rows += [("golang", JAN, 90_000.0)] * 3
    mart = marts.salary_by_skill(jobs(spark, *rows))
    assert [tuple(r) for r in mart.collect()] == [
        ("Go", 3, 90_000.0, 90_000.0, 90_000.0, 90_000.0),
        ("Python", 4, 37_500.0, 40_000.0, 10_000.0, 60_000.0),
    ], "two paid postings are too few"
    for r in mart.collect():
        assert r["min_salary_gbp"] <= r["median_salary_gbp"] <= r["max_salary_gbp"]


def test_job_count_is_the_sum_of_flags(spark):
    df = jobs(spark, *[(t, JAN, 1.0) for t in ("python java", "python", "x sql rust", "")])
    total = sum(r[c] for r in df.collect() for c in flag_columns(SKILL_RULES))
    assert sum(r["job_count"] for r in marts.skill_demand(df).collect()) == total


def test_comparison_has_a_row_per_mapped_skill(spark):
    survey = spark.createDataFrame([], "languages_used string, annual_comp_usd double")
    df = jobs(spark, ("python", JAN, 100.0))
    rows = marts.salary_comparison(df, marts.survey_benchmarks(survey)).collect()
    assert {r["skill"] for r in rows} == set(COMPARISON_MAP)
    assert rows[0]["skill"] == "Python" and rows[0]["uk_avg_salary_gbp"] == 100.0
    assert {r["market_position"] for r in rows} == {"Parity"}
    assert all(r["uk_job_count"] == 0 and r["uk_avg_salary_gbp"] is None for r in rows[1:])


def test_enriched_columns(spark):
    staged = spark.createDataFrame(
        [("a", "python", 1.0)], "job_id string, description string, salary_gbp double"
    )
    bench = spark.createDataFrame(
        [("Python", 5.0, 9)], "skill_name string, so_avg_comp_usd double, so_respondent_count long"
    )
    df = marts.enrich_postings(staged, bench)
    assert df.columns == ["job_id", "salary_gbp", *flag_columns(SKILL_RULES),
                          "total_skills_required", "so_market_benchmark_usd"]
    tagged = keyword_flags(staged, "description", SKILL_RULES)
    assert marts.enrich_postings(tagged, bench).collect() == df.collect()


def test_prediction_mart_uses_unrounded_inputs(spark):
    df = spark.createDataFrame(
        [("a", "t", 1.4, 2.6), ("b", "t", 100.0, 90.0), ("c", "t", None, 1.0)],
        "job_id string, job_title string, actual_salary_gbp double, predicted_salary_gbp double",
    )
    rows = [tuple(r) for r in marts.prediction_mart(df).collect()]
    assert rows == [("b", "t", 90.0, 100.0, 10.0), ("a", "t", 3.0, 1.0, 1.0),
                    ("c", "t", 1.0, None, None)]


def test_forecast_mart(spark):
    df = spark.createDataFrame(
        [("b", FEB, 1.25, 0.04, 9.96), ("a", FEB, 1.0, 1.0, 1.0), ("b", JAN, 2.0, 2.0, 2.0)],
        "skill string, forecast_date date, predicted_demand double, demand_lower double, "
        "demand_upper double",
    )
    rows = [tuple(r) for r in marts.forecast_mart(df).collect()]
    assert rows == [("a", FEB, 1.0, 1.0, 1.0), ("b", JAN, 2.0, 2.0, 2.0),
                    ("b", FEB, 1.3, 0.0, 10.0)]
