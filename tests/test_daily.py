import json

from pyspark.sql import functions as F

from skillscope.defaults import COMPARISON_MAP, Rule
from skillscope.plans.daily import INDEX_MAP, DailyRun, run_daily
from skillscope.sinks import land_json, write_survey_csv
from generate import generate_postings, generate_survey


def test_landed_files_to_indexes(spark, tmp_path):
    months = F.date_format(F.add_months(F.lit("2024-01-01").cast("date"),
                                        (F.col("id") % 9).cast("int")), "yyyy-MM-dd")
    jobs = generate_postings(spark.range(400).withColumn("ds", months), "id", "ds")
    path = land_json(jobs, str(tmp_path / "jobs"), "2024-09-01")
    survey = str(tmp_path / "survey")
    write_survey_csv(generate_survey(spark.range(500), "id"), survey)
    run = DailyRun(path, survey, str(tmp_path / "results"), str(tmp_path / "indexes"),
                   json_lines=True, trees=3, tables_path=str(tmp_path / "tables"))
    assert run_daily(spark, run) == list(INDEX_MAP)

    jobs = spark.table("int_jobs_enriched")
    assert jobs.count() == 400 and "description" not in jobs.columns
    comparison = spark.table("mart_salary_comparison")
    assert {r["skill"] for r in comparison.collect()} == set(COMPARISON_MAP)
    unknown = comparison.filter("global_so_respondents IS NULL").collect()
    assert {r["skill"] for r in unknown} == {"React", "Node.js"}, "no list in the survey has them"
    demand = spark.table("mart_skill_demand")
    forecasts = spark.table("mart_forecasts")
    assert forecasts.count() == 6 * demand.select("skill").distinct().count()
    assert forecasts.agg(F.min("forecast_date")).first()[0].isoformat() == "2024-10-01"
    predictions = spark.table("mart_salary_predictions")
    assert 40 < predictions.count() < 120
    metrics = {(r["metric"], r["name"]): r["value"] for r in spark.table("model_metrics").collect()}
    assert metrics["predictions", "n"] == predictions.count() and metrics["predictions", "mae"] > 0
    assert metrics["forecasts", "forecast_rows"] == forecasts.count()
    assert sum(k == "importance" for k, _ in metrics) == 5
    assert not any(k == "skipped_series" for k, _ in metrics)
    for index, table in INDEX_MAP.items():
        lines = [json.loads(r[0]) for r in spark.read.text(f"{run.index_path}/{index}").collect()]
        assert len(lines) == spark.table(table).count()
        assert set(lines[0]) == set(spark.table(table).columns)

    for table in ("raw_postings", "int_jobs_enriched", "mart_skill_demand"):
        spark.sql(f"DROP TABLE {table}")
    run_daily(spark, run)
    assert spark.table("int_jobs_enriched").count() == 400, "a rerun replaces"
    for table in ("raw_postings", "raw_survey", "int_jobs_enriched", "model_metrics", *INDEX_MAP.values()):
        spark.sql(f"DROP TABLE {table}")


def test_other_rules_end_to_end(spark, tmp_path):
    """A foreign rule list with its own prices, labels, thresholds and pay range."""
    rules = (Rule("skill_weld", "Welding", ("%weld%",)), Rule("skill_saw", "Sawing", ("%saw%",)))
    jobs = [{"id": f"j{i}", "title": "T", "description": ["weld", "saw", "weld and saw", None][i % 4],
             "salary_min": 20_000 + 9_000 * (i % 4 == 0) + i, "created": f"2024-{1 + i % 6:02d}-02T09:00:00Z"} for i in range(200)]
    (tmp_path / "jobs").mkdir()
    (tmp_path / "jobs" / "a.json").write_text("\n".join(map(json.dumps, jobs)))
    lines = [f"{i},{'Torch;Saw' if i % 2 else 'Torch'},{500 + i}" for i in range(50)]
    (tmp_path / "s.csv").write_text("ResponseId,LanguageHaveWorkedWith,ConvertedCompYearly\n" + "\n".join(lines) + "\n1,2\n")
    run = DailyRun(str(tmp_path / "jobs"), str(tmp_path / "s.csv"), str(tmp_path / "r"), str(tmp_path / "i"), json_lines=True,
                   multi_line=False, on_bad="DROPMALFORMED", rules=rules, spec={"pay_weld": ("Torch",)}, pairs={"skill_weld": "pay_weld"},
                   label_map={"Welding": "Torch"}, min_postings=1, min_labelled=10, pay_range=(100, 1000), trees=3,
                   forecast_method="linear", horizon=2, tables_path=str(tmp_path / "t"))
    run_daily(spark, run)
    assert [r["skill"] for r in spark.table("mart_salary_comparison").collect()] == ["Welding"]
    assert spark.table("int_jobs_enriched").filter("so_market_benchmark_usd IS NOT NULL").count() == 100
    assert spark.table("mart_forecasts").count() == 2 * 2
    held = spark.table("mart_salary_predictions")
    assert held.filter("predicted_salary_gbp IS NULL").count() == 0 and 15 < held.count() < 70
    names = {r["name"] for r in spark.table("model_metrics").filter("metric = 'importance'").collect()}
    assert names == {"skill_weld", "skill_saw"}
    for table in ("raw_postings", "raw_survey", "int_jobs_enriched", "model_metrics", *INDEX_MAP.values()):
        spark.sql(f"DROP TABLE {table}")
