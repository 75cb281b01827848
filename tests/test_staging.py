import datetime as dt

import pytest
from pyspark.sql import functions as F

from skillscope.functions.numbers import plain_number
from skillscope.operators.staging import stage_postings, stage_survey
from skillscope.schemas import SURVEY_COLUMNS

RAW = ("id string, title string, company_name string, location_name string, salary_min double, "
       "salary_max double, contract_type string, category_label string, description string, "
       "created string")


def posting(id_="a", low=None, high=None, contract=None, category=None, text="x",
            created="2024-02-29T09:00:00Z"):
    return (id_, "T", "C", "L", low, high, contract, category, text, created)


def staged(spark, *rows, **options):
    return stage_postings(spark.createDataFrame(list(rows), RAW), **options)


def test_columns_and_types(spark):
    df = staged(spark, posting())
    assert df.columns == [
        "job_id", "job_title", "company_name", "location_name", "salary_gbp", "salary_min",
        "salary_max", "contract_type", "category", "description", "created_at", "month",
    ]
    assert dict(df.dtypes)["created_at"] == "timestamp_ntz" and dict(df.dtypes)["month"] == "date"
    row = df.first()
    assert row["created_at"] == dt.datetime(2024, 2, 29, 9) and row["month"] == dt.date(2024, 2, 1)


def test_midpoint_and_lone_bounds(spark):
    df = staged(spark, posting("both", 30000.0, 40001.0), posting("low", 30000.0),
                posting("high", None, 40000.0), posting("none"))
    pay = {r["job_id"]: r["salary_gbp"] for r in df.collect()}
    assert pay == {"both": 35000.5, "low": 30000.0, "high": 40000.0, "none": None}


def test_ids_and_categories(spark):
    df = staged(spark, posting(None), posting("", contract="", category="IT Jobs"),
                posting("p", contract="Permanent"))
    rows = {r["job_id"]: (r["contract_type"], r["category"]) for r in df.collect()}
    assert rows == {"": ("", "it jobs"), "p": ("permanent", "unknown")}


def test_created(spark):
    assert staged(spark, posting(created=None)).first()["month"] is None
    for bad in ("2024-02-31T09:00:00Z", "yesterday", "2024-02-01"):
        with pytest.raises(Exception):
            staged(spark, posting(created=bad)).collect()
        assert staged(spark, posting(created=bad), on_bad="null").first()["created_at"] is None
    good = staged(spark, posting(), on_bad="null").first()
    assert good["created_at"] == dt.datetime(2024, 2, 29, 9)
    with pytest.raises(ValueError):
        staged(spark, posting(), on_bad="skip")


def test_plain_number(spark):
    cells = {"1": 1.0, " -2.5e3 ": -2500.0, ".5": 0.5, "5.": 5.0, "12d": None, "1f": None,
             "0x10": None, "nan": None, "inf": None, "20_000": None, "": None, "1,5": None,
             None: None}
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = {r["c"]: r["n"] for r in df.select("c", plain_number(F.col("c")).alias("n")).collect()}
    assert got == cells


def test_pay_filter(spark):
    pay = ["9999.99", "10000", "500000", "500000.01", None, "nan", "20000d", "20_000", "75000.5"]
    rows = [tuple([str(i)] + [None] * 9 + [p]) for i, p in enumerate(pay)]
    df = stage_survey(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SURVEY_COLUMNS)))
    assert {r["response_id"]: r["annual_comp_usd"] for r in df.collect()} == {
        "1": 10000.0, "2": 500000.0, "8": 75000.5,
    }
    assert df.columns == [
        "response_id", "country", "dev_type", "years_code_pro", "education_level", "remote_work",
        "languages_used", "languages_wanted", "databases_used", "platforms_used",
        "annual_comp_usd",
    ]
