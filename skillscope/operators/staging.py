"""Cleaning of raw postings and raw survey rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillscope.defaults import PAY_MAX, PAY_MIN
from skillscope.functions.dates import month_of, parse_created
from skillscope.functions.numbers import is_plain_number, midpoint
from skillscope.schemas import RAW_POSTING_COLUMNS

# Survey header -> staged column.
_SURVEY_NAMES = {
    "ResponseId": "response_id",
    "Country": "country",
    "DevType": "dev_type",
    "YearsCodePro": "years_code_pro",
    "EdLevel": "education_level",
    "RemoteWork": "remote_work",
    "LanguageHaveWorkedWith": "languages_used",
    "LanguageWantToWorkWith": "languages_wanted",
    "DatabaseHaveWorkedWith": "databases_used",
    "PlatformHaveWorkedWith": "platforms_used",
}


def _category(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("unknown")))


def stage_postings(raw: DataFrame, on_bad: str = "error") -> DataFrame:
    """One cleaned row per posting with an id. Columns that ``raw`` adds to the flat ones, such as
    flags made next to the scan, are passed through; ``description`` may be absent."""
    created = parse_created(F.col("created"), on_bad)
    text = [F.col("description")] if "description" in raw.columns else []
    return raw.filter(F.col("id").isNotNull()).select(
        F.col("id").alias("job_id"),
        F.col("title").alias("job_title"),
        "company_name",
        "location_name",
        midpoint(F.col("salary_min"), F.col("salary_max")).alias("salary_gbp"),
        "salary_min",
        "salary_max",
        _category("contract_type").alias("contract_type"),
        _category("category_label").alias("category"),
        *text,
        created.alias("created_at"),
        month_of(created).alias("month"),
        *[c for c in raw.columns if c not in RAW_POSTING_COLUMNS],
    )


def stage_survey(raw: DataFrame, low: float = PAY_MIN, high: float = PAY_MAX) -> DataFrame:
    """Respondents whose pay is a number within [low, high].

    The form of the number is checked in the filter only, so each surviving cell is matched once.
    """
    cell = F.col("ConvertedCompYearly")
    names = [F.col(old).alias(new) for old, new in _SURVEY_NAMES.items()]
    numeric = raw.filter(is_plain_number(cell))
    staged = numeric.select(*names, cell.try_cast("double").alias("annual_comp_usd"))
    return staged.filter(F.col("annual_comp_usd").between(low, high))
