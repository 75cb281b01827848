"""Static schemas; nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

# A landed posting. VARIANT fields keep an absent key (SQL NULL) apart from a JSON null and accept
# a number where text is expected, and the other way round.
POSTING_JSON_SCHEMA = (
    "id VARIANT, title VARIANT, company VARIANT, location VARIANT, salary_min VARIANT, "
    "salary_max VARIANT, contract_type VARIANT, category VARIANT, description VARIANT, "
    "created VARIANT"
)
PAGE_JSON_SCHEMA = f"results ARRAY<STRUCT<{POSTING_JSON_SCHEMA}>>"

RAW_POSTING_COLUMNS = (
    "id", "title", "company_name", "location_name", "salary_min", "salary_max", "contract_type",
    "category_label", "description", "created",
)

SURVEY_COLUMNS = (
    "ResponseId", "Country", "DevType", "YearsCodePro", "EdLevel", "RemoteWork",
    "LanguageHaveWorkedWith", "LanguageWantToWorkWith", "DatabaseHaveWorkedWith",
    "PlatformHaveWorkedWith", "ConvertedCompYearly",
)

PREDICTION_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("actual_salary_gbp", T.DoubleType()),
    T.StructField("predicted_salary_gbp", T.DoubleType()),
])

FORECAST_SCHEMA = T.StructType([
    T.StructField("skill", T.StringType()),
    T.StructField("forecast_date", T.DateType()),
    T.StructField("predicted_demand", T.DoubleType()),
    T.StructField("demand_lower", T.DoubleType()),
    T.StructField("demand_upper", T.DoubleType()),
])
