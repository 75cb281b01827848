"""The registered queries once more, as DuckDB SQL over the same tables."""

from __future__ import annotations

from skillscope.plans.views import LABEL_MAP, PAIRS, RULES, SPEC


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _hits(patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"text ILIKE {_text(p)}" for p in patterns) + ")"


def _flag(rule) -> str:
    condition = _hits(rule.any_of)
    if rule.none_of:
        condition += f" AND NOT {_hits(rule.none_of)}"
    return f"CAST(({condition}) AS INTEGER) AS {rule.column}"


FLAG_NAMES = [r.column for r in RULES]
FLAGS = ", ".join(FLAG_NAMES)
TOTAL = " + ".join(FLAG_NAMES)

LOW = "CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_totalprice * 0.3 END"
HIGH = "CASE WHEN o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM') THEN o_totalprice * 0.4 END"

# Common tables; each query names the ones it needs, in dependency order.
TABLES = {
    "jobs_raw": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, 'Role ' || source AS title, source AS company_name,
               lang AS location_name, {LOW} AS salary_min, {HIGH} AS salary_max,
               nullif(o_orderstatus, 'P') AS contract_type,
               nullif(o_orderpriority, '5-LOW') AS category_label, text AS description,
               CASE WHEN NOT (o_orderstatus = 'P' AND lang = 'es')
                    THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS created
        FROM documents LEFT JOIN orders ON doc_id = o_orderkey""",
    "jobs": """
        SELECT id AS job_id, title AS job_title, company_name, location_name,
               CASE WHEN salary_min IS NULL THEN salary_max
                    WHEN salary_max IS NULL THEN salary_min
                    ELSE (salary_min + salary_max) / 2 END AS salary_gbp,
               salary_min, salary_max,
               lower(coalesce(contract_type, 'unknown')) AS contract_type,
               lower(coalesce(category_label, 'unknown')) AS category, description,
               strptime(created, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
               CAST(date_trunc('month', strptime(created, '%Y-%m-%dT%H:%M:%SZ')) AS DATE) AS month
        FROM jobs_raw""",
    "flags": f"SELECT doc_id, {', '.join(map(_flag, RULES))} FROM documents",
    "tagged": "SELECT j.* EXCLUDE (description), f.* EXCLUDE (doc_id) "
              "FROM jobs j JOIN flags f ON j.job_id = CAST(f.doc_id AS VARCHAR)",
    "tall": " UNION ALL ".join(
        f"SELECT {_text(r.label)} AS skill, month, salary_gbp FROM tagged WHERE {r.column} = 1"
        for r in RULES
    ),
    "demand": "SELECT skill, month, count(*) AS job_count FROM tall GROUP BY ALL",
    "pay": """
        SELECT skill, count(*) AS job_count, round(avg(salary_gbp), 0) AS avg_salary_gbp,
               round(median(salary_gbp), 0) AS median_salary_gbp,
               round(min(salary_gbp), 0) AS min_salary_gbp,
               round(max(salary_gbp), 0) AS max_salary_gbp
        FROM tall WHERE salary_gbp IS NOT NULL GROUP BY skill HAVING count(*) >= 3""",
    "survey_raw": """
        SELECT l_orderkey || '-' || l_linenumber AS ResponseId, l_returnflag AS Country,
               p_type AS DevType, CAST(p_size AS VARCHAR) AS YearsCodePro, p_brand AS EdLevel,
               l_linestatus AS RemoteWork,
               CASE WHEN p_brand <> 'Brand#1'
                    THEN replace(p_name, ' ', ' ; ') || CASE WHEN l_linestatus = 'O'
                         THEN ';;' || split_part(p_name, ' ', 1) ELSE '' END
               END AS LanguageHaveWorkedWith,
               replace(p_name, ' ', ';') AS LanguageWantToWorkWith,
               p_brand AS DatabaseHaveWorkedWith, p_type AS PlatformHaveWorkedWith,
               CASE WHEN l_discount = 0 THEN 'NA' ELSE CAST(l_extendedprice AS VARCHAR) END
                   AS ConvertedCompYearly
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "survey": """
        SELECT ResponseId AS response_id, Country AS country, DevType AS dev_type,
               YearsCodePro AS years_code_pro, EdLevel AS education_level,
               RemoteWork AS remote_work, LanguageHaveWorkedWith AS languages_used,
               LanguageWantToWorkWith AS languages_wanted,
               DatabaseHaveWorkedWith AS databases_used,
               PlatformHaveWorkedWith AS platforms_used,
               TRY_CAST(ConvertedCompYearly AS DOUBLE) AS annual_comp_usd
        FROM survey_raw
        WHERE TRY_CAST(ConvertedCompYearly AS DOUBLE) >= 10000
          AND TRY_CAST(ConvertedCompYearly AS DOUBLE) <= 500000""",
    "tokens": """
        SELECT skill_name, response_id, annual_comp_usd
        FROM (SELECT response_id, annual_comp_usd,
                     trim(unnest(string_split(languages_used, ';'))) AS skill_name FROM survey)
        WHERE skill_name <> ''""",
    "bench": """
        SELECT skill_name, round(avg(annual_comp_usd), 0) AS so_avg_comp_usd,
               round(median(annual_comp_usd), 0) AS so_median_comp_usd,
               count(*) AS so_respondent_count
        FROM tokens GROUP BY skill_name HAVING count(*) >= 5""",
    "best": "SELECT " + ", ".join(
        f"max(so_avg_comp_usd) FILTER (skill_name IN ({', '.join(map(_text, names))})) AS {column}"
        for column, names in SPEC.items()
    ) + " FROM bench",
    "enriched": f"""
        SELECT t.*, {TOTAL} AS total_skills_required,
               round(nullif({' + '.join(f'{f} * coalesce({b}, 0)' for f, b in PAIRS.items())}, 0)
                   / nullif({' + '.join(f'{f} * CAST({b} IS NOT NULL AS INTEGER)'
                                        for f, b in PAIRS.items())}, 0), 0)
                   AS so_market_benchmark_usd
        FROM tagged t, best""",
    "local_pay": " UNION ALL ".join(
        f"SELECT {_text(r.label)} AS skill, round(avg(salary_gbp), 0) AS uk_avg_gbp, "
        f"count(*) AS uk_job_count FROM tagged WHERE {r.column} = 1 AND salary_gbp IS NOT NULL"
        for r in RULES
    ),
    "names": "SELECT * FROM (VALUES " + ", ".join(
        f"({_text(a)}, {_text(b)})" for a, b in LABEL_MAP.items()
    ) + ") v(label, word)",
    "comparison": """
        SELECT skill, uk_job_count, uk_avg_gbp AS uk_avg_salary_gbp,
               so_avg_comp_usd AS global_so_avg_salary_usd,
               so_respondent_count AS global_so_respondents,
               round(so_avg_comp_usd * 0.79, 0) AS global_so_avg_salary_gbp_equiv,
               round(uk_avg_gbp - so_avg_comp_usd * 0.79, 0) AS uk_vs_global_gap_gbp,
               CASE WHEN uk_avg_gbp > so_avg_comp_usd * 0.79 THEN 'UK above global'
                    WHEN uk_avg_gbp < so_avg_comp_usd * 0.79 THEN 'UK below global'
                    ELSE 'Parity' END AS market_position
        FROM local_pay JOIN names ON skill = label LEFT JOIN bench ON word = skill_name""",
    "split": """
        SELECT *, substr(md5('42:' || job_id), 1, 8) < '33333333' AS is_test
        FROM tagged WHERE salary_gbp IS NOT NULL""",
    "predictions": f"""
        SELECT s.job_id, s.job_title, s.salary_gbp AS actual_salary_gbp,
               coalesce(m.mean, (SELECT avg(salary_gbp) FROM split WHERE NOT is_test))
                   AS predicted_salary_gbp
        FROM split s LEFT JOIN (SELECT {FLAGS}, avg(salary_gbp) AS mean FROM split
                                WHERE NOT is_test GROUP BY ALL) m USING ({FLAGS})
        WHERE s.is_test""",
    "trend": """
        SELECT skill, max(month) AS last, max(x) AS x_last, count(*) AS n, regr_avgx(y, x) AS mx,
               regr_avgy(y, x) AS my, regr_slope(y, x) AS b, regr_sxx(y, x) AS sxx,
               regr_syy(y, x) AS syy
        FROM (SELECT skill, month, CAST(12 * year(month) + month(month) AS DOUBLE) AS x,
                     CAST(job_count AS DOUBLE) AS y FROM demand WHERE month IS NOT NULL)
        GROUP BY skill HAVING count(*) >= 3""",
    "ahead": """
        SELECT skill, CAST(last + to_months(CAST(h AS INTEGER)) AS DATE) AS forecast_date,
               my + b * (x_last + h - mx) AS point,
               1.28155 * sqrt(greatest(syy - b * b * sxx, 0) / greatest(n - 2, 1)) AS spread
        FROM trend, generate_series(1, 6) s(h)""",
    "forecasts": """
        SELECT skill, forecast_date, round(greatest(point, 0), 1) AS predicted_demand,
               round(greatest(point - spread, 0), 1) AS demand_lower,
               round(greatest(point + spread, 0), 1) AS demand_upper
        FROM ahead""",
}

# What each common table reads; the closure of a query's tables is put in front of it.
NEEDS = {
    "jobs": ["jobs_raw"],
    "tagged": ["jobs", "flags"],
    "tall": ["tagged"],
    "demand": ["tall"],
    "pay": ["tall"],
    "survey": ["survey_raw"],
    "tokens": ["survey"],
    "bench": ["tokens"],
    "best": ["bench"],
    "enriched": ["tagged", "best"],
    "local_pay": ["tagged"],
    "comparison": ["local_pay", "names", "bench"],
    "split": ["tagged"],
    "predictions": ["split"],
    "trend": ["demand"],
    "ahead": ["trend"],
    "forecasts": ["ahead"],
}


def _with(sql: str, *tables: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for parent in NEEDS.get(name, []):
            add(parent)
        if name not in wanted:
            wanted.append(name)

    for name in tables:
        add(name)
    if not wanted:
        return sql
    return "WITH " + ", ".join(f"{n} AS ({TABLES[n]})" for n in wanted) + " " + sql


def _top_terms(source: str, field: str, agg: str) -> str:
    return (f"SELECT skill, {agg}({field}) AS {agg} FROM {source} WHERE skill IS NOT NULL "
            f"GROUP BY skill ORDER BY {agg} DESC NULLS LAST, skill LIMIT 12")


def _top_per_bucket(source: str, date: str, field: str, agg: str) -> str:
    """Days or weeks counted from 1970, else months, quarters or years: the finest that gives at
    most 50 buckets."""
    cast = "BIGINT" if agg == "sum" else "DOUBLE"
    return f"""
        SELECT bucket, skill, CAST(m AS {cast}) AS {agg}
        FROM (SELECT CASE WHEN d <= 50 THEN {date}
                          WHEN w <= 50 THEN DATE '1970-01-01' + CAST(7 * (({date} - DATE '1970-01-01') // 7) AS INTEGER)
                          WHEN mm <= 50 THEN CAST(date_trunc('month', {date}) AS DATE)
                          WHEN q <= 50 THEN CAST(date_trunc('quarter', {date}) AS DATE)
                          ELSE CAST(date_trunc('year', {date}) AS DATE) END AS bucket,
                     skill, {agg}({field}) AS m
              FROM {source}, (SELECT 1 + max({date}) - min({date}) AS d,
                                     1 + (max({date}) - DATE '1970-01-01') // 7
                                       - (min({date}) - DATE '1970-01-01') // 7 AS w,
                                     1 + datediff('month', min({date}), max({date})) AS mm,
                                     1 + datediff('quarter', min({date}), max({date})) AS q
                              FROM {source})
              WHERE {date} IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY m DESC NULLS LAST, skill) <= 8"""


# The default rules once more, typed out; the swapped words are the ones of the query.
SWAPPED = "text"
for _word, _keyword in {
    "the": "python", "and": "TypeScript", "of": "java", "in": "mysql", "to": "react", "that": "node",
    "de": "docker", "und": "AWS", "la": "machine learning", "der": "go", "que": "rust", "die": "scala",
}.items():
    SWAPPED = f"replace({SWAPPED}, ' {_word} ', ' {_keyword} ')"
DEFAULT_RULES = f"""
    SELECT doc_id, CAST(contains(t, 'python') AS INTEGER) AS skill_python,
           CAST(contains(t, 'javascript') OR contains(t, 'typescript') AS INTEGER) AS skill_javascript,
           CAST(contains(t, 'java') AND NOT contains(t, 'javascript') AS INTEGER) AS skill_java,
           CAST(contains(t, ' sql') OR contains(t, 'postgresql') OR contains(t, 'mysql') AS INTEGER) AS skill_sql,
           CAST(contains(t, 'react') AS INTEGER) AS skill_react,
           CAST(contains(t, 'node') AS INTEGER) AS skill_node,
           CAST(contains(t, 'docker') OR contains(t, 'kubernetes') OR contains(t, 'k8s') AS INTEGER) AS skill_devops,
           CAST(contains(t, 'aws') OR contains(t, 'azure') OR contains(t, 'gcp') OR contains(t, 'cloud') AS INTEGER)
               AS skill_cloud,
           CAST(contains(t, 'machine learning') OR contains(t, ' ml ') OR contains(t, 'data science') AS INTEGER)
               AS skill_ml,
           CAST(contains(t, 'golang') OR contains(t, ' go ') AS INTEGER) AS skill_go,
           CAST(contains(t, 'rust') AS INTEGER) AS skill_rust,
           CAST(contains(t, 'scala') AS INTEGER) AS skill_scala
    FROM (SELECT doc_id, lower({SWAPPED}) AS t FROM documents)"""

SURVEY_CELLS = "SELECT * REPLACE (nullif(ConvertedCompYearly, 'NA') AS ConvertedCompYearly) FROM survey_raw"

# Place of a flag among the rules -> planted pay.
PLANTED = {0: 24_000, 3: 18_000, 4: 12_000, 10: 8_000, 1: 6_000}

ORACLE = {
    "flatten_postings": _with("SELECT * FROM jobs_raw", "jobs_raw"),
    "flatten_pages": _with(
        """SELECT * FROM jobs_raw WHERE location_name <> 'de' UNION ALL
           SELECT * REPLACE (location_name AS title) FROM jobs_raw WHERE location_name <> 'de'""",
        "jobs_raw",
    ),
    "stage_postings": _with("SELECT * FROM jobs", "jobs"),
    "salary_midpoint": f"""
        SELECT o_orderkey, CASE WHEN low IS NULL THEN high WHEN high IS NULL THEN low
                                ELSE (low + high) / 2 END AS salary
        FROM (SELECT o_orderkey, {LOW} AS low, {HIGH} AS high FROM orders)""",
    "null_missing": _with(
        SURVEY_CELLS, "survey_raw",
    ),
    "require_columns": _with(
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS EdLevel, "
        "CAST(NULL AS VARCHAR) AS PlatformHaveWorkedWith) FROM survey_raw", "survey_raw",
    ),
    "stage_survey": _with("SELECT * FROM survey", "survey"),
    "keyword_flags": _with("SELECT * FROM flags", "flags"),
    "total_skills": _with(f"SELECT doc_id, {TOTAL} AS total_skills_required FROM flags", "flags"),
    "unpivot_flags": _with(" UNION ALL ".join(
        f"SELECT {_text(r.label)} AS skill, doc_id FROM flags WHERE {r.column} = 1" for r in RULES
    ), "flags"),
    "skill_demand": _with("SELECT * FROM demand ORDER BY skill, month", "demand"),
    "salary_by_skill": _with("SELECT * FROM pay ORDER BY avg_salary_gbp DESC", "pay"),
    "explode_list": _with("SELECT response_id, skill_name FROM tokens", "tokens"),
    "list_token_benchmark": _with("SELECT * FROM bench", "bench"),
    "benchmark_pivot": _with("SELECT * FROM best", "best"),
    "masked_benchmark": _with(
        "SELECT job_id, total_skills_required, so_market_benchmark_usd FROM enriched", "enriched"
    ),
    "enriched_jobs": _with("SELECT * FROM enriched", "enriched"),
    "uk_by_skill": _with("SELECT * FROM local_pay", "local_pay"),
    "salary_comparison": _with("SELECT * FROM comparison", "comparison"),
    "holdout_split": _with("SELECT job_id, salary_gbp, is_test FROM split", "split"),
    "regression_metrics": _with(
        """SELECT count(*) AS n,
                  round(avg(abs(actual_salary_gbp - predicted_salary_gbp)), 1) AS mae,
                  round(100 * (1 - sum((actual_salary_gbp - predicted_salary_gbp) ** 2)
                      / regr_syy(actual_salary_gbp, actual_salary_gbp)), 1) AS r2_percent
           FROM predictions""", "predictions",
    ),
    "mart_predictions": _with(
        """SELECT job_id, job_title, round(predicted_salary_gbp, 0) AS predicted_salary_gbp,
                  round(actual_salary_gbp, 0) AS actual_salary_gbp,
                  round(abs(actual_salary_gbp - predicted_salary_gbp), 0) AS abs_error_gbp
           FROM (SELECT job_id, job_title, predicted_salary_gbp, actual_salary_gbp
                 FROM predictions)""", "predictions",
    ),
    "demand_forecast": _with("SELECT * FROM forecasts", "forecasts"),
    "forecast_coverage": _with(
        """SELECT count(DISTINCT skill) AS skills, count(*) AS forecast_rows,
                  min(forecast_date) AS first_month, max(forecast_date) AS last_month
           FROM forecasts""", "forecasts",
    ),
    "mart_forecasts": _with("SELECT * FROM forecasts ORDER BY skill, forecast_date", "forecasts"),
    "panel_salary": _with(_top_terms("pay", "avg_salary_gbp", "avg"), "pay"),
    "panel_jobs": _with(
        f"SELECT skill, CAST(sum AS BIGINT) AS sum FROM ({_top_terms('pay', 'job_count', 'sum')})",
        "pay",
    ),
    "panel_demand": _with(_top_per_bucket("demand", "month", "job_count", "sum"), "demand"),
    "panel_forecast": _with(
        _top_per_bucket("forecasts", "forecast_date", "predicted_demand", "avg"), "forecasts"
    ),
    "panel_gap": _with(_top_terms("comparison", "uk_vs_global_gap_gbp", "avg"), "comparison"),
    "index_docs": _with(
        "SELECT 'skill_demand' AS index, skill, month, job_count FROM demand", "demand"
    ),
    "salary_holdout": _with(
        "SELECT job_id, job_title, CAST(30000 + " + " + ".join(
            f"{worth} * CAST(substring(md5(job_id), {20 + place}, 1) >= '8' AS INTEGER)" for place, worth in PLANTED.items()
        ) + " AS DOUBLE) AS actual_salary_gbp, TRUE AS near FROM (SELECT job_id, job_title, "
        "substring(md5('42:' || job_id), 1, 8) < '33333333' AS is_test FROM tagged) WHERE is_test", "tagged",
    ),
    "feature_importance": _with(
        "SELECT unnest(['skill_red', 'skill_bolt', 'skill_gear', 'skill_hot', 'skill_blue']) AS feature, count(*) > 0 AS used "
        "FROM tagged", "tagged",
    ),
    "median_sketch": _with(
        "SELECT contract_type, count(*) AS n, TRUE AS near FROM tagged WHERE salary_gbp IS NOT NULL GROUP BY contract_type", "tagged",
    ),
    "demand_forecast_piecewise": _with(
        "SELECT skill, forecast_date, TRUE AS in_order FROM ahead", "ahead"
    ),
    "default_rules": DEFAULT_RULES,
    "scan_postings_json": _with("SELECT * FROM jobs_raw", "jobs_raw"),
    "scan_survey_csv": _with(SURVEY_CELLS, "survey_raw"),
    "store_table": _with("SELECT * FROM demand", "demand"),
    "store_parquet": _with("SELECT * FROM demand", "demand"),
    "store_index": _with("SELECT *, 'demand' AS indexes FROM demand", "demand"),
}
