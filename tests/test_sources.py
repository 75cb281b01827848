import json

import pytest
from pyspark.sql import functions as F

from skillscope.schemas import RAW_POSTING_COLUMNS, SURVEY_COLUMNS
from generate import LANGUAGES, generate_postings, generate_survey
from skillscope.sources.postings import (
    explode_pages, flatten_postings, parse_postings, read_postings,
)
from skillscope.sources.survey import read_survey, require_columns

POSTINGS = [
    {"id": "a", "title": "T", "company": {"display_name": "C"}, "location": {"display_name": "L"},
     "salary_min": 35000, "salary_max": "40000.5", "contract_type": None,
     "category": {"label": "IT"}, "description": "it's python\nand more",
     "created": "2024-01-05T09:00:00Z"},
    {"id": 7, "company": None, "salary_min": "abc", "salary_max": "12d", "description": None},
    {"id": None, "location": {}, "salary_min": "nan", "salary_max": True},
]


def flat(df):
    return {r["id"]: r.asDict() for r in flatten_postings(df).collect()}


@pytest.mark.parametrize("json_lines", [False, True])
def test_scan_postings_json(spark, tmp_path, json_lines):
    text = "\n".join(map(json.dumps, POSTINGS)) if json_lines else json.dumps(POSTINGS, indent=1)
    (tmp_path / "jobs.json").write_text(text)
    rows = flat(read_postings(spark, str(tmp_path), json_lines))
    assert list(rows["a"]) == list(RAW_POSTING_COLUMNS)
    assert rows["a"]["company_name"] == "C" and rows["a"]["category_label"] == "IT"
    assert (rows["a"]["salary_min"], rows["a"]["salary_max"]) == (35000.0, 40000.5)
    assert rows["a"]["contract_type"] is None
    assert rows["7"]["description"] is None, "JSON null stays NULL"
    assert rows[None]["description"] == "", "an absent key is empty text"
    assert rows["7"]["company_name"] is None and rows[None]["location_name"] is None
    assert rows["7"]["salary_min"] is None and rows["7"]["salary_max"] is None
    assert rows[None]["salary_min"] is None


def test_scan_several_dates(spark, tmp_path):
    for ds in ("2024-01-01", "2024-01-02"):
        (tmp_path / ds).mkdir()
        (tmp_path / ds / "jobs.json").write_text(json.dumps([{"id": ds}]))
    paths = [str(tmp_path / ds) for ds in ("2024-01-01", "2024-01-02")]
    assert set(flat(read_postings(spark, paths))) == {"2024-01-01", "2024-01-02"}
    assert set(flat(read_postings(spark, paths[1]))) == {"2024-01-02"}


def test_malformed_json_fails(spark, tmp_path):
    (tmp_path / "jobs.json").write_text('[{"id": "a"')
    with pytest.raises(Exception):
        read_postings(spark, str(tmp_path)).collect()


def test_texts_are_whole(spark):
    texts = {"l": "x" * 2095 + " rust", "q": "'" * 1500 + "y"}
    lines = [(json.dumps({"id": k, "description": v}),) for k, v in texts.items()]
    parsed = parse_postings(spark.createDataFrame(lines, "line string"), "line")
    assert {k: r["description"] for k, r in flat(parsed).items()} == texts


def test_page_envelopes(spark):
    pages = [json.dumps({"results": [{"id": "a", "description": None}, {"id": "b"}]}),
             json.dumps({"count": 0}), json.dumps({"results": []}), json.dumps({"results": None})]
    df = spark.createDataFrame([(p,) for p in pages], "page string")
    rows = flat(explode_pages(df, "page"))
    assert set(rows) == {"a", "b"}
    assert rows["a"]["description"] is None and rows["b"]["description"] == ""


def test_scan_survey_csv(spark, tmp_path):
    path = tmp_path / "survey.csv"
    path.write_text(
        "ResponseId,Country,DevType,ConvertedCompYearly,Extra\n"
        '1,"Line one\nline two","say ""hi"", twice",NA,x\n'
        "2,None,,50000,nan\n"
        "3,France,null ,N/A,y\n"
    )
    rows = {r["ResponseId"]: r for r in read_survey(spark, str(path)).collect()}
    assert rows["1"]["Country"] == "Line one\nline two"
    assert rows["1"]["DevType"] == 'say "hi", twice'
    assert rows["1"]["ConvertedCompYearly"] is None
    assert rows["2"]["Country"] is None and rows["2"]["DevType"] is None
    assert rows["2"]["ConvertedCompYearly"] == "50000" and rows["2"]["Extra"] is None
    assert rows["3"]["DevType"] == "null ", "only whole cells are missing-value tokens"


@pytest.mark.parametrize("multi_line", [True, False])
def test_survey_files_are_read_by_their_own_header(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("ResponseId,Country,ConvertedCompYearly\n1,France,50000\n2,,NA\n")
    (tmp_path / "b.csv").write_text("ResponseId,ConvertedCompYearly,Country,New\n3,60000,Spain,x\n")
    (tmp_path / "c.csv").write_text("ResponseId,Country,ConvertedCompYearly\n4,Italy,70000\n")
    rows = {r["ResponseId"]: r for r in read_survey(spark, str(tmp_path), multi_line).collect()}
    assert {k: (r["Country"], r["ConvertedCompYearly"], r["New"]) for k, r in rows.items()} == {
        "1": ("France", "50000", None), "2": (None, None, None), "3": ("Spain", "60000", "x"),
        "4": ("Italy", "70000", None),
    }


@pytest.mark.parametrize("row", ["3,Spain", "3,Spain,60000,y"])
def test_a_row_with_other_cells_fails(spark, tmp_path, row):
    (tmp_path / "a.csv").write_text(f"ResponseId,Country,ConvertedCompYearly\n1,France,50000\n{row}\n")
    with pytest.raises(Exception):
        require_columns(read_survey(spark, str(tmp_path), False)).select("ResponseId").collect()
    kept = read_survey(spark, str(tmp_path), False, on_bad="DROPMALFORMED")
    assert [r["ResponseId"] for r in kept.collect()] == ["1"]


def test_required_columns(spark):
    df = spark.createDataFrame([("1", "x")], "ResponseId string, Extra string")
    kept = require_columns(df)
    assert tuple(kept.columns) == SURVEY_COLUMNS
    assert [t for _, t in kept.dtypes] == ["string"] * 11
    assert kept.first().asDict()["ResponseId"] == "1" and kept.first()["Country"] is None


def test_generated_postings(spark):
    keys = spark.range(3000).withColumn("ds", F.lit("2024-03-01"))
    df = generate_postings(keys, "id", "ds")
    stats = df.agg(
        F.count_distinct("id"), F.min("salary_min"), F.max("salary_min"),
        F.min(F.col("salary_max") - F.col("salary_min")),
        F.max(F.col("salary_max") - F.col("salary_min")),
        F.count_distinct("title"), F.count_distinct("company"), F.count_distinct("location"),
        F.count("contract_type"), F.min(F.length("id")), F.max(F.length("id")),
    ).first()
    assert tuple(stats[:8]) == (3000, 35000.0, 90000.0, 5000.0, 25000.0, 10, 10, 5)
    assert 1800 < stats[8] < 2200 and stats[9] == stats[10] == 12
    import hashlib
    wanted = hashlib.md5(b"2024-03-010").hexdigest()[:12]
    assert df.filter(F.col("id") == wanted).first()["created"] == "2024-03-01T08:30:00Z"
    assert sorted(df.limit(50).collect()) == sorted(df.limit(50).collect())


def test_generated_survey(spark):
    rows = generate_survey(spark.range(1, 2001), "id").collect()
    used = [r["LanguageHaveWorkedWith"].split(";") for r in rows]
    assert {len(u) for u in used} == {2, 3, 4, 5}
    assert all(len(set(u)) == len(u) and set(u) <= set(LANGUAGES) for u in used)
    assert all(len(r["LanguageWantToWorkWith"].split(";")) == 3 for r in rows)
    assert {x for u in used for x in u} == set(LANGUAGES)
    pay = [int(r["ConvertedCompYearly"]) for r in rows]
    assert min(pay) >= 30_000 and max(pay) <= 180_000 and len(set(pay)) > 100
    assert tuple(rows[0].asDict()) == SURVEY_COLUMNS
