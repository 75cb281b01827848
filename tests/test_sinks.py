import json
import os

import pytest
from pyspark.sql import functions as F

from generate import generate_postings, generate_survey
from skillscope.schemas import FORECAST_SCHEMA, PREDICTION_SCHEMA, SURVEY_COLUMNS
from skillscope.session import materialise, scratch_dir
from skillscope.sinks import (
    documents, index_tables, land_json, open_table, replace_table, replace_view, write_empty, write_parquet,
    write_survey_csv,
)
from skillscope.sources.postings import flatten_postings, read_postings
from skillscope.sources.survey import read_survey, require_columns
from skillscope.sources.tables import constant_rows, read_parquet


def test_tables_and_views_are_replaced(spark):
    assert replace_table(spark.range(5).toDF("a"), "kept").count() == 5
    assert replace_table(spark.range(2).toDF("b"), "kept").columns == ["b"]
    assert spark.table("kept").count() == 2
    replace_view(spark.range(3), "seen")
    replace_view(spark.range(4), "seen")
    assert spark.table("seen").count() == 4
    spark.sql("DROP TABLE kept")


def test_table_files_outlive_the_catalog(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark.range(5).toDF("a"), "dated", root)
    spark.sql("DROP TABLE dated")
    assert os.listdir(f"{root}/dated"), "only the catalog entry is gone, as after a session"
    assert replace_table(spark.range(2).toDF("b"), "dated", root).columns == ["b"]
    assert open_table(spark, "dated", root).count() == 2
    assert replace_table(spark.range(3).toDF("c"), "dated", root).count() == 3
    spark.sql("DROP TABLE dated")


def test_parquet_round_trip_and_empty_results(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("a", "t", 1.0, None)], PREDICTION_SCHEMA)
    write_parquet(df, path)
    assert read_parquet(spark, path, PREDICTION_SCHEMA).collect() == df.collect()
    for schema in (PREDICTION_SCHEMA, FORECAST_SCHEMA):
        write_empty(spark, schema, path)
        stored = read_parquet(spark, path, schema)
        assert stored.count() == 0 and stored.schema == schema


def test_landing(spark, tmp_path):
    root = str(tmp_path)
    jobs = generate_postings(spark.range(30).withColumn("ds", F.lit("2024-05-06")), "id", "ds")
    path = land_json(jobs, root, "2024-05-06")
    assert path == f"{root}/2024-05-06"
    flat = flatten_postings(read_postings(spark, path, json_lines=True))
    assert flat.count() == 30 and flat.filter("contract_type IS NULL").count() > 0
    assert flat.filter("company_name IS NULL OR salary_min IS NULL").count() == 0
    land_json(jobs.limit(3), root, "2024-05-06", replace=False)
    assert read_postings(spark, path, json_lines=True).count() == 30, "landed before"
    land_json(jobs.limit(3), root, "2024-05-06")
    assert read_postings(spark, path, json_lines=True).count() == 3
    land_json(spark.sql("SELECT 'a' AS id, CAST(NULL AS STRING) AS description"), root, "n")
    kept = flatten_postings(read_postings(spark, f"{root}/n", json_lines=True)).first()
    assert kept["description"] is None, "a NULL lands as JSON null, not as an absent key"


def test_survey_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "survey")
    rows = generate_survey(spark.range(40), "id").withColumn("Country", F.lit('a "b",\nc'))
    write_survey_csv(rows, path)
    back = require_columns(read_survey(spark, path))
    assert tuple(back.columns) == SURVEY_COLUMNS
    assert sorted(back.collect()) == sorted(rows.collect())
    write_survey_csv(rows.limit(1), path)
    assert read_survey(spark, path).count() == 40, "written only if absent"


def test_documents_keep_nulls(spark):
    df = spark.createDataFrame([("a", None)], "skill string, n int")
    row = documents(df, "i").first()
    assert row["index"] == "i" and json.loads(row["document"]) == {"skill": "a", "n": None}


def test_index_tables(spark, tmp_path):
    replace_table(spark.range(3).toDF("n"), "present")
    root = str(tmp_path)
    assert index_tables(spark, {"one": "present", "two": "no_such_table"}, root) == ["one"]
    assert index_tables(spark, {"one": "present"}, root) == ["one"]
    lines = [json.loads(r[0]) for r in spark.read.text(f"{root}/one").collect()]
    assert sorted(x["n"] for x in lines) == [0, 1, 2], "replaced, not appended"
    assert not os.path.exists(f"{root}/two")
    assert os.listdir(root) == ["one"], "nothing is left of the swap"
    index_tables(spark, {"one": "present"}, f"{root}/rows", fmt="parquet")
    assert spark.read.parquet(f"{root}/rows/one").count() == 3
    spark.sql("DROP TABLE present")


def test_materialise_uses_the_shared_folder(spark):
    df = materialise(spark.range(4).toDF("n"), "numbers")
    assert df.count() == 4 and "numbers-" in df.inputFiles()[0]
    assert scratch_dir(spark) == scratch_dir(spark)


def test_constant_rows(spark):
    rows = [("a", 1, 0.5), ("b", 2, None), ("c", 3, 1.5)]
    assert [tuple(r) for r in constant_rows(spark, ("x", "y", "z"), rows).collect()] == rows


def test_failed_index_keeps_the_old_one(spark, tmp_path):
    replace_table(spark.range(3).toDF("n"), "present")
    root = str(tmp_path)
    index_tables(spark, {"one": "present"}, root)
    spark.sql("SELECT raise_error('broken') AS n").createOrReplaceTempView("broken")
    with pytest.raises(Exception):
        index_tables(spark, {"one": "broken"}, root)
    assert spark.read.text(f"{root}/one").count() == 3
    spark.catalog.dropTempView("broken")
    spark.sql("DROP TABLE present")


def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "tables")
    old = spark.range(5).withColumn("v", F.lit("old"))
    replace_table(old, "versioned", root)

    @F.udf("string")
    def fails(i):
        if i == 3:
            raise ValueError("the writer dies")
        return "new"

    with pytest.raises(Exception, match="the writer dies"):
        replace_table(spark.range(0, 5, 1, 3).withColumn("v", fails("id")), "versioned", root)
    assert {r["v"] for r in open_table(spark, "versioned", root).collect()} == {"old"}
    assert {r["v"] for r in spark.table("versioned").collect()} == {"old"}


def test_versions(spark, tmp_path):
    root, folder = str(tmp_path), tmp_path / "counted"
    with pytest.raises(FileNotFoundError):
        open_table(spark, "counted", root)
    first = replace_table(spark.range(3), "counted", root)
    held = open_table(spark, "counted", root)
    assert first.count() == 3
    # A table may be made of its own older version, with other columns.
    replace_table(spark.table("counted").selectExpr("id + 1 AS id", "'x' AS more"), "counted", root)
    assert held.count() == 3, "a reader of the version before can end"
    assert open_table(spark, "counted", root).columns == ["id", "more"] == spark.table("counted").columns
    replace_table(spark.range(7), "counted", root)
    replace_table(spark.range(8), "counted", root)
    assert open_table(spark, "counted", root).count() == 8
    assert len([p for p in folder.iterdir() if p.is_dir()]) == 2
    # A session whose catalog does not know the table finds it by the manifest.
    spark.sql("DROP TABLE counted")
    assert open_table(spark, "counted", root).count() == 8
