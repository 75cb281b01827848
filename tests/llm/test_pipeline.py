import os

import pytest
from brute import components

import __spark_entry__ as entry_point
import corpus_pipeline
from compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")
LLM = sorted(n for n in entry_point.queries() if n.startswith("op"))


@pytest.mark.parametrize("name", sorted(n for n in entry_point.oracle_sql() if n.startswith("op")))
def test_query_equals_sql(spark, name):
    assert differences(entry_point.queries()[name](spark, SF_DIR), connect(SF_DIR), entry_point.oracle_sql()[name]) == []


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM) == list(range(1, 14))


def test_stages(spark):
    """Each stage on what the one before kept; its decisions hold, and nothing else is lost."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, columns = [docs], docs.columns
    scratch = corpus_pipeline.Scratch(spark, "t")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(scratch.keep(stage(spark, kept[-1], SF_DIR), str(i)))
    good, single, untested, hidden, mixed = kept[1:]
    assert all(d.columns == columns for d in kept[:-1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in good.collect()}
    wrong = [d for d, q in labels.items() if (d in ids) != bool(q)]
    assert len(wrong) <= 0.05 * len(labels)
    want = components([(r["doc_id"], r["text"]) for r in good.collect()], 5, 80)
    assert {r["doc_id"] for r in single.collect()} == {d for d, (_, c, _) in want.items() if c == d}
    items = [r["text"].lower() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"].lower() for r in single.collect()}
    assert {r["doc_id"] for r in untested.collect()} == {d for d, t in before.items() if not any(i in t for i in items)}
    assert hidden.count() == untested.count() and not hidden.where("text LIKE '%@mail%'").count()
    rows = mixed.collect()
    assert all(1 <= r["copies"] <= 3 and r["taken"] == r["copies"] * len(r["text"].split()) for r in rows)


def test_strange_rows(spark, tmp_path):
    """Null ids, texts, languages and sources, and repeated rows, go through all stages."""
    words = " ".join(f"w{i}" for i in range(40)) + "."
    rows = [(1, words, "en", "a", 9), (1, words, "en", "a", 9), (2, words + " more", None, None, None), (None, "x y z " + words[:50], "en", "a", 1),
            (3, None, None, "b", None), (4, "", "en", None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} <= {1, None} and [r["doc_id"] for r in out].count(1) <= 1
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/e/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{name}.parquet").write.parquet(f"{tmp_path}/e/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0
