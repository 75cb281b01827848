"""Properties of physical plans that large inputs depend on."""

import os
import re

import pytest

from skillscope.plans.queries import REGISTRY as QUERIES

SF_DIR = "/root/testdata/sf0.001"
PYTHON_NODES = ("EvalPython", "InPandas", "InArrow", "PythonUDF")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Without the initial plan; for queries that hold no subquery plans."""
    return executed_plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def without_broadcast(spark):
    """Joins as they are when neither side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["skill_demand", "uk_by_skill", "index_docs"])
def test_texts_are_read_once_and_not_shuffled(without_broadcast, name):
    plan = final_plan(QUERIES[name](without_broadcast, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[[^]]*\btext#", plan)) == 1
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text" not in line
    assert "SortMergeJoin" in plan
    below_join = plan[plan.index("SortMergeJoin"):]
    exchange = below_join[below_join.index("Exchange hashpartitioning(doc_id"):].splitlines()[1]
    assert "Project" in exchange and "skill_red" in exchange and "text#" not in exchange


@pytest.mark.parametrize("name", ["enriched_jobs", "masked_benchmark", "salary_comparison"])
def test_no_cross_join(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_python_outside_the_piecewise_fit(spark):
    for name, query in QUERIES.items():
        if name in ("salary_holdout", "feature_importance", "demand_forecast_piecewise"):
            continue
        plan = query(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
        assert not any(node in plan for node in PYTHON_NODES), name


def test_scans_are_pruned(spark):
    plan = final_plan(QUERIES["skill_demand"](spark, SF_DIR))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)", plan):
        assert "n_chars" not in schema and "o_totalprice" not in schema
    plan = executed_plan(QUERIES["benchmark_pivot"](spark, SF_DIR))
    assert "l_shipdate" not in plan and "p_retailprice" not in plan
