import random

import pytest
from pyspark.sql import functions as F

from skillscope.defaults import SKILL_RULES
from skillscope.operators import boosting
from skillscope.operators.predict import (
    feature_importance, fit_salary_model, flag_vector, holdout_split, in_holdout, labelled_postings,
    regression_metrics, salary_holdout,
)
from skillscope.operators.tagging import flag_columns
from skillscope.schemas import PREDICTION_SCHEMA

FLAGS = flag_columns(SKILL_RULES)
WORTH = {"skill_rust": 30_000, "skill_ml": 20_000, "skill_go": 5_000}


def postings(spark, n, seed=0, nulls=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        flags = {f: int(rng.random() < 0.3) for f in FLAGS}
        pay = 40_000 + sum(WORTH.get(f, 0) * v for f, v in flags.items()) + rng.gauss(0, 1000)
        values = [None] * len(FLAGS) if i < nulls else [flags[f] for f in FLAGS]
        rows.append((f"job{i}", f"T{i % 3}", pay, *values))
    schema = "job_id string, job_title string, salary_gbp double, " + ", ".join(
        f"{f} int" for f in FLAGS)
    return spark.createDataFrame(rows, schema)


def test_split(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("job_id"))
    split = holdout_split(ids)
    again = holdout_split(ids.repartition(7))
    share = split.filter("is_test").count() / 20_000
    assert 0.19 < share < 0.21
    assert split.join(again, ["job_id", "is_test"]).count() == 20_000
    assert holdout_split(ids, share=0.5).filter("is_test").count() > 9_500


def test_flag_vector(spark):
    df = spark.createDataFrame([(1, 0, 1), (0, 1, None)], "a int, b int, c int")
    from skillscope.defaults import Rule
    rules = [Rule(c, c, ("%",)) for c in "abc"]
    assert [r["v"] for r in df.select(flag_vector(rules).alias("v")).collect()] == ["101", "01-"]


def test_model_gate(spark):
    few = labelled_postings(postings(spark, 19))
    out = salary_holdout(few, trees=1)
    assert out.count() == 0 and out.schema == PREDICTION_SCHEMA
    unpaid = postings(spark, 40).withColumn("salary_gbp", F.lit(None).cast("double"))
    assert salary_holdout(labelled_postings(unpaid), trees=1).count() == 0
    enough = labelled_postings(postings(spark, 20))
    out = salary_holdout(enough, trees=1)
    assert out.count() == enough.filter("is_test").count() > 0
    assert out.select("predicted_salary_gbp").distinct().count() == 1, "too few rows for a split"


def test_model_learns_and_scores_the_holdout_only(spark):
    labelled = labelled_postings(postings(spark, 1500, nulls=30)).cache()
    out = salary_holdout(labelled, trees=60).cache()
    held = labelled.filter("is_test")
    assert out.count() == held.count(), "postings with unknown flags are scored too"
    assert out.join(held, "job_id", "left_anti").count() == 0
    metrics = regression_metrics(out).first()
    assert metrics["r2"] > 0.85 and metrics["mae"] < 4500
    model, _ = fit_salary_model(labelled, trees=10)
    top = feature_importance(model, spark).collect()
    assert len(top) == 5 and top[0]["splits"] >= top[-1]["splits"] > 0
    nodes = model.split_nodes(spark).collect()
    every = feature_importance(model, spark, top=len(FLAGS)).collect()
    assert sum(r["splits"] for r in every) == len(nodes) == sum(f >= 0 for t in model.trees for f in t.flag)
    assert max(every, key=lambda r: r["gain"])["feature"] == "skill_rust"


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 3.0)],
                               "actual_salary_gbp double, predicted_salary_gbp double")
    row = regression_metrics(df).first()
    assert (row["n"], row["mae"]) == (3, pytest.approx(4 / 3))
    assert row["r2"] == pytest.approx(1 - 10 / 14)
    same = df.withColumn("actual_salary_gbp", F.lit(1.0))
    assert regression_metrics(same).first()["r2"] is None


def brute_force(rows, n_flags, trees, leaves, rate, least):
    """Leaf by leaf over single rows: (list of split lists (depth path, flag), predictions)."""
    sides = (((0, 2), (1,)), ((0,), (1, 2)), ((0, 1), (2,)))
    states = [["01-".index(c) for c in key] for key, _ in rows]
    made = [sum(y for _, y in rows) / len(rows)] * len(rows)
    splits = []
    for _ in range(trees):
        rest = [y - p for (_, y), p in zip(rows, made, strict=True)]

        def score(part):
            return sum(rest[i] for i in part) ** 2 / len(part)

        def best(part):
            found = None
            for flag in range(n_flags):
                for left, right in sides:
                    a = [i for i in part if states[i][flag] in left]
                    b = [i for i in part if states[i][flag] in right]
                    if min(len(a), len(b)) >= least:
                        gain = score(a) + score(b) - score(part)
                        if found is None or gain > found[0] * (1 + 1e-9):
                            found = (gain, flag, a, b)
            return found

        parts = [(list(range(len(rows))), best(range(len(rows))))]
        while len(parts) < leaves:
            ready = [p for p in parts if p[1] and p[1][0] > 1e-3]
            if not ready:
                break
            most = max(p[1][0] for p in ready)
            part = next(p for p in ready if p[1][0] >= most * (1 - 1e-9))
            _, flag, a, b = part[1]
            splits.append(flag)
            at = parts.index(part)
            parts[at:at + 1] = [(a, best(a)), (b, best(b))]
        for part, _ in parts:
            step = rate * sum(rest[i] for i in part) / len(part)
            for i in part:
                made[i] += step
    return splits, made


@pytest.mark.parametrize(("pair_flags", "small", "per_task"), [
    (24, 4096, 10**5), (24, 0, 10**5), (0, 0, 10**5), (24, 60, 50), (0, 30, 50)])
def test_trees_against_brute_force(spark, monkeypatch, pair_flags, small, per_task):
    """The same splits and predictions, with unknown flags, however many levels a job serves and tasks it has."""
    monkeypatch.setattr(boosting, "PAIR_FLAGS", pair_flags)
    monkeypatch.setattr(boosting, "SMALL", small)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", per_task)
    rng = random.Random(6)
    rows = []
    for _ in range(700):
        key = "".join(rng.choice("0001-") if i < 3 else rng.choice("01") for i in range(6))
        pay = 30_000 + 9000 * (key[0] == "1") + 7000 * (key[1] == "-") - 4000 * (key[2] != "0") * (key[4] == "1") + rng.gauss(0, 900)
        rows.append((key, pay))
    df = spark.createDataFrame(rows, "flags string, y double").groupBy("flags").agg(
        F.count("y").cast("double").alias("weight"), F.avg("y").alias("label"))
    model = boosting.fit_boosted(df, tuple("abcdef"), 4, 9, 0.3, 15)
    splits, made = brute_force(rows, 6, 4, 9, 0.3, 15)
    assert sorted(r["feature"] for r in model.split_nodes(spark).collect()) == sorted("abcdef"[f] for f in splits)
    scored = {r["flags"]: r["prediction"] for r in model.score(df).collect()}
    assert all(scored[key] == pytest.approx(p, rel=1e-9) for (key, _), p in zip(rows, made, strict=True))


def test_stored_predictions_change_nothing(spark, monkeypatch):
    labelled = labelled_postings(postings(spark, 400, nulls=30)).cache()
    found = []
    for refresh in (2, 50):
        monkeypatch.setattr(boosting, "REFRESH", refresh)
        model, vectors = fit_salary_model(labelled, trees=7)
        found.append({r["flags"]: r["prediction"] for r in model.score(vectors).collect()})
    assert found[0] == pytest.approx(found[1])


@pytest.mark.parametrize("share", [0, 1, 1.5, -0.1])
def test_share_outside_its_range(share):
    with pytest.raises(ValueError):
        in_holdout(F.lit("a"), share)
