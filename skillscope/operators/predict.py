"""Pay prediction from skill flags with boosted trees.

Flags are 0, 1 or unknown, so postings with the same flags are one point to a tree. Postings are combined
per combination of flags before training, and a combination is scored once: neither grows with the postings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillscope.defaults import (
    LEARNING_RATE, LEAVES, MIN_LABELLED, MIN_LEAF_ROWS, MODEL_SEED, SKILL_RULES, TREES, Rule,
)
from skillscope.operators.boosting import STATES, FlagModel, fit_boosted
from skillscope.schemas import PREDICTION_SCHEMA
from skillscope.session import materialise
from skillscope.sources.tables import constant_rows

TEST_SHARE = 0.2


def in_holdout(id_col: Column, share: float = TEST_SHARE, seed: int = MODEL_SEED) -> Column:
    """A split that depends on the id alone: no sort, no shuffle, the same on every retry."""
    if not 0 < share < 1:
        raise ValueError(f"share must lie between 0 and 1, not {share!r}")
    limit = format(int(share * 2**32), "08x")
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), id_col)), 1, 8) < F.lit(limit)


def holdout_split(df: DataFrame, id_col: str = "job_id", share: float = TEST_SHARE) -> DataFrame:
    return df.withColumn("is_test", in_holdout(F.col(id_col), share))


def flag_vector(rules: Sequence[Rule]) -> Column:
    """All flags as one text, a character each: 0, 1 or unknown."""
    return F.concat(*[F.coalesce(F.col(r.column).cast("int").cast("string"), F.lit(STATES[2])) for r in rules])


def labelled_postings(enriched: DataFrame, rules: Sequence[Rule] = SKILL_RULES) -> DataFrame:
    """Postings with pay, reduced to what the model reads, with their side of the split."""
    paid = enriched.filter(F.col("salary_gbp").isNotNull())
    narrow = paid.select("job_id", "job_title", "salary_gbp", flag_vector(rules).alias("flags"))
    return holdout_split(narrow)


def fit_salary_model(
    labelled: DataFrame,
    rules: Sequence[Rule] = SKILL_RULES,
    trees: int = TREES,
    min_rows: int = MIN_LABELLED,
    min_leaf_rows: int = MIN_LEAF_ROWS,
    leaves: int = LEAVES,
) -> tuple[FlagModel | None, DataFrame]:
    """The model (``None`` below ``min_rows``) and the combinations of flags that occur.

    One scan of the postings; everything after works on the combinations, of which there are at most as
    many as postings. No leaf of a tree has fewer postings than ``min_leaf_rows``, so a tree over
    fewer than twice as many is its root.
    """
    vectors = materialise(
        labelled.groupBy("flags").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.col("is_test")).cast("double").alias("weight"),
            F.avg(F.when(~F.col("is_test"), F.col("salary_gbp"))).alias("label"),
        ),
        "flag-vectors",
    )
    rows, weight = vectors.agg(F.sum("rows"), F.sum("weight")).first()
    if (rows or 0) < min_rows or not weight:
        return None, vectors
    names = tuple(r.column for r in rules)
    train = vectors.filter(F.col("weight") > 0)
    return fit_boosted(train, names, trees, leaves, LEARNING_RATE, min_leaf_rows), vectors


def salary_holdout(
    labelled: DataFrame,
    rules: Sequence[Rule] = SKILL_RULES,
    trees: int = TREES,
    min_rows: int = MIN_LABELLED,
) -> DataFrame:
    """Actual and predicted pay of the held-out postings; empty below ``min_rows``."""
    return score_holdout(labelled, *fit_salary_model(labelled, rules, trees, min_rows), rules)


def score_holdout(
    labelled: DataFrame,
    model: FlagModel | None,
    vectors: DataFrame,
    rules: Sequence[Rule] = SKILL_RULES,
) -> DataFrame:
    """``salary_holdout`` for a model that is already there. Each combination is scored once."""
    if model is None:
        return labelled.sparkSession.createDataFrame([], PREDICTION_SCHEMA)
    return labelled.filter("is_test").join(model.score(vectors), "flags").select(
        "job_id",
        "job_title",
        F.col("salary_gbp").alias("actual_salary_gbp"),
        F.col("prediction").alias("predicted_salary_gbp"),
    )


def regression_metrics(
    df: DataFrame, actual: str = "actual_salary_gbp", predicted: str = "predicted_salary_gbp"
) -> DataFrame:
    """Mean absolute error and coefficient of determination, NULL where pay does not vary."""
    y, p = F.col(actual), F.col(predicted)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sum((y - p) * (y - p)).alias("_sse"),
        F.regr_syy(y, y).alias("_sst"),
    ).select(
        "n", "mae", (F.lit(1.0) - F.col("_sse") / F.nullif("_sst", F.lit(0.0))).alias("r2")
    )


def feature_importance(
    model: FlagModel,
    spark: SparkSession,
    rules: Sequence[Rule] = SKILL_RULES,
    top: int = 5,
) -> DataFrame:
    """(feature, splits, gain) of the ``top`` flags by the number of splits on them; equals by name."""
    names = constant_rows(spark, ("feature",), [(r.column,) for r in rules])
    counts = model.split_nodes(spark).groupBy("feature").agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
    table = names.join(counts, "feature", "left").fillna(0, ["splits", "gain"])
    return table.orderBy(F.desc("splits"), F.asc("feature")).limit(top)
