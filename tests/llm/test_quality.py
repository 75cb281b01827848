import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skillscope.llm.quality import _constant, _temperature, fit_quality, held_out, pooled, score, train, word_vectors

RNG = random.Random(5)
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "si", "to", "vu", "ba")]


def make(n):
    docs, labels = [], []
    for i in range(n):
        words = [RNG.choice(WORDS) for _ in range(RNG.randint(15, 60))]
        good = i % 3 > 0
        docs.append((i, " ".join(words) if good else "!! ".join(w.upper() for w in words)))
        labels.append((i, int(good)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = make(600)
    docs += [(9001, None), (9002, ""), (9003, " \n"), (None, "ka ra"), (9004, "x" * 50_000)]
    labels += [(9001, None), (None, 1), (77, 0), (77, 1)]
    return (spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, quality double"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_learns_the_unseen_third_and_not_from_it(spark, tables):
    docs, labels = tables
    scored = score(docs, fit_quality(docs, labels))
    assert scored.columns == [*docs.columns, "score"] and scored.count() == docs.count()
    rows = scored.withColumn("held", held_out(F.col("doc_id"))).where("doc_id < 9000 AND doc_id <> 77").collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    unseen = [r for r in rows if r["held"]]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in unseen]) > 0.97
    # Labels of the held-out third do not change a score.
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in score(docs.repartition(7), fit_quality(docs.repartition(5), turned)).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], abs=1e-9) for r in rows)


def test_permuted_labels_teach_nothing(spark, tables):
    """With labels dealt out at random the score must not find the real ones."""
    docs, labels = tables
    known = sorted((r["doc_id"], r["quality"]) for r in labels.where("doc_id < 9000 AND doc_id <> 77 AND quality IS NOT NULL").collect())
    values = [q for _, q in known]
    random.Random(8).shuffle(values)
    random_labels = spark.createDataFrame([(i, q) for (i, _), q in zip(known, values, strict=True)], "doc_id long, quality int")
    rows = score(docs, fit_quality(docs, random_labels)).where(held_out(F.col("doc_id")) & (F.col("doc_id") < 9000)).collect()
    right = np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in rows])
    assert right < 0.9


def test_one_label_or_none(spark, tables):
    docs, labels = tables
    for some, value in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 0.99)):
        got = {round(r["score"], 6) for r in score(docs, fit_quality(docs, some)).collect()}
        assert got == {value}
    clash = docs.limit(3).withColumn("score", F.lit("old"))
    assert dict(score(clash, fit_quality(docs, labels.limit(0))).dtypes)["score"] == "double"
    model = fit_quality(docs.limit(0), labels)
    assert score(docs.limit(0), model).count() == 0


def test_pooling_depends_on_the_text_alone(spark, tables):
    docs, _ = tables
    vectors = word_vectors(docs)
    assert np.array_equal(vectors, word_vectors(docs.repartition(9)))
    texts = ["ka ra ka", "", None, "LO!! si"]
    together = pooled(pa.array(texts, pa.large_string()), vectors)
    alone = np.vstack([pooled(pa.array([t], pa.large_string()), vectors) for t in texts])
    assert np.array_equal(together, alone) and not together[1:3].any()


def test_separable_calibration_keeps_a_finite_temperature():
    y = np.array([0.0, 1.0] * 50)
    assert 0.5 < _temperature((2 * y - 1) * 4, y) < 5
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 96))
    label = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    net = train(x, label, np.arange(400) % 5 == 0)
    assert 0.6 < ((net.scores(x) >= 0.5) == label).mean() and _constant(0.3).scores(x)[0] == pytest.approx(0.3)
