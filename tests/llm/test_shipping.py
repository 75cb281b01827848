import pyarrow as pa

from skillscope.llm import shipping
from skillscope.llm.minhash import near_duplicates


def largest_batch(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"mb": [batch.nbytes >> 20]})

    texts = spark.range(24).coalesce(1).selectExpr("id", "repeat('x', 1 << 20) AS text")
    return max(r.mb for r in texts.mapInArrow(sizes, "mb long").collect())


def test_texts_travel_in_batches_of_bounded_size(spark):
    spark.conf.unset(shipping._LIMIT)
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six")], "doc_id long, text string")
    try:
        assert sorted(r.component_id for r in near_duplicates(docs).collect()) == [1, 1]
        assert largest_batch(spark) <= 10
    finally:
        spark.conf.unset(shipping._LIMIT)


def test_a_size_named_by_the_session_is_kept(spark):
    spark.conf.set(shipping._LIMIT, str(16 << 20))
    try:
        shipping.bound_batches(spark)
        assert spark.conf.get(shipping._LIMIT) == str(16 << 20)
        assert largest_batch(spark) > 10
    finally:
        spark.conf.unset(shipping._LIMIT)
