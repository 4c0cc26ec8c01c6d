"""The bounded sample that toxicity is fitted on."""

from pyspark.sql import functions as F

from evenkeel.llm.toxicity import held_out, training_rows


def test_a_text_that_does_not_fit_does_not_end_the_sample(spark):
    ids = [r.doc_id for r in spark.range(60).toDF("doc_id").where(~held_out()).orderBy(F.xxhash64("doc_id", F.lit("toxic"))).collect()]
    size = {i: 10 for i in ids} | {ids[0]: 1000, ids[3]: 70}  # the first never fits, the fourth no more
    docs = spark.createDataFrame([(i, "x" * n) for i, n in size.items()] + [(ids[1], "y" * 10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")

    def sample(most_rows, most_bytes):
        return sorted((ids.index(r.doc_id), len(r.text)) for r in training_rows(docs, labels, most_rows, most_bytes).collect())

    assert sample(100, 95) == [(1, 10), (1, 10), (2, 10), *[(n, 10) for n in range(4, 10)]]
    assert sample(2, 95) == [(1, 10), (1, 10)] and sample(1, 95) == [(1, 10)]
    assert sample(4, 100) == [(1, 10), (1, 10), (2, 10), (3, 70)]
    assert sample(3, 15) == [(1, 10)] and sample(3, 5) == []
