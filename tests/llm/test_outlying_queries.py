"""The neighbour search finds what is near for queries that lie elsewhere than most rows, too."""

import numpy as np

from evenkeel.llm.neighbours import nearest_neighbours, squared


def test_recall_of_queries_between_the_clusters(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(30, 16))
    vectors = centres[draw.integers(0, 30, 6000)] + draw.normal(size=(6000, 16)) * 0.05
    between = (centres[draw.integers(0, 30, 60)] + centres[draw.integers(0, 30, 60)]) / 2
    vectors[::100] = between + draw.normal(size=(60, 16)) * 0.05
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = nearest_neighbours(table).toPandas()
    asked = np.arange(0, len(vectors), 100)
    away = squared(vectors[asked], vectors)
    away[np.arange(len(asked)), asked] = np.inf
    exact = np.argsort(away, axis=1)[:, :10]
    own = found.groupby("query_id")["vec_id"].agg(set)
    assert np.mean([len(own[q] & set(e.tolist())) / 10 for q, e in zip(asked.tolist(), exact)]) >= 0.9
