"""Repeated rows and many vectors of one vec_id in the neighbour search."""

import numpy as np
import pandas as pd

from evenkeel.llm.neighbours import _scan, nearest_neighbours


def test_a_part_returns_as_many_different_ids_as_asked():
    ids = np.repeat(np.arange(1, 31), [25] + [2] * 29)
    held = pd.DataFrame({"list": 0, "vec_id": ids, "vector": [[float(i), 1.0] for i in ids]})
    wanted = pd.DataFrame({"query_id": [0], "query": [[0.5, 1.0]], "lists": [[0]]})
    found = _scan(held.sample(frac=1, random_state=3), wanted, 10)
    assert list(zip(found.vec_id, found.score)) == [(i, i - 0.5) for i in range(1, 11)]


def test_one_id_with_most_rows_costs_no_neighbour(spark):
    draw = np.random.default_rng(5)
    plain = {i: draw.normal(size=4) for i in range(300)}
    # vec_id 7 lies all around query 0 and fills its lists; every row is given twice.
    rows = list(plain.items()) + [(7, plain[0] + draw.normal(size=4) * 0.01) for _ in range(2000)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows * 2], "vec_id long, embedding array<double>")
    found = nearest_neighbours(table, part_rows=64).toPandas().sort_values(["query_id", "rank"])
    hits = 0
    for query in (0, 100, 200):
        best = {}
        for i, v in rows:
            if i != query:
                best[i] = min(best.get(i, np.inf), float(np.sqrt(((v - plain[query]) ** 2).sum())))
        expected = sorted(best, key=best.get)[:10]
        own = found[found.query_id == query]
        assert list(own["rank"]) == list(range(1, 11)) and own.vec_id.is_unique
        assert np.allclose(own.score, [best[i] for i in own.vec_id])
        hits += len(set(expected) & set(own.vec_id))
        if query == 0:
            assert own.vec_id.iloc[0] == 7
    assert hits >= 24
