"""Ids that a third of all rows share, samples that stay small whatever the partitions, caches that forget, recall."""

import importlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evenkeel.llm import jaccard, tokens
from evenkeel.llm.common import at_most, hashed_place
from evenkeel.llm.expected import EXPECTED
from evenkeel.llm.neighbours import nearest_neighbours
from evenkeel.llm.queries import QUERIES
from evenkeel.llm.tokens import WordIds, packed_texts
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", ["op8_jaccard", "op10_substring"])
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table_against_sql(spark, name, sf):
    path = f"/root/testdata/sf{sf}"
    assert differences(QUERIES[name](spark, path), connect(path), EXPECTED[name]) == []


@pytest.mark.parametrize(("module", "operator"), [("mixing", "mixed_sizes"), ("sharding", "shard_rows"), ("packing", "pack")])
def test_a_third_of_the_rows_without_an_id_spreads_over_the_buckets(spark, monkeypatch, module, operator):
    own = importlib.import_module(f"evenkeel.llm.{module}")
    largest = []

    def spread(rows, group, place, ties, value, buckets, name):
        cut = rows.withColumn("_cut", F.floor(F.col(place) * buckets)).groupBy(*group, "_cut").count()
        sizes = [r["count"] for r in cut.collect()]
        if len(sizes) > 20:  # four times the median, or about the root of all rows where the groups are small
            largest.append(max(sizes) / max(4 * np.median(sizes), 2 * sum(sizes) ** 0.5))
        return total(rows, group, place, ties, value, buckets, name)

    total = own.running_total
    monkeypatch.setattr(own, "running_total", spread)
    docs = spark.range(6000).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", "concat('text number ', id) as text", "'one' as source"
    )
    assert getattr(own, operator)(docs).count() == 6000
    assert largest and max(largest) <= 1


def test_a_sample_is_chosen_before_the_rows_leave_their_tasks(spark):
    rows = spark.range(0, 100_000, 1, 200)
    found = at_most(rows, hashed_place("id"), 100_000, 5_000)
    place = hashed_place("id")
    assert 5_000 <= found.count() < 6_000
    first = lambda df: [r.id for r in df.orderBy(place, "id").limit(5_000).collect()]
    assert first(found) == first(rows)
    assert at_most(rows, place, 100_000, 100_000).count() == 100_000


def test_words_forgotten_and_met_again_have_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    small, draw = WordIds(tokens.TOKENIZER, False), np.random.default_rng(3)
    for _ in range(30):
        texts = [" ".join(f"Wörd{i} plain{i}" for i in draw.zipf(1.3, 30) % 200).encode() for _ in range(3)]
        fresh = WordIds(tokens.TOKENIZER, False)
        assert packed_texts(texts, small) == packed_texts(texts, fresh)
    assert len(small) + len(small.older) < 200


def test_fragments_tell_apart_what_the_sent_bits_do_not(monkeypatch):
    """The fragment comes from the bits of a hash that are not sent with it."""
    low = np.uint64(0x123456789ABC)
    hashes = np.sort((np.arange(64, dtype=np.uint64) << np.uint64(58)) | low)  # equal in the 48 bits that are sent
    monkeypatch.setattr(jaccard, "shingle_set", lambda text, width: hashes)
    (out,) = jaccard._packed([pd.DataFrame({"body": [b"a b c d"]})], 4, 64)
    assert sorted(out["frag"]) == list(range(64)) and len(set(out["hashes"])) == 1


def test_vectors_of_other_lengths_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0]), (100, [1.0, 1.0]), (3, []), (4, [1.0, 1.0, 1.0])]
    found = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.query_id, r.vec_id) for r in found} == {(0, 100), (0, 1), (100, 0), (100, 1)}
    table = spark.sql("select 0L as vec_id, array(1.0) as embedding, 1 as list, 2 as part, 3 as slot, 'x' as vector, 5 as `a.b`")
    assert nearest_neighbours(table).count() == 0


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_against_all_distances(spark, sf):
    path = f"/root/testdata/sf{sf}"
    found = QUERIES["op9_neighbours"](spark, path).toPandas()
    table = pd.read_parquet(f"{path}/embeddings.parquet")
    ids, vectors = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), float)
    hits = asked = 0
    for query in np.flatnonzero(ids % 100 == 0):
        distance = ((vectors - vectors[query]) ** 2).sum(1)
        distance[query] = np.inf
        best = ids[np.lexsort((ids, distance))[:10]]
        hits += len(set(best.tolist()) & set(found.vec_id[found.query_id == ids[query]]))
        asked += len(best)
    assert hits / asked >= 0.95
