"""Ranked lexical search against plain code, whole tables against SQL, packing and pruning of postings."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from evenkeel.llm import lexical
from evenkeel.llm.expected import EXPECTED
from evenkeel.llm.lexical import build_index, pack, search, search_shard, unpack
from evenkeel.llm.queries import QUERIES
from tests.oracle import connect, differences

TERM = re.compile(lexical.TERM_PATTERN)


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top=50):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    found = [(doc_id, Counter(words(text))) for doc_id, text in docs if words(text)]
    n_docs, n_terms = len(found), sum(sum(tf.values()) for _, tf in found)
    df = Counter(t for _, tf in found for t in tf)
    merged = {}
    for item_id, text in items:
        merged.setdefault(item_id, set()).update(words(text))
    rows = []
    for item_id, wanted in merged.items():
        scores = []
        for doc_id, tf in found:
            m = 50 + (50 * sum(tf.values()) * n_docs) // n_terms
            score = 0
            for t in wanted & tf.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:top], 1):
            rows.append((item_id, rank, None if none else doc_id, -score))
    return sorted(rows, key=str)


def answers(spark, docs, items, **options):
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    found = search(index, spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


def some_docs(seed, n, vocabulary=300, length=40):
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, vocabulary + 1)
    draw = lambda: " ".join(f"w{i}" for i in rng.choice(vocabulary, rng.integers(1, length), p=weights / weights.sum()))
    return [(int(i), draw()) for i in rng.permutation(n)]


@pytest.mark.parametrize("shard_bytes", [16 << 20, 4_000])
def test_against_plain_code(spark, monkeypatch, shard_bytes):
    docs = some_docs(1, 1500) + [(9000 + i, "W3 same w7 same") for i in range(120)]
    items = [(1, "w0 w3 w7 w250"), (2, "same W3"), (3, "w299 w1 w1 w1"), (4, "unknown"), (5, None), (3, "w20")]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    if shard_bytes < 16 << 20:  # the bound of a shard is read where the task runs
        rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id as id", "cast(text as binary) as body")
        n_docs, n_terms = index.n_docs, index.n_terms

        def small(batches):
            lexical.SHARD_BYTES = shard_bytes
            return lexical._shards(batches, n_docs, n_terms)

        index = lexical.Index(rows.coalesce(2).mapInArrow(small, lexical._INDEX), n_docs, n_terms)
        assert index.rows.select("shard").distinct().count() > 10
    found = search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == ranked(docs, items)


def test_odd_rows(spark):
    docs = [(None, "alpha beta"), (None, "alpha beta"), (1, None), (2, ""), (3, ".,;"), (4, "ÀÉ alpha"), (4, "ÀÉ alpha")]
    docs += [(5, "x" * 3_000_000 + " alpha"), (6, "alpha " * 400_000), (7, "a\u00a0b alpha-BETA")]
    items = [(None, "Alpha"), (1, "beta àé"), (2, "ÀÉ"), (3, ""), (4, "A\u00a0B")]
    assert answers(spark, docs, items) == ranked(docs, items)
    assert answers(spark, docs, items, top=2) == ranked(docs, items, 2)


def test_empty_tables_and_other_columns(spark):
    assert answers(spark, [], [(1, "a")]) == [] and answers(spark, [(1, "a")], []) == []
    df = spark.sql("select 1L as doc_id, 'alpha' as text, 2 as id, 'x' as body, 3 as term, 4 as `a.b`, 5 as shard")
    items = spark.sql("select 1 as item_id, 'alpha beta' as text, 2 as id, 'y' as item, 3 as rank")
    assert [tuple(r)[:3] for r in search(build_index(df), items).collect()] == [(1, 1, 1)]


def test_items_in_several_sets(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 10)
    docs, items = some_docs(2, 200), [(i, f"w{i} w{i + 5} w0") for i in range(7)]
    assert answers(spark, docs, items) == ranked(docs, items)


def test_packing_is_reversed():
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 1 << b, 50) for b in range(1, 40)] + [[0, 127, 128, 16383, 16384]])
    packed, ends = pack(values)
    assert (unpack(packed) == values).all() and ends[-1] == len(packed)
    assert len(pack(np.zeros(0, np.int64))[0]) == 0 and len(unpack(np.zeros(0, np.uint8))) == 0


def test_blocks_that_cannot_matter_stay_packed():
    rng = np.random.default_rng(4)
    n = 50_000

    def postings(places, gains):
        block = np.arange(0, len(places), lexical.BLOCK)
        ends = np.append(block[1:], len(places))
        ahead = np.concatenate([[0], places[:-1]])
        ahead[block] = 0
        packed, at = pack(np.stack([places - ahead, gains], 1).ravel())
        return lexical._Postings(
            len(places),
            places[ends - 1].astype(np.int32).tobytes(),
            np.maximum.reduceat(gains, block).tobytes(),
            at[2 * ends - 1].astype(np.int32).tobytes(),
            packed.tobytes(),
        )

    common, rare = np.arange(n), np.sort(rng.choice(n, 3000, replace=False))
    gain_c, gain_r = rng.integers(1, 100, n), rng.integers(400, 900, len(rare))
    lists = [(1, int(gain_c.max()), postings(common, gain_c)), (3, int(3 * gain_r.max()), postings(rare, gain_r))]
    heap = lexical._Heap(10)
    search_shard(heap, lists, common)
    score = gain_c.copy()
    score[rare] += 3 * gain_r
    best = np.lexsort((common, -score))[:10]
    assert list(heap.doc) == list(best) and list(heap.score) == list(score[best])
    assert lists[0][2].known.mean() < 0.5  # most blocks of the common term were never unpacked


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table_against_sql(spark, sf):
    path = f"/root/testdata/sf{sf}"
    assert differences(QUERIES["op13_lexical_search"](spark, path), connect(path), EXPECTED["op13_lexical_search"]) == []
