"""Every corpus query over a whole table against plain code."""

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from evenkeel.llm.queries import QUERIES
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


def table(name):
    return pd.read_parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="module")
def docs():
    return table("documents")


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).toPandas()


def test_mix(spark, docs):
    found = result(spark, "op1_mix")
    size = dict(zip(docs.doc_id, map(len, map(plain.words, docs.text))))
    assert dict(zip(found.doc_id, found["size"])) == size
    of_source = defaultdict(int)
    for doc_id, source in zip(docs.doc_id, docs.source):
        of_source[source] += size[doc_id]
    target = plain.targets(of_source)
    source = dict(zip(docs.doc_id, docs.source))
    for row in found.itertuples():
        assert row.source_size == of_source[source[row.doc_id]]
        assert row.target == pytest.approx(target[source[row.doc_id]])
        assert 0 <= row.taken <= 2 * row.size
    taken = found.assign(source=found.doc_id.map(source)).groupby("source").taken.sum()
    assert all(abs(taken[s] - target[s]) <= 1 for s in of_source)
    again = result(spark, "op1_mix")
    assert dict(zip(found.doc_id, found.taken)) == dict(zip(again.doc_id, again.taken))


def test_toxicity(spark, docs):
    found = result(spark, "op2_toxicity")
    assert len(found) == len(docs)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in found.itertuples())
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.7) == (found.predicted == 1)).all()


def test_shard(spark, docs):
    found = result(spark, "op3_shard")
    text = dict(zip(docs.doc_id, docs.text))
    counts = found.groupby("shard").size()
    assert set(found.law) == {"rows"} and set(counts.index) == set(range(8)) and counts.max() - counts.min() <= 1
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    for row in found.itertuples():
        assert (row.size, row.text_crc32) == (len(text[row.doc_id].encode()) + 1, zlib.crc32(text[row.doc_id].encode()))
    assert sorted(found.doc_id) == sorted(docs.doc_id)


def check_packing(found, docs):
    expected = sorted(p for d, ids in zip(docs.doc_id, plain.token_ids(docs.text)) for p in plain.pieces(d, ids))
    assert sorted(zip(found.doc_id, found.piece, found.start, found.length, found.ids_crc32)) == expected
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        ends = np.cumsum(own.length)
        assert list(own.offset) == [0, *ends[:-1]] and ends.iloc[-1] <= 2048
    least = -(-found.length.sum() // 2048)
    assert least <= found.sequence_id.nunique() <= least + 2


def test_pack(spark, docs):
    check_packing(result(spark, "op4_pack"), docs)


def test_token_counts(spark, docs):
    found = result(spark, "op5_token_counts")
    expected = {d: len(ids) for d, ids in zip(docs.doc_id, plain.token_ids(docs.text, plain=True))}
    assert dict(zip(found.doc_id, found.n_tokens)) == expected and len(found) == len(docs)


def test_main_text(spark):
    import html
    import re

    found = result(spark, "op6_main_text").set_index("page_id")
    pages = table("pages")
    assert len(found) == len(pages)
    for page_id, source in zip(pages.page_id, pages.html):
        article = source[source.index("<article>") + 9 : source.index("</article>")]
        blocks = [re.sub(r"<[^>]+>", " ", part) for part in re.split(r"</?(?:p|h1)>", article)]
        lines = [re.sub(r"\s+", " ", html.unescape(block)).strip() for block in blocks]
        expected = "\n".join(line for line in lines if line)
        assert found.text[page_id] == expected and found.n_chars[page_id] == len(expected)


def test_quality(spark, docs):
    found = result(spark, "op7_quality").set_index("doc_id")
    labels = table("labels").set_index("doc_id")
    for doc_id, text in zip(docs.doc_id, docs.text):
        row = found.loc[doc_id]
        base = plain.base_statistics(text)
        assert tuple(row[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == base
        assert row.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (row.base_failed and row.kept)
    labelled = found[~found.base_failed.astype(bool)].join(labels, how="inner")
    assert labelled[labelled.quality == 1].kept.mean() > 0.95


def test_jaccard(spark, docs):
    found = result(spark, "op8_jaccard")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == plain.groups(docs)
    assert len(found) == len(docs)


def test_neighbours(spark):
    found = result(spark, "op9_neighbours")
    rows = table("embeddings")
    vectors = np.array(rows.embedding.tolist(), float)
    ids = rows.vec_id.to_numpy()
    hits = asked = 0
    for query in np.flatnonzero(ids % 100 == 0):
        expected = plain.nearest(ids, vectors, query)
        own = found[found.query_id == ids[query]].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11))
        score = {int(i): s for i, s in zip(ids, np.sqrt(((vectors - vectors[query]) ** 2).sum(1)))}
        assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-12) for r in own.itertuples())
        assert list(zip(own.score, own.vec_id)) == sorted(zip(own.score, own.vec_id))
        hits += len({i for i, _ in expected} & set(own.vec_id))
        asked += len(expected)
    assert hits / asked >= 0.9


def test_substring(spark, docs):
    found = result(spark, "op10_substring")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found.itertuples()} == plain.stripped(docs)
    assert len(found) == len(docs)


def test_pipeline(spark, docs):
    stage = dict(corpus_pipeline.STAGES)
    held = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = held.columns

    def step(name):
        nonlocal held
        from evenkeel.llm.common import pin

        held = pin(stage[name](spark, held, SF_DIR), "test-stage")
        return held.toPandas()

    judged = result(spark, "op7_quality")
    good = step("quality rules")
    assert sorted(good.doc_id) == sorted(judged[judged.kept].doc_id) and list(good.columns) == columns
    assert dict(zip(good.doc_id, good.text)).items() <= dict(zip(docs.doc_id, docs.text)).items()

    single = step("n-gram Jaccard join")
    group = plain.groups(good)
    assert sorted(single.doc_id) == sorted(d for d in group if group[d][1] == d) and list(single.columns) == columns

    cut = step("substring dedup")
    expected = plain.stripped(single)
    import hashlib

    digest = lambda text: hashlib.sha256(" ".join(plain.words(text)).encode()).hexdigest()
    assert {r.doc_id: digest(r.text) for r in cut.itertuples()} == {d: e[2] for d, e in expected.items()}
    assert (cut.n_chars == cut.text.map(len)).all() and list(cut.columns) == columns

    mixed = step("mixing sources")
    before = cut.set_index("doc_id")
    sizes = cut.text.map(lambda t: len(plain.words(t))).groupby(cut.source).sum().to_dict()
    taken = mixed.text.map(lambda t: len(plain.words(t))).groupby(mixed.source).sum()
    target = plain.targets(sizes)
    assert all(abs(taken.get(s, 0) - target[s]) <= 1 for s in sizes) and list(mixed.columns) == columns
    whole = mixed[mixed.text == mixed.doc_id.map(before.text)]
    assert len(whole) >= len(mixed) - 2 * len(sizes)

    packed = stage["best-fit packing"](spark, held, SF_DIR).toPandas()
    check_packing(packed, mixed)
