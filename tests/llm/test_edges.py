"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns whose names clash."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evenkeel.llm.html_text import extract, main_text
from evenkeel.llm.jaccard import jaccard_groups
from evenkeel.llm.mixing import mixed_sizes
from evenkeel.llm.neighbours import nearest_neighbours
from evenkeel.llm.packing import pack, pack_counts, reduce_by_dominance
from evenkeel.llm.quality import judge
from evenkeel.llm.separators import scan_separators, token_counts
from evenkeel.llm.sharding import shard_rows
from evenkeel.llm.substring import strip_repeats
from evenkeel.llm.toxicity import toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, slot string, frag string, token int"
CLASHING = ("_id", "_crc", "_body", "_parts", "_kept", "_fid", "_fcrc", "_source", "_size", "_first", "_words", "crc", "kept", "doc", "A b.c")
LABELS = "doc_id long, quality int, toxic int"
PASSAGE = " ".join(f"w{i}" for i in range(40))
TEXTS = [
    (1, PASSAGE, "a"),
    (2, f"{PASSAGE} tail", "a"),
    (2, f"{PASSAGE} tail", "a"),
    (3, None, "b"),
    (4, "", None),
    (5, " \n\t", None),
    (None, f"head {PASSAGE}", "b"),
    (6, "one two", "b"),
    (7, "One TWO", ""),
    (8, "x " * 70_000, "a"),
    (9, PASSAGE, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", s, len(t or ""), "x", "y", "z", 1) for d, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (None, 0, 1), (6, None, None), (9, 1, 0)], LABELS)


def rows(df):
    return [row.asDict() for row in df.collect()]


def test_every_document_operator_takes_odd_rows(docs, labels):
    for found in (
        mixed_sizes(docs),
        toxicity(docs, labels),
        shard_rows(docs),
        token_counts(docs),
        judge(docs, labels)[0],
        jaccard_groups(docs),
        strip_repeats(docs),
    ):
        assert found.count() == len(TEXTS)


def test_every_document_operator_takes_an_empty_table(docs, labels):
    none, unlabelled = docs.where("false"), labels.where("false")
    for found in (
        mixed_sizes(none),
        toxicity(none, unlabelled),
        shard_rows(none),
        pack(none),
        token_counts(none),
        judge(none, unlabelled)[0],
        jaccard_groups(none),
        strip_repeats(none),
    ):
        assert found.count() == 0
    assert {r["score"] for r in rows(toxicity(docs, unlabelled))} == {0.5}


def test_groups(docs):
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(jaccard_groups(docs))}
    assert found == {
        (1, 37, 1), (2, 38, 1), (9, 37, 1), (None, 38, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 1, 8),
    }


def test_repeats(docs):
    found = {(r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode()) for r in rows(strip_repeats(docs))}
    assert (None, 41, 0, f"head {PASSAGE}") in found  # a null id comes first
    assert (1, 40, 40, "") in found and (2, 41, 41 - 1, "tail") in found and (9, 40, 40, "") in found
    assert (8, 70_000, 69_999, "x") in found or (8, 70_000, 70_000, "") in found
    assert (3, 0, 0, "") in found and (6, 2, 0, "one two") in found


def test_mix_targets(docs):
    found = rows(mixed_sizes(docs))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert sum(r["taken"] for r in found) == pytest.approx(1.5 * sum(r["size"] for r in found), abs=2)


def test_shards(docs):
    found = rows(shard_rows(docs, shards=3))
    sizes = [sorted(r["slot"] for r in found if r["shard"] == s) for s in range(3)]
    assert sorted(map(len, sizes)) == [3, 4, 4] and all(s == list(range(len(s))) for s in sizes)
    slack = rows(shard_rows(docs, shards=3, slack=0.5))
    assert max(sum(r["shard"] == s for r in slack) for s in range(3)) <= 6


def test_pack_counts():
    groups = pack_counts({2048: 3, 2000: 5, 48: 4, 1024: 3, 700: 6, 30: 50}, 2048)
    packed = {}
    for group in groups:
        assert sum(size * n for size, n in group.contents) <= 2048
        for size, n in group.contents:
            packed[size] = packed.get(size, 0) + n * group.bins
    assert packed == {2048: 3, 2000: 5, 48: 4, 1024: 3, 700: 6, 30: 50}


def test_separators(spark):
    import numpy as np

    ids = [5, 9, 9, 1, 2, 3, 9, 4, 4]
    data = np.array(ids, "<u2").tobytes()
    blocks = [("f", i, data[i * 4 : i * 4 + 4]) for i in range(5)] + [("g", 0, b""), ("h", 0, None)]
    found = scan_separators(spark.createDataFrame(blocks, "file string, block long, data binary"), end=9)
    assert sorted((r.file, r.number, r.start, r.n_tokens, r.closed) for r in found.collect()) == [
        ("f", 0, 0, 1, True), ("f", 1, 2, 0, True), ("f", 2, 3, 3, True), ("f", 3, 7, 2, False),
    ]


PAGE = """<html><body><header>Site</header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies here.
</div><main><article><h1>A &amp; B</h1><p>First   paragraph with <b>bold</b><br>words, long enough to count.<p>Short.
<div class="ad">Buy this thing now, it is very good and very cheap.</div><p>Last paragraph of the article, also long.
</article></main><aside>Other stories that are interesting</aside><div id="comments"><p>I think this is a comment that is
rather long and full of words.</p></div><form><p>Your mail address please</p></form><footer>&copy; me</footer>"""


def test_pages(spark):
    text = "A & B\nFirst paragraph with bold words, long enough to count.\nShort.\nLast paragraph of the article, also long."
    assert extract(PAGE) == text
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 5), (3, "v", "", 5)], "page_id long, url string, html string, text int")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in rows(main_text(pages))}
    assert found == {1: (text, len(text)), 2: ("", 0), 3: ("", 0)}
    assert main_text(pages.where("false")).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
               (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in nearest_neighbours(table).collect())
    assert found == [(0, 1, 1, 0.0), (0, 2, 8, 0.0), (0, 3, 2, 2.236068)]
    assert nearest_neighbours(table.where("false")).count() == 0


def test_pipeline_takes_odd_rows(spark, docs, labels, tmp_path):
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, held.where("false"), str(tmp_path)).count() == 0
        if stage is not corpus_pipeline.pack:
            assert stage(spark, held, str(tmp_path)).columns == held.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_stages_carry_columns_with_the_names_they_use_themselves(spark, docs, labels, tmp_path):
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    wide = docs.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])
    for _, stage in corpus_pipeline.STAGES:
        plain, found = stage(spark, docs, str(tmp_path)), stage(spark, wide, str(tmp_path))
        if stage is corpus_pipeline.pack:
            assert found.count() == plain.count()
            continue
        assert found.columns == wide.columns and found.count() == plain.count() > 0
        assert all(row[name] == f"own {name}" for row in rows(found) for name in CLASHING)


def test_neighbours_do_not_depend_on_parts_or_slots(spark):
    vectors = [(i, [float(i % 7), float(i % 11), 1 + i / 100]) for i in range(1000)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    one, many = (
        sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(table, **options).collect())
        for options in ({}, {"part_rows": 16, "slot_queries": 3})
    )
    assert one == many and len(one) == 100


def test_dominance_never_costs_a_sequence():
    import itertools
    import random

    def fewest(pieces, capacity):
        """Exact, by trying all ways to fill the sequence that takes the first piece."""
        if not pieces:
            return 0
        first, rest = pieces[0], pieces[1:]
        best = len(pieces)
        for n in range(len(rest) + 1):
            for chosen in itertools.combinations(range(len(rest)), n):
                if first + sum(rest[i] for i in chosen) <= capacity:
                    left = [p for i, p in enumerate(rest) if i not in chosen]
                    best = min(best, 1 + fewest(left, capacity))
        return best

    draw = random.Random(5)
    for _ in range(150):
        pieces = sorted((draw.randint(2, 20) for _ in range(draw.randint(1, 7))), reverse=True)
        counts = {size: pieces.count(size) for size in set(pieces)}
        fixed = reduce_by_dominance(counts, 20)
        left = sorted((size for size, n in counts.items() for _ in range(n)), reverse=True)
        assert sum(group.bins for group in fixed) + fewest(left, 20) == fewest(pieces, 20), pieces


def test_digest_of_kept_words(docs):
    query = strip_repeats(docs).select("doc_id", F.sha2("kept", 256).alias("kept"))
    assert {r["kept"] for r in rows(query) if r["doc_id"] == 3} == {hashlib.sha256(b"").hexdigest()}
