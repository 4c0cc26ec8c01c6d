"""LM scoring: counts against plain code, probabilities that add up, gradients against differences, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from evenkeel.llm import maxent
from evenkeel.llm.maxent import END, ENDINGS, HEAD_CLASSES, HEAD_WORDS, Weights, _histories, gradient_step, log_probabilities, score_texts
from evenkeel.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_rows(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of every document."""
    counts = Counter()
    for doc_id, text in docs:
        if not held_out(doc_id):
            counts.update([*words(text), None])
    total, mass = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    found = []
    for doc_id, text in docs:
        tokens = [*words(text), None]
        base = sum(math.log10((counts[t] + 1) / mass) for t in tokens)
        found.append((doc_id, held_out(doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    return sorted(found, key=str)


def shown(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


def test_whole_table_against_plain_counts_and_held_out_gain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op11_lm_score"](spark, SF_DIR).collect()
    assert shown(rows) == base_rows(docs)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) and all(r.score < 0 for r in rows)


@pytest.mark.parametrize("known_words", [0, 20, 1 << 20])
def test_words_that_are_not_broadcast(spark, known_words):
    rng = np.random.default_rng(1)
    docs = [(i, " ".join(f"W{w}" for w in rng.zipf(1.3, 60) % 997)) for i in range(60)] + [(None, "W1 only here"), (3, None), (4, " \t")]
    docs += [(i, "never seen before") for i in range(200) if held_out(i)][:3] + [(7, "x" * 2_000_000 + " y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = score_texts(df, known_words=known_words).collect()
    assert shown(rows) == base_rows(docs)
    by_rest = {(r.doc_id, r.n_tokens): r.score for r in rows}
    if known_words:  # the head differs where fewer words are known, so only equal heads give equal scores
        again = {(r.doc_id, r.n_tokens): r.score for r in score_texts(df, known_words=known_words).collect()}
        assert by_rest == pytest.approx(again, abs=1e-3)


def test_empty_table_no_training_text_and_clashing_columns(spark):
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    out = next(i for i in range(100) if held_out(i))
    rows = score_texts(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).collect()
    assert shown(rows) == base_rows([(out, "a b")]) and rows[0].score < 0
    df = spark.sql("select 1L as doc_id, 'a b' as text, 2 as key, 3 as h, 4 as n, 'x' as body, 5 as ids, true as held_out, 6 as `a.b`")
    assert shown(score_texts(df).collect()) == base_rows([(1, "a b")])


def small_model(spark, trained=True):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "on", "mats", "dogs", "ran"], 12)) for _ in range(40)]
    rows = spark.createDataFrame([(i, False, t.encode()) for i, t in enumerate(texts)], "doc_id long, held_out boolean, body binary")
    v = maxent.count_words(maxent.cut_words(rows), 1000)
    w = Weights()
    if trained:
        rng = np.random.default_rng(3)
        w.classes[:] = rng.normal(0, 1, w.classes.shape)
        w.words[:] = rng.normal(0, 1, w.words.shape)
    return v, w


@pytest.mark.parametrize("trained", [False, True])
def test_probabilities_after_a_history_add_up_to_one(spark, trained):
    v, w = small_model(spark, trained)
    every = np.concatenate([np.arange(len(v.head)), HEAD_WORDS + np.arange(ENDINGS)])
    for history in ([0, 1], [3, HEAD_WORDS + 5], [maxent._START, maxent._START]):
        before = np.tile(np.array(history), (len(every), 1))
        found = np.exp(log_probabilities(every, before, w, v.class_logs(), v.word_logs()))
        assert found.sum() == pytest.approx(1, abs=1e-5)
    # A class of endings is shared out among its words, seen ones by count, and one place for all unseen ones.
    assert v.ending_mass.sum() == ENDINGS and v.head_n.sum() == v.tokens and END in v.head


def test_without_weights_it_is_the_smoothed_unigram_model(spark):
    v, w = small_model(spark, False)
    ids = np.arange(len(v.head))
    found = log_probabilities(ids, np.zeros((len(ids), 2), np.int64), w, v.class_logs(), v.word_logs())
    assert np.exp(found) == pytest.approx((v.head_n + 1) / (v.tokens + v.words + ENDINGS), rel=1e-4)


def test_gradient_step_follows_differences(spark):
    v, w = small_model(spark)
    rng = np.random.default_rng(4)
    ids = np.concatenate([rng.integers(0, len(v.head), 30), HEAD_WORDS + rng.integers(0, ENDINGS, 10)])
    before = rng.integers(0, len(v.head), (40, 2))
    logs = v.class_logs(), v.word_logs()
    total = lambda: log_probabilities(ids, before, w, *logs).sum()
    moved = Weights()
    moved.classes[:], moved.words[:] = w.classes, w.words
    gradient_step(ids, before, moved, *logs, rate=3.0)
    place = int(maxent._class_rows(before)[0, 1])
    gradient = (moved.classes[place] - w.classes[place]) * np.sqrt(moved.class_force[place])  # rate / features = 1
    for column in [*np.flatnonzero(np.abs(gradient) > 0.01)[:5], HEAD_CLASSES]:
        kept = w.classes[place, column]
        w.classes[place, column] = kept + 0.05
        high = total()
        w.classes[place, column] = kept - 0.05
        low = total()
        w.classes[place, column] = kept
        assert gradient[column] == pytest.approx((high - low) / 0.1, abs=0.01)


def test_histories_stop_at_the_start_of_a_text():
    found = _histories(np.array([5, 6, 7, 8, 9]), np.array([3, 1, 1]))
    s = maxent._START
    assert found.tolist() == [[s, s], [5, s], [6, 5], [s, s], [s, s]]


def test_training_learns_what_follows_what(spark):
    rng = np.random.default_rng(5)
    pairs = [("red", "car"), ("blue", "boat"), ("green", "bike")]
    docs = [(i, " ".join(" ".join(pairs[p]) for p in rng.integers(0, 3, 40))) for i in range(300)]
    rows = score_texts(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    out = [r for r in rows if r.held_out]
    per_pair = sum(r.score for r in out) / sum((r.n_tokens - 1) / 2 for r in out)
    assert -1.0 < per_pair < -math.log10(3) + 0.05  # the second word of a pair costs next to nothing, the first log10(3)
