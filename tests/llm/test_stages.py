"""The pipeline's stages on rows that the given tables do not have, against plain code."""

import pandas as pd

from evenkeel.llm import stages
from tests.llm import plain

SCHEMA = "doc_id long, text string, source string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def near_groups(rows, monkeypatch):
    """doc_id -> smallest doc_id reachable by five-word shingles and 80 percent."""
    four = plain.shingles
    monkeypatch.setattr(plain, "shingles", lambda text: four(text, 5))
    docs = pd.DataFrame([(d, t) for d, t, _ in rows], columns=["doc_id", "text"])
    return {d: found[1] for d, found in plain.groups(docs, 80).items()}


def test_near_duplicates_are_held_to_five_words_and_80_percent(spark, monkeypatch):
    text = words("w", 104)
    rows = [(number, f"{text} {words(f'x{number}y', more)}", "a") for number, more in enumerate((0, 20, 25, 26), 1)]
    rows += [(5, words("z", 104), "a"), (6, f"{words('z', 104)} {words('v', 20)}", "a")]
    found = sorted(row.doc_id for row in stages.one_of_each_group(table(spark, rows)).collect())
    group = near_groups(rows, monkeypatch)
    assert found == sorted(d for d in group if group[d] == d) == [1, 4, 5]


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    a, b, c, d, e = (words(name, 40) for name in "abcde")
    rows = [
        (1, a, "s"), (None, a, "s"), (None, f"{a} more", "s"),  # a known id comes first
        (None, b, "s"), (None, b, "s"), (None, c, "s"), (None, d, "s"),  # groups of null ids only
        (2, e, "s"), (2, f"{a} tail", "s"), (2, words("f", 40), "s"), (2, e, "t"),  # one id, unlinked texts
        (3, "", "s"), (3, "", "s"), (3, None, "s"), (None, "", "s"), (None, None, "s"),
    ]
    found = sorted(((r.doc_id or 0, r.text or "") for r in stages.one_of_each_group(table(spark, rows)).collect()))
    expected = [(1, a), (0, b), (0, c), (0, d), (2, e), (2, words("f", 40)), (3, ""), (3, ""), (0, ""), (0, "")]
    assert found == sorted(expected)


def test_the_mix_takes_every_row_for_itself(spark):
    texts = {name: words(name, 900) for name in "abcdefgh"}
    rows = [(None, texts["a"], "s"), (None, texts["b"], "s"), (5, texts["c"], "s"), (5, texts["d"], "s")]
    rows += [(6, texts["e"], "s"), (6, texts["e"], "s"), (None, texts["f"], None), (None, texts["g"], None), (8, texts["h"], None), (7, None, "s")]
    found = [(r.doc_id, r.source, r.text) for r in stages.mix(table(spark, rows)).collect()]
    size, taken = {}, {}
    for doc_id, text, source in rows:
        size[source] = size.get(source, 0) + len(plain.words(text))
    for doc_id, source, text in found:
        taken[source] = taken.get(source, 0) + len(plain.words(text))
        assert any((doc_id, source) == (i, s) and text in (t or "") for i, t, s in rows)
    target = plain.targets(size)
    assert all(abs(taken[source] - target[source]) <= 1 for source in size)
    # The first pass takes every row, so each text is there as often as it has rows.
    for doc_id, text, source in rows:
        whole = sum(row == (doc_id, source, text) for row in found)
        assert whole >= (rows.count((doc_id, text, source)) if text else 0), (doc_id, source)
