import hashlib
import random
from collections import Counter

import pytest

from evenkeel import compare_full, full_compare, key_stats, real_anomalies

SCHEMA = "k string, a string, b string"


def kinds(df):
    return Counter(r.anomaly_type for r in df.collect())


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


A, B, C = ("a", "1"), ("b", "2"), ("c", "3")


@pytest.mark.parametrize(
    ("source", "target", "expected"),
    [
        ([A], [], {"MISSING_IN_TARGET": 1}),
        ([], [A], {"MISSING_IN_SOURCE": 1}),
        ([A], [A], {}),
        ([A], [B], {"VALUE_MISMATCH": 1}),
        ([A, B], [], {"DUPLICATE_IN_SOURCE": 2}),
        ([], [A, B, B], {"DUPLICATE_IN_TARGET": 3}),
        ([A, A], [A, A], {"DUPLICATE_IN_SOURCE": 2, "DUPLICATE_IN_TARGET": 2}),
        ([A], [A, B], {"DUPLICATE_IN_TARGET": 2}),
        ([A, A, A], [A], {"DUPLICATE_IN_SOURCE": 3}),
        ([], [], {}),
    ],
)
def test_truth_table(spark, limits, source, target, expected):
    s = frame(spark, [("k", *row) for row in source])
    t = frame(spark, [("k", *row) for row in target])
    assert kinds(full_compare(s, t, "k", limits=limits)) == expected


def test_output_columns_and_values(spark, limits):
    s = frame(spark, [("1", "x", None), ("2", "p", "q"), ("2", "p", "q"), ("3", "only", "s")])
    t = frame(spark, [("1", "y", None), ("4", "only", "t")])
    found = full_compare(s, t, "k", source_name="left", target_name="right", limits=limits)
    assert found.columns == [
        "row_key_hash", "k", "anomaly_type", "anomaly_description", "source_hash", "target_hash",
        "source_a", "target_a", "source_b", "target_b", "source_key_count", "target_key_count",
        "matched_row_count", "detected_at", "source_model", "target_model", "total_anomalies_count",
        "anomaly_type_count",
    ]
    rows = {(r.k, r.anomaly_type): r for r in found.collect()}
    mismatch = rows["1", "VALUE_MISMATCH"]
    assert mismatch.row_key_hash == hashlib.md5(b"1").hexdigest()
    assert mismatch.source_hash == hashlib.md5(b"x|NULL").hexdigest()
    assert mismatch.target_hash == hashlib.md5(b"y|NULL").hexdigest()
    assert (mismatch.source_a, mismatch.target_a, mismatch.source_key_count) == ("x", "y", None)
    duplicate = rows["2", "DUPLICATE_IN_SOURCE"]
    assert duplicate.anomaly_description == "Key appears 2 times in source; all rows reported for review"
    assert (duplicate.source_key_count, duplicate.target_hash, duplicate.target_a) == (2, None, None)
    assert rows["3", "MISSING_IN_TARGET"].source_b == "s"
    assert rows["4", "MISSING_IN_SOURCE"].target_b == "t"
    assert {r.total_anomalies_count for r in rows.values()} == {5}
    assert duplicate.anomaly_type_count == 2
    assert (mismatch.source_model, mismatch.target_model) == ("left", "right")


def test_duplicates_for_information(spark):
    s = frame(spark, [("k", *A), ("k", *B)])
    found = full_compare(s, s, "k", fail_on_duplicates=False)
    assert kinds(found) == {"DUPLICATE_IN_SOURCE_INFO": 2, "DUPLICATE_IN_TARGET_INFO": 2}
    assert real_anomalies(found).count() == 0


def test_null_keys_match_each_other_and_their_token(spark, limits):
    null = frame(spark, [(None, *A)])
    token = frame(spark, [("___NULL_KEY___", *A)])
    assert kinds(full_compare(null, null, "k", limits=limits)) == {}
    assert kinds(full_compare(null, token, "k", limits=limits)) == {}
    assert kinds(full_compare(null, token, ["k", "a"], limits=limits)) == {}


def test_text_equality_of_values(spark):
    def same(left, right, schema=SCHEMA):
        return kinds(full_compare(frame(spark, [left], schema), frame(spark, [right], schema), "k")) == {}

    assert same(("k", None, "x"), ("k", "NULL", "x"))
    assert same(("k", "a|b", "c"), ("k", "a", "b|c"))
    assert not same(("k", "a|b", "c"), ("k", "a", "c"))
    assert not same(("k", "a", None), ("k", None, "a"))
    mixed = "k string, a string, n int, b string"
    assert same(("k", "x|5", 7, "y"), ("k", "x", 5, "7|y"), mixed)
    assert not same(("k", "x", 5, "y"), ("k", "x", None, "y"), mixed)
    numbers = "k string, a double, b int"
    assert not same(("k", 0.0, 1), ("k", -0.0, 1), numbers)
    assert not same(("k", None, 1), ("k", 1.0, None), numbers)
    assert same(("k", float("nan"), 1), ("k", float("nan"), 1), numbers)


def test_types_may_differ_when_texts_agree(spark):
    s = spark.sql("select 7 as k, 5 as a, cast(1.5 as decimal(10,1)) as b")
    t = spark.sql("select 7L as k, 5L as a, cast(1.5 as decimal(10,2)) as b")
    assert kinds(full_compare(s, t, "k", compare_columns=["a"])) == {}
    assert kinds(full_compare(s, t, "k", compare_columns=["a", "b"])) == {"VALUE_MISMATCH": 1}


def test_composite_key_with_separator(spark, limits):
    s = frame(spark, [("a|b", "c", "1")])
    t = frame(spark, [("a", "b|c", "1")])
    assert kinds(full_compare(s, t, ["k", "a"], limits=limits)) == {}


def test_no_compare_columns(spark, limits):
    s, t = frame(spark, [("1",), ("2",)], "k string"), frame(spark, [("1",), ("3",)], "k string")
    found = full_compare(s, t, "k", limits=limits)
    assert kinds(found) == {"MISSING_IN_TARGET": 1, "MISSING_IN_SOURCE": 1}
    assert {r.source_hash for r in found.collect()} == {None}


def test_empty_key_list_is_refused(spark):
    with pytest.raises(ValueError, match="key_columns"):
        full_compare(frame(spark, []), frame(spark, []), [])


def test_one_hot_key(spark, limits):
    """A third of the rows share one key, equal copies and different contents alike."""
    hot = [("hot", "same", "x")] * 300 + [("hot", str(i), "y") for i in range(300)]
    cold = [(f"c{i}", "v", str(i)) for i in range(1200)]
    s = frame(spark, hot + cold).repartition(8)
    t = frame(spark, [(k, a, "changed" if k == "c5" else b) for k, a, b in cold])
    found = compare_full(s, t, "k", limits=limits)
    assert kinds(found.rows) == {"DUPLICATE_IN_SOURCE": 600, "VALUE_MISMATCH": 1}
    assert {r.source_key_count for r in found.rows.collect()} == {600, None}
    assert found.stats["source_rows"] == 1800 and found.stats["unique_keys"] == 1200


def brute_force(source, target):
    def text(row):
        return "|".join("NULL" if v is None else str(v) for v in row[1:])

    def by_key(rows):
        groups = {}
        for row in rows:
            groups.setdefault(row[0] or "___NULL_KEY___", []).append(row)
        return groups

    s, t, found = by_key(source), by_key(target), Counter()
    for key in s.keys() | t.keys():
        mine, theirs = s.get(key, []), t.get(key, [])
        if len(mine) == 1 and not theirs:
            found["MISSING_IN_TARGET", key] += 1
        if len(theirs) == 1 and not mine:
            found["MISSING_IN_SOURCE", key] += 1
        if len(mine) == 1 and len(theirs) == 1 and text(mine[0]) != text(theirs[0]):
            found["VALUE_MISMATCH", key] += 1
        if len(mine) > 1:
            found["DUPLICATE_IN_SOURCE", key] += len(mine)
        if len(theirs) > 1:
            found["DUPLICATE_IN_TARGET", key] += len(theirs)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, limits, seed):
    rng = random.Random(seed)
    words = [None, "NULL", "a", "b", "a|b", "b|", "|b", ""]

    def table():
        keys = [None, "___NULL_KEY___"] + [f"k{i}" for i in range(40)]
        rows = [(rng.choice(keys), rng.choice(words), rng.choice(words)) for _ in range(60)]
        return rows + [("hot", rng.choice(words), rng.choice(words)) for _ in range(rng.choice([0, 1, 30]))]

    source, target = table(), table()
    found = full_compare(frame(spark, source).repartition(5), frame(spark, target), "k", limits=limits)
    got = Counter((r.anomaly_type, r.k or "___NULL_KEY___") for r in found.collect())
    assert got == brute_force(source, target)


def test_swapping_sides_swaps_missing(spark):
    s, t = frame(spark, [("1", *A), ("2", *A)]), frame(spark, [("2", *A), ("3", *B), ("4", *B)])
    assert kinds(full_compare(s, t, "k")) == {"MISSING_IN_TARGET": 1, "MISSING_IN_SOURCE": 2}
    assert kinds(full_compare(t, s, "k")) == {"MISSING_IN_TARGET": 2, "MISSING_IN_SOURCE": 1}
    assert kinds(full_compare(s, s, "k")) == {}


def test_key_stats(spark):
    df = frame(spark, [("1", *A), ("2", *A), ("2", *B), (None, *A), (None, *B), (None, *C)])
    assert key_stats(df, "k").collect()[0].asDict() == {
        "unique_keys_count": 1,
        "duplicate_groups_count": 2,
        "duplicate_rows_count": 5,
    }
    assert key_stats(df.where("false"), "k").collect()[0].duplicate_rows_count == 0
