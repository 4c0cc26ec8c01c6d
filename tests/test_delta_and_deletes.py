import random
from collections import Counter

import pytest

from evenkeel import delta_compare, hard_delete_compare

SCHEMA = "k string, a string"


def frame(spark, values, schema=SCHEMA):
    return spark.createDataFrame([("k", v) for v in values], schema)


NO_MATCH = "DUPLICATE KEY — no content match ({} view rows, {} before rows)"
PARTIAL = "DUPLICATE KEY — partial match ({} of {} view rows matched)"


@pytest.mark.parametrize(
    ("view", "before", "expected"),
    [
        ("A", "", ("NEW", "UNIQUE", "NEW")),
        ("A", "A", None),
        ("A", "B", ("UPDATED", "UNIQUE", "a")),
        ("AB", "", ("NEW", "DUPLICATE", "NEW (duplicate key)")),
        ("AB", "C", ("UPDATED", "DUPLICATE", NO_MATCH.format(2, 1))),
        ("A", "BC", ("UPDATED", "DUPLICATE", NO_MATCH.format(1, 2))),
        ("AB", "AB", None),
        ("AB", "AC", ("UPDATED", "DUPLICATE", PARTIAL.format(1, 2))),
        ("A", "AA", ("UPDATED", "DUPLICATE", PARTIAL.format(2, 1))),
        ("AA", "AA", ("UPDATED", "DUPLICATE", PARTIAL.format(4, 2))),  # row pairs are counted, not rows
        ("AAB", "ABC", None),  # three pairs equal three rows on both sides
        ("", "A", None),
        ("", "AB", None),
        ("", "", None),
    ],
)
def test_truth_table(spark, limits, view, before, expected):
    found = delta_compare(frame(spark, view), frame(spark, before), "k", limits=limits).collect()
    assert [(r.change_type, r.key_classification, r.columns_changed) for r in found] == ([expected] if expected else [])


def test_output(spark, limits):
    schema = "k int, b string, A double, c string"
    view = spark.createDataFrame([(1, "x", 1.0, None), (2, "y", 2.0, "c"), (3, "z", 3.0, "d")], schema)
    before = spark.createDataFrame([(1, "x", 1.5, "was"), (2, "y", 2.0, "c")], schema)
    found = delta_compare(view, before, "k", limits=limits)
    assert found.columns == [
        "k", "change_type", "key_classification", "columns_changed", "after_delta_row_hash",
        "before_delta_row_hash", "after_delta_A", "before_delta_A", "after_delta_b", "before_delta_b",
        "after_delta_c", "before_delta_c", "total_changes_count", "change_type_count",
    ]
    one, three = found.orderBy("k").collect()
    assert (one.k, one.change_type, one.columns_changed) == (1, "UPDATED", "A, c")
    assert (one.after_delta_A, one.before_delta_A, one.before_delta_c) == (1.0, 1.5, "was")
    assert (three.change_type, three.before_delta_row_hash, three.before_delta_b) == ("NEW", None, None)
    assert (one.total_changes_count, one.change_type_count) == (2, 1)


def test_null_keys_take_no_part(spark, limits):
    view = spark.createDataFrame([(None, "x"), ("1", "x")], SCHEMA)
    before = spark.createDataFrame([(None, "y"), ("1", "x")], SCHEMA)
    assert delta_compare(view, before, "k", limits=limits).count() == 0
    partly = "k string, l string, a string"
    view = spark.createDataFrame([("1", None, "x"), ("1", "2", "x")], partly)
    found = delta_compare(view, view.where("false"), ["k", "l"], limits=limits).collect()
    assert [(r.k, r.l) for r in found] == [("1", "2")]


def test_no_compare_columns(spark, limits):
    view = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "k string")
    before = spark.createDataFrame([("1",), ("2",)], "k string")
    found = {r.k: r.columns_changed for r in delta_compare(view, before, "k", limits=limits).collect()}
    assert found == {"2": NO_MATCH.format(2, 1), "3": "NEW"}


def test_null_and_its_token_differ_in_value_but_not_in_text(spark):
    assert delta_compare(frame(spark, ["NULL"]), frame(spark, [None]), "k").count() == 0


def test_representative_is_the_smallest_hash(spark, limits):
    found = delta_compare(frame(spark, "ABCDEF"), frame(spark, ""), "k", limits=limits).collect()[0]
    import hashlib

    assert found.after_delta_a == min("ABCDEF", key=lambda v: hashlib.md5(v.encode()).hexdigest())


def test_differing_types_are_refused(spark):
    one = spark.sql("select 'k' as k, cast(1.5 as decimal(10,1)) as a")
    two = spark.sql("select 'k' as k, cast(1.5 as decimal(10,2)) as a")
    with pytest.raises(ValueError, match="type decimal"):
        delta_compare(one, two, "k")


@pytest.mark.parametrize("operator", [delta_compare, hard_delete_compare])
def test_keys_are_required(spark, operator):
    for keys in (None, [], ""):
        with pytest.raises(ValueError, match="key_columns"):
            operator(frame(spark, "A"), frame(spark, "A"), keys)


def test_map_columns_can_be_carried(spark):
    one = spark.sql("select 'k' as k, map('x', 1) as m")
    two = spark.sql("select 'k' as k, map('x', 2) as m")
    assert delta_compare(one, two.where("false"), "k").collect()[0].after_delta_m == {"x": 1}


def brute_force(view, before):
    def groups(rows):
        found = {}
        for key, value in rows:
            if key is not None:
                found.setdefault(key, []).append("NULL" if value is None else value)
        return found

    after, prior, changes = groups(view), groups(before), {}
    for key, mine in after.items():
        theirs = prior.get(key, [])
        pairs = sum(theirs.count(v) for v in mine)
        if not theirs:
            changes[key] = "NEW"
        elif len(mine) == len(theirs) == 1:
            if mine != theirs:
                changes[key] = "a"
        elif pairs == 0:
            changes[key] = NO_MATCH.format(len(mine), len(theirs))
        elif not pairs == len(mine) == len(theirs):
            changes[key] = PARTIAL.format(pairs, len(mine))
    return {k: "NEW (duplicate key)" if v == "NEW" and len(after[k]) > 1 else v for k, v in changes.items()}


@pytest.mark.parametrize("seed", [3, 4])
def test_against_brute_force(spark, limits, seed):
    rng = random.Random(seed)

    def table():
        rows = [(rng.choice([None, *"abcdefghijklmnopqrst"]), rng.choice([None, "NULL", "x", "y"])) for _ in range(60)]
        return rows + [("hot", rng.choice("xyz")) for _ in range(rng.choice([1, 40]))]

    view, before = table(), table()
    found = delta_compare(
        spark.createDataFrame(view, SCHEMA).repartition(5), spark.createDataFrame(before, SCHEMA), "k", limits=limits
    )
    assert {r.k: r.columns_changed for r in found.collect()} == brute_force(view, before)


def test_pair_counts_beyond_a_bigint(spark, monkeypatch):
    """The wide path gives the same numbers; forced here by calling every content large."""
    from evenkeel.operators import delta_compare as module

    monkeypatch.setattr(module, "_SMALL", 0)
    found = delta_compare(frame(spark, "AAAB"), frame(spark, "AAC"), "k").collect()[0]
    assert found.columns_changed == PARTIAL.format(6, 4)
    assert delta_compare(frame(spark, "AB"), frame(spark, "AB"), "k").count() == 0


# -- hard deletes --------------------------------------------------------------------------------------------


def test_hard_deletes(spark, limits):
    schema = "k string, b string, a int"
    before = spark.createDataFrame(
        [("1", "x", 1), ("2", "y", 2), ("2", "z", 3), ("3", "w", 4), (None, "n", 5), (None, "n", 5)], schema
    )
    target = spark.createDataFrame([("1", "q", 9), ("3", "w", 4), ("3", "w", 4), (None, "n", 5)], schema)
    found = hard_delete_compare(target, before, "k", limits=limits)
    assert found.columns == [
        "k", "change_type", "before_delta_a", "after_delta_a", "before_delta_b", "after_delta_b", "total_deletes_count"
    ]
    assert dict(found.dtypes)["after_delta_a"] == "int"
    rows = Counter((r.k, r.before_delta_b, r.after_delta_b, r.total_deletes_count) for r in found.collect())
    assert rows == {("2", "y", None, 4): 1, ("2", "z", None, 4): 1, (None, "n", None, 4): 2}


def test_partly_null_composite_key_is_always_reported(spark, limits):
    schema = "k string, l string, a string"
    df = spark.createDataFrame([("1", None, "x"), ("1", "2", "y")], schema)
    found = hard_delete_compare(df, df, ["k", "l"], limits=limits).collect()
    assert [(r.k, r.l) for r in found] == [("1", None)]


def test_dropped_keys_are_exactly_the_deletes(spark, limits):
    before = spark.createDataFrame([(str(i % 50), str(i)) for i in range(400)] + [("hot", "h")] * 200, SCHEMA)
    target = before.where("k not in ('7', '8', 'hot')")
    found = hard_delete_compare(target, before.repartition(6), "k", limits=limits)
    assert Counter(r.k for r in found.collect()) == {"7": 8, "8": 8, "hot": 200}
    assert hard_delete_compare(before, before, "k", limits=limits).count() == 0
    assert hard_delete_compare(before.where("false"), before, "k", limits=limits).count() == 600


def test_empty_snapshot(spark, limits):
    df = frame(spark, "A")
    assert hard_delete_compare(df, df.where("false"), "k", limits=limits).count() == 0


def test_any_column_name_will_do(spark, limits):
    schema = "n_b string, n_v int, v string, `a.b` string, `it's` string, pairs int"
    one = spark.createDataFrame([("1", 1, "x", "p", "q", 1), ("2", 2, "y", "r", "s", 2)], schema)
    two = spark.createDataFrame([("1", 1, "x", "p", "Q", 1), ("3", 2, "y", "r", "s", 2)], schema)
    changes = delta_compare(one, two, ["n_b", "v"], limits=limits)
    assert {(r.n_b, r.columns_changed) for r in changes.collect()} == {("1", "it's"), ("2", "NEW")}
    assert "after_delta_a.b" in changes.columns
    assert [r.n_b for r in hard_delete_compare(one, two, ["n_b", "v"], limits=limits).collect()] == ["3"]

    from evenkeel import changed_rows, full_compare, upsert

    found = full_compare(one, two, ["n_b", "v"], source_name="it's", limits=limits)
    assert sorted(r.anomaly_type for r in found.collect()) == ["MISSING_IN_SOURCE", "MISSING_IN_TARGET", "VALUE_MISMATCH"]
    assert changed_rows(one, two, ["n_b", "v"], limits=limits).count() == 2
    assert upsert(one, two, ["n_b", "v"], limits=limits).count() == 3
