import random
from collections import Counter
from datetime import datetime

import pytest

from evenkeel import (
    TableMissing,
    TableStore,
    append,
    changed_rows,
    delete_insert,
    incremental_read,
    latest_per_key,
    stage_customers,
    stage_material,
    upsert,
    watermark_slice,
)
from evenkeel.functions.mapping import map_values, marker, sales_role
from evenkeel.operators.staging import CUSTOMER_COLUMNS, MATERIAL_COLUMNS

SCHEMA = "k string, a string"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, values, schema=SCHEMA):
    return spark.createDataFrame(values, schema)


# -- staging -------------------------------------------------------------------------------------------------


def test_value_mappings(spark):
    df = frame(spark, [(" sales ASSOCIATE ",), ("Account Manager",), ("inside sales",), ("other",), (None,)], "v string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(sales_role(F.col("v"))).collect()] == ["SA", "AM", "IS", None, None]
    assert [r[0] for r in df.select(map_values(F.col("v"), {"other": "O"})).collect()][3] == "O"
    assert [r[0] for r in df.select(marker(F.col("v"), "other")).collect()] == [" ", " ", " ", "X", " "]


def test_staging_transforms(spark):
    from evenkeel.operators.staging import CUSTOMER_RENAMES, MATERIAL_RENAMES

    raw = {name: "v" for name in CUSTOMER_RENAMES} | {
        "STREET": "Main", "CITY": "Town", "PO_CD": "1", "LANG_KEY": "  E ", "SALES_REP_TP": "CcCa",
        "SALES_REP_ROLE_CLASSIFICATION": "inside sales", "SALES_REP_MISC_CD": "JoE",
        "CREATED_DT": datetime(2024, 3, 5, 23, 59),
    }
    schema = ", ".join(f"{c} {'timestamp_ntz' if c == 'CREATED_DT' else 'string'}" for c in raw)
    df = frame(spark, [tuple(raw.values()), tuple((raw | {"CITY": None}).values())], schema)
    staged = stage_customers(df)
    assert staged.columns == CUSTOMER_COLUMNS
    first, second = staged.collect()
    assert (first.ADDRESS, second.ADDRESS) == ("Main Town 1", None)
    assert (first.LANGUAGE_CODE, first.SALES_REP_TYPE, first.SALES_REP_ROLE) == ("E", "ZcZa", "IS")
    assert (first.SALES_REP_NAME, first.CREATED_TIMESTAMP) == ("joe", "2024-03-05")

    raw = {name: "v" for name in MATERIAL_RENAMES} | {"BUNIT": "kg", "ISBMREQUIRED": "True"}
    df = frame(spark, [tuple(raw.values()), tuple((raw | {"ISBMREQUIRED": None}).values())], ", ".join(f"{c} string" for c in raw))
    staged = stage_material(df)
    assert staged.columns == MATERIAL_COLUMNS
    assert [(r.BA_UOM, r.B_M_IND) for r in staged.collect()] == [("KG", "X"), ("KG", " ")]


# -- watermarks ----------------------------------------------------------------------------------------------


def test_incremental_read(spark):
    schema = "id int, ts timestamp_ntz"
    source = frame(spark, [(i, datetime(2024, 1, 1, 0, 0, i)) for i in range(10)], schema)
    target = source.where("id <= 5")
    assert sorted(r.id for r in incremental_read(source, target, "ts").collect()) == [6, 7, 8, 9]
    assert sorted(r.id for r in incremental_read(source, target, "ts", 2).collect()) == [4, 5, 6, 7, 8, 9]
    assert incremental_read(source, None, "ts").count() == 10
    assert incremental_read(source, target.where("false"), "ts").count() == 10
    assert watermark_slice(source, source, "ts").count() == 0


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    frame(spark, [(1, datetime(2024, 1, 1))], "id int, ts timestamp_ntz").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = incremental_read(stored, stored, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,ScalarSubquery" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# -- column-difference slices --------------------------------------------------------------------------------


def brute_force(current, snapshot):
    """Every current row once per occurrence, if its key is new or any snapshot row of its key differs."""
    found = Counter()
    for key, value in current:
        matches = [v for k, v in snapshot if key is not None and k == key]
        found[key, value] += not matches or any(v != value for v in matches)
    return +found


@pytest.mark.parametrize("seed", [5, 6])
def test_changed_rows_against_brute_force(spark, limits, seed):
    rng = random.Random(seed)

    def table():
        keys = [None, *"abcdefghijklmnop"]
        made = [(rng.choice(keys), rng.choice([None, "NULL", "x", "y"])) for _ in range(50)]
        return made + [("hot", rng.choice("xy")) for _ in range(rng.choice([1, 20]))]

    current, snapshot = table(), table()
    found = changed_rows(frame(spark, current).repartition(4), frame(spark, snapshot), "k", limits=limits)
    assert rows(found) == brute_force(current, snapshot)


def test_unchanged_table_has_no_slice(spark, limits):
    df = frame(spark, [("1", "x"), ("2", None)])
    assert changed_rows(df, df, "k", limits=limits).count() == 0
    assert rows(changed_rows(df, df.where("false"), "k", limits=limits)) == rows(df)


def test_slice_of_many_rows_per_key_is_no_larger_than_the_table(spark, limits):
    current = frame(spark, [("1", "x"), ("1", "y"), ("1", "x")])
    snapshot = frame(spark, [("1", str(i)) for i in range(500)])
    assert rows(changed_rows(current, snapshot, "k", limits=limits)) == rows(current)


def test_slice_compares_nested_values(spark, limits):
    text = "k int, m map<string,int>, a array<string>, s struct<x:int,y:int>"
    current = frame(spark, [(1, {"a": 1, "b": 2}, [None, "x"], (None, 1)), (2, {"a": 1}, [], (1, 1)), (3, None, None, None)], text)
    snapshot = frame(spark, [(1, {"b": 2, "a": 1}, [None, "x"], (None, 1)), (2, {"a": 2}, [], (1, 1)), (3, None, None, None)], text)
    assert [r.k for r in changed_rows(current, snapshot, "k", limits=limits).collect()] == [2]
    moved = snapshot.selectExpr("k", "m", "reverse(a) as a", "named_struct('x', s.y, 'y', s.x) as s")
    found = changed_rows(snapshot, moved, "k", limits=limits)
    assert sorted(r.k for r in found.collect()) == [1, 3]  # 3: a null struct is not a struct of nulls


# -- loads ---------------------------------------------------------------------------------------------------


def test_upsert(spark, limits):
    target = frame(spark, [("1", "old"), ("2", "old"), ("hot", "x"), ("hot", "x"), ("hot", "x"), (None, "kept")])
    batch = frame(spark, [("2", "new"), ("3", "new"), (None, "added")])
    loaded = upsert(target, batch, "k", limits=limits)
    expected = {("1", "old"): 1, ("2", "new"): 1, ("3", "new"): 1, ("hot", "x"): 3, (None, "kept"): 1, (None, "added"): 1}
    assert rows(loaded) == expected
    assert loaded.columns == target.columns
    again = upsert(loaded.where("k is not null"), batch.where("k is not null"), "k", limits=limits)
    assert rows(again) == {k: n for k, n in expected.items() if k[0]}


def test_hot_target_key_is_replaced(spark, limits):
    target = frame(spark, [("hot", str(i)) for i in range(300)] + [("1", "a")]).repartition(6)
    assert rows(upsert(target, frame(spark, [("hot", "new")]), "k", limits=limits)) == {("hot", "new"): 1, ("1", "a"): 1}


def test_repeated_batch_keys(spark, limits):
    target, batch = frame(spark, [("1", "old")]), frame(spark, [("1", "a"), ("1", "b"), (None, "n"), (None, "n")])
    with pytest.raises(ValueError, match="more than once"):
        upsert(target, batch, "k", limits=limits)
    assert rows(upsert(target, batch, "k", order_by="a", limits=limits)) == {("1", "b"): 1, (None, "n"): 2}
    assert rows(delete_insert(target, batch, "k", limits=limits)) == rows(batch)
    assert rows(append(target, batch)) == rows(target) + rows(batch)
    assert rows(latest_per_key(batch.where("k = '1'"), "k", "a")) == {("1", "b"): 1}
    mapped = frame(spark, [(1, 1, {"a": 1}), (1, 2, {"b": 2}), (None, 3, None)], "k int, v int, m map<string,int>")
    assert [(r.k, r.v, r.m) for r in latest_per_key(mapped, "k", "v").orderBy("v").collect()] == [(1, 2, {"b": 2}), (None, 3, None)]


# -- versioned tables ----------------------------------------------------------------------------------------


def test_store_keeps_the_state_before_each_load(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first, second = frame(spark, [("1", "a"), ("2", "a")]), frame(spark, [("2", "b"), ("3", "b")])
    with pytest.raises(TableMissing, match="does not exist"):
        store.read("t")
    with pytest.raises(TableMissing, match="QA.t_BEFORE_DELTA"):
        store.read_snapshot("t")
    assert not store.exists("t")

    assert rows(store.load("t", first, "k")) == rows(first)
    assert rows(store.read_snapshot("t")) == rows(first)  # a full build is its own baseline
    assert rows(store.load("t", second, "k")) == {("1", "a"): 1, ("2", "b"): 1, ("3", "b"): 1}
    assert rows(store.read_snapshot("t")) == rows(first)
    store.load("t", frame(spark, [("9", "z")]), strategy="append")
    assert rows(store.read("t"))["9", "z"] == 1
    assert rows(store.read_snapshot("t")) == {("1", "a"): 1, ("2", "b"): 1, ("3", "b"): 1}
    store.load("t", first, "k", full_refresh=True)
    assert rows(store.read("t")) == rows(store.read_snapshot("t")) == rows(first)
    assert store.expire("t") == 3
    assert rows(store.read("t")) == rows(first)
    assert store.snapshot_name("t") == "QA.t_BEFORE_DELTA"
    with pytest.raises(ValueError, match="strategy"):
        store.load("t", first, "k", strategy="merge")


def test_an_append_writes_its_batch_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "a"), ("2", "a")]), "k")
    first = store.parts("t")
    store.load("t", frame(spark, [("3", "b")]).select("a", "k"), strategy="append")
    both = store.parts("t")
    assert both[:1] == first and spark.read.parquet(both[1]).count() == 1
    assert rows(store.read("t")) == {("1", "a"): 1, ("2", "a"): 1, ("3", "b"): 1}
    assert store.snapshot_parts("t") == first and store.expire("t") == 0
    assert store.load("t", frame(spark, [("2", "z")]), "k").count() == 3 and len(store.parts("t")) == 1
    wide = frame(spark, [(1,)], "n int")
    store.write("w", wide)
    assert store.load("w", frame(spark, [(5_000_000_000,)], "n bigint"), strategy="append").count() == 2
    assert store.read("w").schema["n"].dataType.simpleString() == "bigint"


def test_an_empty_pointer_is_an_error(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("t", frame(spark, [("1", "a")]))
    for file in (tmp_path / "SILVER" / "t").glob("._current*"):
        file.unlink()
    (tmp_path / "SILVER" / "t" / "_current").write_text("")
    with pytest.raises(TableMissing, match="is empty"):
        store.read("t")


def test_failed_load_leaves_the_table_as_it_was(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "a")]), "k")
    broken = frame(spark, [("1", "b")]).selectExpr("k", "raise_error('broken batch') as a")
    with pytest.raises(Exception, match="broken batch"):
        store.load("t", broken.selectExpr("k", "cast(a as string) as a"), "k")
    assert rows(store.read("t")) == {("1", "a"): 1}


def test_log_grows_by_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(TableMissing):
        store.read_log("log")
    store.ensure_log("log", frame(spark, []).schema)
    assert store.read_log("log").count() == 0
    store.append_log("log", frame(spark, [("1", "a")]))
    store.append_log("log", frame(spark, [("b", "2", 3)], "a string, k string, n int"))
    assert {(r.k, r.a, r.n) for r in store.read_log("log").collect()} == {("1", "a", None), ("2", "b", 3)}
