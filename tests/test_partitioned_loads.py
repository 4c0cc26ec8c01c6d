"""Tables dealt into slots: a load writes the slots it touches, and expiry knows what nobody needs."""

import datetime
import random
from collections import Counter
from pathlib import Path

import pytest

from evenkeel import TableStore, delete_insert, full_compare, upsert
from evenkeel.functions.hashing import plain_columns
from evenkeel.operators import full_compare as full_module
from tests.test_plans import exchanges, plan_of

SCHEMA = "k string, region string, v int"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, values, schema=SCHEMA):
    return spark.createDataFrame(values, schema)


def files(parts):
    return {str(f) for part in parts for f in Path(part.removeprefix("file:")).rglob("*.parquet")}


def some_rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *map(str, range(40))]), rng.choice([None, "", "EU", "US", "01", "a/b=c"]), rng.randrange(99)) for _ in range(n)]


def test_untouched_slots_keep_their_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "EU", 1), ("2", "US", 2), ("3", "ASIA", 3)]), "k", partition_by="region")
    before = store.parts("t")
    kept = {f: Path(f).stat().st_mtime_ns for f in files(before)}
    loaded = store.load("t", frame(spark, [("2", "US", 20), ("4", "US", 40)]), "k")
    assert rows(loaded) == {("1", "EU", 1): 1, ("2", "US", 20): 1, ("3", "ASIA", 3): 1, ("4", "US", 40): 1}
    assert loaded.columns == ["k", "region", "v"] and loaded.schema["region"].dataType.simpleString() == "string"
    shared = set(before) & set(store.parts("t"))
    assert len(shared) == 2 and len(store.parts("t")) == 3
    assert all(Path(f).stat().st_mtime_ns == kept[f] for f in files(shared))
    assert rows(store.read_snapshot("t")) == {("1", "EU", 1): 1, ("2", "US", 2): 1, ("3", "ASIA", 3): 1}


def test_a_row_that_moves_to_another_slot_leaves_the_old_one(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "EU", 1), ("2", "US", 2), ("3", "ASIA", 3)]), "k", partition_by="region")
    loaded = store.load("t", frame(spark, [("1", "US", 9)]), "k")
    assert rows(loaded) == {("1", "US", 9): 1, ("2", "US", 2): 1, ("3", "ASIA", 3): 1}


@pytest.mark.parametrize("strategy", ["upsert", "delete_insert"])
@pytest.mark.parametrize(("partition_by", "slots"), [("region", None), (["region", "v"], 3), ("k", 5)])
def test_same_rows_as_without_partitions(spark, tmp_path, limits, strategy, partition_by, slots):
    store = TableStore(spark, str(tmp_path))
    target, batch = frame(spark, some_rows(1, 150)), frame(spark, some_rows(2, 12)).dropDuplicates(["k"])
    store.load("t", target, partition_by=partition_by, slots=slots)
    whole = (upsert if strategy == "upsert" else delete_insert)(target, batch, "k", limits=limits)
    assert rows(store.load("t", batch, "k", strategy=strategy, limits=limits)) == rows(whole)
    again = store.load("t", batch.where("k is not null"), "k", strategy=strategy, limits=limits)
    assert rows(again) == rows(whole)


def test_appends_empty_tables_and_widened_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    none = frame(spark, [])
    store.load("t", none, partition_by="region")
    assert store.read("t").count() == 0 and store.read("t").columns == ["k", "region", "v"]
    assert rows(store.load("t", none, "k")) == {}
    assert rows(store.load("t", frame(spark, [("1", None, 1)]), strategy="append")) == {("1", None, 1): 1}
    store.load("t", frame(spark, [("2", "", 2), ("1", "EU", 5)]), strategy="append")
    assert rows(store.load("t", none, "k")) == {("1", None, 1): 1, ("2", "", 2): 1, ("1", "EU", 5): 1}
    assert rows(store.load("t", frame(spark, [("1", "US", 7)]), "k")) == {("2", "", 2): 1, ("1", "US", 7): 1}
    wide = frame(spark, [("2", "", 5_000_000_000)], "k string, region string, v bigint")
    assert rows(store.load("t", wide, "k")) == {("2", "", 5_000_000_000): 1, ("1", "US", 7): 1}
    assert store.read("t").schema["v"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="no column x"):
        store.write("t", none, partition_by="x")


def test_a_plain_table_can_be_partitioned_later_and_failed_loads_change_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "EU", 1), ("2", "US", 2)]), "k")
    store.write("t", store.read("t"), partition_by="region", slots=2)
    assert store.partitioning("t") == {"columns": ["region"], "slots": 2}
    broken = frame(spark, [("1", "EU", 1)]).selectExpr("k", "region", "cast(raise_error('broken batch') as int) as v")
    with pytest.raises(Exception, match="broken batch"):
        store.load("t", broken, "k")
    assert rows(store.read("t")) == {("1", "EU", 1): 1, ("2", "US", 2): 1}


def test_only_touched_slots_are_read_for_the_result(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [(str(i), "EU" if i % 2 else "US", i) for i in range(100)]), "k", partition_by="region")
    seen = []
    read = store._read_parts
    store._read_parts = lambda parts: seen.append(list(parts)) or read(parts)
    store.load("t", frame(spark, [("1", "EU", 7)]), "k")
    assert any(len(parts) == 1 for parts in seen)


def test_expiry_spares_snapshots_and_loads_in_progress(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "EU", 1), ("2", "US", 2)]), "k", partition_by="region")
    store.load("t", frame(spark, [("1", "EU", 5)]), "k")
    assert store.expire("t") == 0  # the snapshot needs the old slot
    store.load("t", frame(spark, [("1", "EU", 6)]), "k")
    unpointed = tmp_path / "SILVER" / "t" / "v=beingwritten"
    frame(spark, [("9", "EU", 9)]).write.parquet(str(unpointed))
    first = store.parts("t")
    assert store.expire("t") == 1  # the slot before the snapshot's
    assert unpointed.exists() and store.parts("t") == first
    assert rows(store.read("t")) == {("1", "EU", 6): 1, ("2", "US", 2): 1}
    assert rows(store.read_snapshot("t")) == {("1", "EU", 5): 1, ("2", "US", 2): 1}
    assert store.expire("t") == 0
    assert store.expire("t", unknown_after_seconds=-60) == 1 and not unpointed.exists()
    assert rows(store.read_snapshot("t")) == {("1", "EU", 5): 1, ("2", "US", 2): 1}


def test_versions_in_buckets_are_compared_without_a_shuffle(spark, tmp_path):
    schema = "id bigint, day date, v string"
    store, keys = TableStore(spark, str(tmp_path)), ["id", "day"]
    day = datetime.date(2024, 5, 1)
    values = [(i, day, f"v{i}") for i in range(200)] + [(3, day, "twice")]
    store.write("t", spark.createDataFrame(values, schema), bucket_by=keys, buckets=3)
    store.load("t", spark.createDataFrame([(5, day, "new"), (7, day, "v7"), (999, day, "x")], schema), keys, "delete_insert")
    after, before = store.read("t"), store.read_snapshot("t")
    assert len(files(store.parts("t"))) == 3
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(full_module._bucketed_profile(after, before, keys, ["v"], plain_columns(after, before, [*keys, "v"])))
        assert exchanges(plan) == 0 and "SortMergeJoin FullOuter" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    def shown(co_located):
        return rows(full_compare(after, before, keys, co_located=co_located).drop("detected_at"))

    assert shown(True) == shown(False)
    # One mismatch, one missing row, and two rows of a repeated key on each side.
    assert len(shown(True)) == 6
    # An append is a plain part beside the buckets; the next whole version is in buckets again.
    batch = spark.createDataFrame([(None, day, "x"), (None, day, "y"), (None, None, "z")], schema)
    assert store.load("t", batch, strategy="append").count() == after.count() + 3
    store.write("t", store.read("t"))
    again = store.read("t")
    assert exchanges(plan_of(again.groupBy(*keys).count())) == 0 and again.count() == after.count() + 3
    after = again  # null keys match each other, whatever the layout
    store.take_snapshot("t")
    store.load("t", spark.createDataFrame([(8, day, "other")], schema), keys, "delete_insert")
    after, before = store.read("t"), store.read_snapshot("t")
    assert shown(True) == shown(False) and any(r[1] is None for r in shown(True))
    with pytest.raises(ValueError, match="not both"):
        store.write("t", batch, partition_by="id", bucket_by="id")
