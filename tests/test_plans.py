"""What the plans must and must not contain."""

import contextlib
import io
import re

import pytest

from evenkeel import DEFAULT_LIMITS, Limits, changed_rows, full_compare, hard_delete_compare, top_durations
from evenkeel.functions.hashing import plain_columns
from evenkeel.operators import delta_compare as delta_module
from evenkeel.operators import full_compare as full_module
from evenkeel.plans import keyed
from workload import recipes

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython", "ArrowEvalPython")


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def exchanges(plan):
    return len(re.findall(r"^\(\d+\) Exchange$", plan, flags=re.M))


def test_full_compare_profile_shuffles_numbers_once(spark):
    source, target = recipes.lineitem_pair(spark, SF_DIR)
    keys = ["l_orderkey", "l_linenumber"]
    columns = [c for c in source.columns if c not in keys]
    plain = plain_columns(source, target, source.columns)
    plan = plan_of(full_module._profile(source, target, keys, columns, plain))
    assert exchanges(plan) == 1
    assert "SortAggregate" not in plan and "Join" not in plan
    assert not any(word in plan for word in FORBIDDEN)


def test_delta_profile_shuffles_numbers_once(spark):
    after, before = recipes.orders_load(spark, SF_DIR)
    plan = plan_of(delta_module._profile(after, before, ["o_orderkey"], ["o_custkey", "o_totalprice"]))
    assert exchanges(plan) == 1
    assert "SortAggregate" not in plan and "Window" not in plan and "Join" not in plan


def test_delta_pairs_never_gather_a_key_before_counting(spark):
    after, before = recipes.lineitem_load(spark, SF_DIR)
    keys, columns = ["l_orderkey", "l_linenumber"], ["l_tax", "l_quantity"]
    plain = plain_columns(after, before, columns)
    rows = delta_module._narrow(after, keys, columns, plain, 1).unionByName(
        delta_module._narrow(before, keys, columns, plain, 0)
    )
    plan = plan_of(delta_module._pairs(rows, keys))
    assert exchanges(plan) == 2 and "SortAggregate" not in plan
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, l_linenumber#\d+, _ek_r1#\d+L, _ek_r2#\d+L", plan)


def test_changes_of_unique_keys_are_paired_without_an_aggregate(spark):
    after, before = recipes.orders_load(spark, SF_DIR)
    plan = plan_of(delta_module.delta_compare(after, before, "o_orderkey"))
    assert "Aggregate" not in plan and "Window" not in plan
    assert not any(word in plan for word in FORBIDDEN)


def test_small_key_sets_filter_the_table_where_it_is_read(spark):
    source, target = recipes.orders_pair(spark, SF_DIR)
    plan = plan_of(full_compare(source, target, "o_orderkey"))
    assert exchanges(plan) == 2  # only anomalous rows, to pair them
    assert plan.count("BroadcastHashJoin Inner") >= 2
    assert not any(word in plan for word in FORBIDDEN)


def test_many_lone_rows_are_not_shuffled(spark):
    source, target = recipes.lineitem_pair(spark, SF_DIR)
    plan = plan_of(full_compare(source, target.select(*source.columns).where("l_tax < 0"), "l_orderkey"))
    assert exchanges(plan) == 0
    assert not any(word in plan for word in FORBIDDEN)


def test_slices_read_the_snapshot_once_and_join_no_rows(spark):
    after, before = recipes.lineitem_load(spark, SF_DIR)
    plan = plan_of(changed_rows(after, before, ["l_orderkey", "l_linenumber"]))
    assert exchanges(plan) == 0 and plan.count("Join Inner") == 1 and "Aggregate" not in plan
    assert not any(word in plan for word in FORBIDDEN)


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_large_key_sets_are_not_broadcast(spark, hot_rows):
    after, before = recipes.orders_load(spark, SF_DIR)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        limits = Limits(broadcast_bytes=0, hot_rows=hot_rows, hot_keys=10**9)
        plan = plan_of(hard_delete_compare(after, before, "o_orderkey", limits=limits))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin Inner" in plan
    assert not any(word in plan for word in FORBIDDEN)


def test_existence_needs_only_the_keys(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        "evenkeel.operators.hard_delete.pin",
        lambda df, **options: seen.setdefault("plan", plan_of(df)) and keyed.pin(df, **options),
    )
    after, before = recipes.orders_load(spark, SF_DIR)
    hard_delete_compare(after, before, "o_orderkey")
    assert set(re.findall(r"ReadSchema: (.*)", seen["plan"])) == {"struct<o_orderkey:bigint>"}


def test_top_durations_limits_before_the_shuffle(spark):
    plan = plan_of(top_durations(recipes.run_nodes(spark, SF_DIR), ["run"]))
    partial = re.search(r"WindowGroupLimit.*?Exchange", plan, flags=re.S)
    assert partial is not None and "Partial" in plan


def test_hot_keys_are_bounded_by_the_table_size():
    limits = DEFAULT_LIMITS
    assert limits.rows_per_slice(1000) == limits.hot_rows
    total = 10**13
    assert total / limits.rows_per_slice(total) <= limits.hot_keys


def test_rows_of_a_hot_key_spread_over_slices(spark):
    rows = spark.range(0, 4000, 1, 16).selectExpr("'hot' as k", "id")
    spread = keyed.spread(rows.selectExpr("*", "4000L as n"), "n", 500)
    sizes = [r["count"] for r in spread.groupBy("_ek_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) == 500
    copies = keyed.replicate(spark.sql("select 'hot' as k, 4000L as n"), "n", 500)
    assert copies.count() == 8


def test_hot_keys_are_broadcast_as_numbers(spark):
    """Two hot keys with long texts: the broadcast holds their digests only."""
    rows = spark.range(0, 900, 1, 6).selectExpr("repeat(if(id % 3 = 0, 'a', 'b'), 5000) as k", "id")
    picked = rows.groupBy("k").agg({"id": "count"}).withColumnRenamed("count(id)", "n")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        limits = Limits(broadcast_bytes=0)
        joined = keyed.keyed_join(rows, picked.drop("n"), ["k"], "inner", 1, picked, "n", 100, limits)
        assert joined.count() == 900 and joined.columns == ["k", "id"]
        plan = plan_of(joined)
        found = re.findall(r"BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert found and all(re.fullmatch(r"_ek_hot#\d+L, _ek_weight#\d+L", columns) for columns in found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_intermediates_go_to_the_session_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert keyed.scratch_root(spark) == folder.rstrip("/")
    kept, stats = keyed.pin(spark.range(10), "id > 6", {"rows": "count(1)", "none": "sum(cast(null as int))"}, "test")
    assert stats == {"rows": 10, "none": 0}
    assert kept.count() == 3 and kept.inputFiles()[0].replace("file://", "").startswith(
        keyed.scratch_root(spark).replace("file:", "")
    )


def test_large_key_sets_get_a_bloom_filter(spark):
    """With Spark's size thresholds lowered, the rows are tested before they are shuffled."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    old = {name: spark.conf.get(name) for name in changed}
    orders = recipes.table(spark, SF_DIR, "orders")
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        limits = Limits(broadcast_bytes=0)
        deleted = hard_delete_compare(orders.where("o_custkey > 50"), orders, "o_orderkey", limits=limits)
        differing = full_compare(orders, orders.where("o_custkey > 50"), "o_orderkey", limits=limits)
        for df in (deleted, differing):
            assert "might_contain" in plan_of(df)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
