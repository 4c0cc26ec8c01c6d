"""A key set too large to broadcast lets few other rows into the shuffle; buckets are compared row by row."""

from evenkeel.operators import full_compare as full_module
from evenkeel.functions.hashing import plain_columns
from evenkeel.plans import keyed
from evenkeel.sources.tables import TableStore
from tests.test_plans import plan_of


def test_few_other_rows_pass_the_filter(spark):
    rows = spark.range(100_000).selectExpr("id", "cast(id as string) as name", "id % 7 as v")
    picked = rows.where("id % 100 = 3").selectExpr("id", "name", "1L as n")
    passed = keyed.maybe_among(rows, picked, ["id", "name"], 1000)
    assert passed.columns == rows.columns
    assert passed.where("id % 100 = 3").count() == 1000 and passed.count() < 15_000
    limits = keyed.Limits(broadcast_bytes=0)
    found = keyed.fetch(rows, picked, ["id", "name"], "n", 150_000, 1, 100_000, limits)
    assert keyed._SET in plan_of(found)
    assert sorted(r["id"] for r in found.collect()) == list(range(3, 100_000, 100))


def test_buckets_are_neither_hashed_nor_sorted(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = spark.range(2000).selectExpr("id", "id % 7 as v")
    one = store.write("one", rows, bucket_by="id", buckets=3)
    two = store.write("two", rows.where("id <> 5"), bucket_by="id", buckets=3)
    profile = full_module._bucketed_profile(one, two, ["id"], ["v"], plain_columns(one, two, ["id", "v"]))
    with keyed.buckets_as_sorted(spark):
        plan = plan_of(profile)
        assert "HashAggregate" not in plan and "Sort [" not in plan and "Exchange" not in plan
    assert full_module.full_compare(one, two, "id", co_located=True).select("id").collect() == [(5,)]
