"""The altered tables give the counts that were worked out for them beforehand."""

from collections import Counter

import evenkeel as ek
from workload import recipes

SF_DIR = "/root/testdata/sf0.01"


def full_counts(found):
    names = ["missing_in_target", "missing_in_source", "value_mismatch", "source_duplicates", "target_duplicates"]
    return [found.stats[name] for name in names]


def test_full_compare_counts(spark):
    assert full_counts(ek.compare_full(*recipes.orders_pair(spark, SF_DIR), "o_orderkey")) == [300, 300, 600, 600, 600]
    with_nulls = recipes.orders_pair(spark, SF_DIR, null_keys=True)
    assert full_counts(ek.compare_full(*with_nulls, "o_orderkey")) == [300, 300, 600, 615, 615]
    lines = recipes.lineitem_pair(spark, SF_DIR)
    assert full_counts(ek.compare_full(*lines, ["l_orderkey", "l_linenumber"])) == [898, 0, 827, 25_953, 25_339]


def test_delta_compare_counts(spark):
    stats = ek.compare_delta(*recipes.orders_load(spark, SF_DIR), "o_orderkey").stats
    assert (stats["new"], stats["updated"]) == (300, 600)
    assert ek.compare_deletes(*recipes.orders_load(spark, SF_DIR), "o_orderkey").stats["total_deletes"] == 300

    found = ek.delta_compare(*recipes.lineitem_load(spark, SF_DIR), ["l_orderkey", "l_linenumber"])
    kinds = Counter((r.change_type, r.key_classification, "no content" in r.columns_changed) for r in found.collect())
    assert kinds == {
        ("NEW", "UNIQUE", False): 898,
        ("UPDATED", "UNIQUE", False): 412,
        ("NEW", "DUPLICATE", False): 281,
        ("UPDATED", "DUPLICATE", True): 60,
        ("UPDATED", "DUPLICATE", False): 1283,
    }


def test_slice_and_batch_counts(spark):
    events, loaded = recipes.events_so_far(spark, SF_DIR)
    assert loaded.count() == 7994
    assert ek.incremental_read(events, loaded, "ts").count() == 2006
    assert ek.incremental_read(events, loaded, "ts", 3600).count() == 2018
    assert recipes.orders_batch(spark, SF_DIR)[1].count() == 1500
    assert ek.changed_rows(*recipes.part_pair(spark, SF_DIR), "p_partkey").count() == 240
