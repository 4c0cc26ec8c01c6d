import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import evenkeel as ek
from evenkeel.operators.runs import duration_text, node_name, node_type
from evenkeel.plans import suite
from evenkeel.sources.run_results import run_label
from evenkeel.sources.seeds import COLUMN_LIST_COLUMNS, TEST_CONFIG_COLUMNS, text_schema

SCHEMA = "k string, a string, b string"


def frame(spark, values, schema=SCHEMA):
    return spark.createDataFrame(values, schema)


def config(spark, *tests):
    padded = [tuple(test.get(c) for c in TEST_CONFIG_COLUMNS) for test in tests]
    return spark.createDataFrame(padded, text_schema(TEST_CONFIG_COLUMNS))


# -- configuration -------------------------------------------------------------------------------------------


def test_config_files(spark, tmp_path):
    tests = tmp_path / "tests.csv"
    tests.write_text(
        "model_name,test_type,key_column,test_query_model,compare_columns_ref,compare_columns,base_model,clone_suffix,config_set\n"
        'orders_delta_slice,delta_compare,"ID, ,LINE ",,order_cols,,,,\n'
        "orders,comprehensive_compare,ID,orders_source,order_cols,,,FULL_LOAD\n"  # one field short
        'items,comprehensive_compare,ID,items_source,order_cols,"x, y",,,SPECIAL\n'
    )
    lists = tmp_path / "lists.csv"
    lists.write_text('compare_columns_ref,compare_columns\norder_cols,"A, B,,C"\n')
    read = ek.read_test_config(spark, str(tests))
    assert read.columns == TEST_CONFIG_COLUMNS
    column_lists = ek.read_column_lists(spark, str(lists))
    assert column_lists.columns == COLUMN_LIST_COLUMNS
    parsed = {r.model_name: r for r in ek.parse_config(read, column_lists).collect()}
    one = parsed["orders_delta_slice"]
    assert (one["keys"], one["columns"]) == (["ID", "LINE"], ["A", "B", "C"])
    assert (one.resolved_base_model, one.snapshot_suffix, one.load_type) == ("orders", "_BEFORE_DELTA", "DELTA")
    short = parsed["orders"]
    assert (short.snapshot_suffix, short.load_type, short.resolved_base_model) == ("FULL_LOAD", "FULL_LOAD", None)
    assert (parsed["items"]["columns"], parsed["items"].load_type) == (["x", "y"], "SPECIAL")

    assert ek.filter_config(read, model_name="orders").count() == 1
    assert ek.filter_config(read, model_name_like="orders%").count() == 2
    assert ek.filter_config(read, model_name_like="orders%", test_type="delta_compare").count() == 1
    assert ek.filter_config(read, model_name="it's").count() == 0


# -- suite ---------------------------------------------------------------------------------------------------


@pytest.fixture
def loaded(spark, tmp_path):
    """A store where 't' was loaded twice and lost a row, and relations to check it with."""
    store = ek.TableStore(spark, str(tmp_path))
    store.load("t", frame(spark, [("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")]), "k")
    store.write("t", frame(spark, [("1", "a", "x"), ("2", "B", "y"), ("4", "d", "w")]))
    relations = {
        "t_delta_slice": lambda session: store.read("t").where("k <> '1'"),
        "expected": frame(spark, [("1", "a", "x"), ("2", "b", "y"), ("5", "e", "v"), ("5", "e", "v")]),
        "expected_slice": frame(spark, [("2", "B", "y"), ("4", "d", "w")]),
    }
    return store, relations


def test_suite(spark, loaded):
    store, relations = loaded
    tests = config(
        spark,
        {"model_name": "t", "test_type": suite.FULL, "key_column": "k", "test_query_model": "expected"},
        {"model_name": "t_delta_slice", "test_type": suite.FULL, "key_column": "k", "test_query_model": "expected_slice",
         "config_set": "DELTA_SLICE"},
        {"model_name": "t_delta_slice", "test_type": suite.DELTA, "key_column": "k", "compare_columns": "b, a"},
        {"model_name": "t", "test_type": suite.DELETE, "key_column": "k", "base_model": "t"},
    )
    run = ek.run_suite(store, tests, relations)
    audit = {(r.model_name, r.test_type): r for r in ek.audit_view(store).collect()}
    assert [e["execution_id"].rsplit("_", 1)[1] for e in run.executions] == ["1", "2", "3", "4"]
    assert [(e["model_name"], e["test_type"]) for e in run.executions] == sorted(audit)

    full = audit["t", suite.FULL]
    assert (full.status, full.load_type, full.source_model, full.target_model) == ("MISMATCH", "FULL_LOAD", "expected", "t")
    assert (full.source_row_count, full.target_row_count_before, full.target_row_count_after) == (4, None, 3)
    assert (full.rows_compared, full.unique_keys_compared, full.duplicate_groups_count) == (3, 3, 0)
    assert (full.anomaly_count, full.match_count) == (4, 1)  # 4 missing, 2 differs, 5 twice
    sliced = audit["t_delta_slice", suite.FULL]
    assert (sliced.status, sliced.target_model, sliced.load_type) == ("MATCH", "t", "DELTA_SLICE")
    assert (sliced.target_row_count_before, sliced.target_row_count_after, sliced.match_count) == (3, 3, 2)
    delta = audit["t_delta_slice", suite.DELTA]
    assert (delta.load_type, delta.anomaly_count, delta.delta_new_count, delta.delta_updated_count) == ("DELTA", 2, 1, 1)
    assert (delta.match_count, delta.unique_keys_compared, delta.source_row_count) == (None, None, 2)
    deleted = audit["t", suite.DELETE]
    assert (deleted.unique_keys_compared, deleted.match_count, deleted.anomaly_count) == (3, 2, 1)
    assert all(r.execution_duration_ms >= 0 and r.error_message is None for r in audit.values())

    anomalies = {(r.model_name, r.compare_mode): r for r in ek.anomaly_view(store).collect()}
    one = anomalies["t", suite.FULL]
    assert (one.value_mismatch_count, one.missing_in_target_count, one.target_duplicate_count) == (1, 1, 2)
    assert anomalies["t", suite.DELETE].missing_in_target_count == 1
    assert (one.test_query_model, anomalies["t", suite.DELETE].test_query_model) == ("expected", None)

    failures = ek.failure_view(store, suite.FULL, "t", ["k"], ["a"])
    assert failures.columns[:7] == ["run_at", "audit_run_id", "execution_id", "model_name", "source_model", "target_model", "k"]
    assert failures.columns[-2:] == ["source_a", "target_a"]
    assert Counter(r.anomaly_type for r in failures.collect()) == {
        "MISSING_IN_TARGET": 1, "VALUE_MISMATCH": 1, "DUPLICATE_IN_TARGET": 2
    }
    assert ek.failure_view(store, suite.FULL, "t_delta_slice", ["k"]).count() == 0
    names = ek.register_views(store, run)
    assert "v_delta_compare_t_delta_slice_failures" in names and "v_hard_delete_t_failures" in names
    assert spark.sql("select after_delta_a from v_delta_compare_t_delta_slice_failures").count() == 2

    again = ek.run_suite(store, tests, relations, model_name="t", test_type=suite.DELETE)
    assert len(again.executions) == 1 and ek.audit_view(store).count() == 5
    assert ek.failure_view(store, suite.DELETE, "t", ["k"]).count() == 2


@pytest.mark.parametrize(
    ("test", "message"),
    [
        ({"test_type": suite.FULL, "key_column": " , ", "test_query_model": "expected"}, "key_column is empty"),
        ({"test_type": suite.FULL, "key_column": "k"}, "test_query_model is required"),
        ({"test_type": suite.DELTA, "key_column": "k"}, "base_model is required"),
        ({"test_type": suite.DELETE, "key_column": "k"}, "base_model is required"),
        ({"test_type": "row_count", "key_column": "k"}, "unsupported test_type"),
        ({"test_type": suite.DELTA, "key_column": "k", "base_model": "t", "clone_suffix": "_NONE"}, "t_NONE not found"),
    ],
)
def test_suite_refuses(spark, loaded, test, message):
    store, relations = loaded
    with pytest.raises(ValueError, match=message):
        ek.run_suite(store, config(spark, {"model_name": "t"} | test), relations)


def test_suite_without_tests_has_empty_logs(spark, tmp_path):
    store = ek.TableStore(spark, str(tmp_path))
    assert ek.run_suite(store, config(spark, {"model_name": "t"}), model_name="other").executions == []
    assert ek.audit_view(store).count() == 0 and ek.anomaly_view(store).count() == 0


def test_older_log_files_lack_columns(spark, tmp_path):
    store = ek.TableStore(spark, str(tmp_path))
    frame(spark, [("old", "MATCH")], "model_name string, status string").write.parquet(store.log_path(suite.AUDIT_LOG))
    (row,) = ek.audit_view(store).collect()
    assert (row.model_name, row.status, row.match_count) == ("old", "MATCH", None)


# -- checks --------------------------------------------------------------------------------------------------


def test_checks(spark, limits):
    df = frame(spark, [("1", "a", None), ("1", "b", "x"), (None, "c", "y"), (None, "c", "y")])
    assert [(r.k, r.n_records) for r in ek.check_unique(df, "k").collect()] == [("1", 2)]
    assert [r.a for r in ek.check_not_null(df, "b").collect()] == ["a"]
    assert [(r.a, r.n_records) for r in ek.check_accepted_values(df, "a", ["a", "b"]).collect()] == [("c", 2)]
    assert ek.check_accepted_values(df, "b", ["x", "y"]).count() == 0

    child = frame(spark, [("1", "a", "x"), ("9", "b", "x"), (None, "c", "x")] + [("hot", str(i), "") for i in range(90)])
    parent = frame(spark, [("1",), (None,)], "id string")
    orphans = ek.check_relationships(child.repartition(5), "k", parent, "id", limits=limits)
    assert orphans.columns == child.columns
    assert Counter(r.k for r in orphans.collect()) == {"9": 1, "hot": 90}
    assert ek.check_relationships(parent, "id", parent, "id", limits=limits).count() == 0

    two, five = spark.range(2), spark.range(5)
    assert ek.check_row_count(two, two).count() == 0
    assert ek.check_row_count(two, five).collect()[0].asDict() == {"source_rows": 2, "target_rows": 5}
    assert ek.check_row_tolerance(two, five, 3).count() == 0
    assert ek.check_row_tolerance(two, five, 2).collect()[0].difference == 3
    assert ek.check_row_count(two.where("false"), two).collect()[0].source_rows == 0


@pytest.mark.parametrize(("hours", "status"), [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    df = frame(spark, [(datetime(2024, 1, 1),), (datetime(2023, 1, 1),)], "ts timestamp_ntz")
    as_of = datetime(2024, 1, 1 + hours // 24, hours % 24)
    (row,) = ek.check_freshness(df, "ts", as_of).collect()
    assert (row.status, row.age_seconds, row.max_loaded_at) == (status, hours * 3600, datetime(2024, 1, 1))
    assert ek.check_freshness(df, "ts", as_of, None, None).collect()[0].status == "pass"
    assert ek.check_freshness(df.where("false"), "ts", as_of).collect()[0].status == "error"


def test_failing_rows_are_stored(spark, tmp_path):
    store = ek.TableStore(spark, str(tmp_path))
    failing = ek.check_not_null(frame(spark, [("1", None, "x"), ("2", "a", "y")]), "a")
    assert ek.store_check_failures(store, "not_null_t_a", failing, "run1") == 1
    assert ek.store_check_failures(store, "not_null_t_a", failing.where("false"), "run2") == 0
    assert store.read_log("not_null_t_a_failures").columns == ["audit_run_id", "run_at", "k", "a", "b"]


# -- run results ---------------------------------------------------------------------------------------------


def test_node_names(spark):
    hash32 = "0123456789abcdef0123456789abcdef"
    cases = {
        "model.shop.orders": ("orders", "model"),
        "test.shop.unique_orders.51df897520": ("unique_orders", "test"),
        f"test.shop.long_check.{hash32}": ("long_check", "test"),
        "model.shop.v2.orders_by_day_and_region": ("orders_by_day_and_region", "model"),
        f"model.shop.{hash32}": (hash32, "model"),
        "seed.x": ("seed.x", "seed"),
        "plain": ("plain", "plain"),
        "model.shop." + "n" * 50: ("n" * 45 + "...", "model"),
        "": ("", "unknown"),
    }
    df = frame(spark, [(c,) for c in cases], "id string")
    from pyspark.sql import functions as F

    found = {r.id: (r.name, r.type) for r in df.select("id", node_name(F.col("id")).alias("name"), node_type(F.col("id")).alias("type")).collect()}
    assert found == cases


def test_duration_text(spark):
    cases = {None: "—", -1.0: "—", 0.0: "0.0s", 12.34: "12.3s", 59.96: "60.0s", 60.0: "1m 0.0s", 125.5: "2m 5.5s"}
    df = frame(spark, [(c,) for c in cases], "s double")
    from pyspark.sql import functions as F

    assert {r.s: r.t for r in df.select("s", duration_text(F.col("s")).alias("t")).collect()} == cases


def test_archived_runs(spark, tmp_path):
    def node(uid, status, seconds, **more):
        return {"unique_id": uid, "status": status, "execution_time": seconds} | more

    runs = {
        "20250305_143022": {
            "metadata": {"generated_at": "2025-03-05T14:30:22Z", "dbt_version": "1.9", "invocation_id": "abc"},
            "elapsed_time": 9.5,
            "args": {"invocation_command": ["x", "build"], "which": "build"},
            "results": [
                node("model.p.a", "Success", 2.0, adapter_response={"rows_affected": 7}, relation_name="db.a"),
                node("test.p.t.0123456789", "fail", 5.0, failures=3, message="3 rows"),
                node("model.p.b", None, None, rows_affected=4),
                node("model.p.c", "skipped", 0.0),
            ],
        },
        "20250306_000000": {"args": {"which": "run"}, "results": [node("model.p.a", "success", 1.0)]},
        "empty": {"results": []},
    }
    for name, document in runs.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "run_results.json").write_text(json.dumps(document, indent=1))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "run_results.json").write_text("{ not json")

    nodes = ek.read_run_results(spark, str(tmp_path))
    summary = {r.run: r for r in ek.status_summary(nodes, ["run", "run_label", "command", "elapsed_time"]).collect()}
    assert set(summary) == set(runs)
    first = summary["20250305_143022"]
    assert (first.run_label, first.command, first.elapsed_time) == ("2025-03-05 14:30:22", "x build", 9.5)
    assert (first.success_count, first.fail_count, first.skip_count, first.total_nodes) == (1, 1, 0, 4)
    assert first.overall_success is False and summary["20250306_000000"].overall_success is True
    assert summary["20250306_000000"].command == "run"
    assert (summary["empty"].total_nodes, summary["empty"].overall_success) == (0, True)

    failed = ek.failed_nodes(nodes).collect()
    assert [(r.name, r.type, r.failures, r.message) for r in failed] == [("t", "test", 3, "3 rows")]
    described = {r.unique_id: r for r in ek.describe_nodes(nodes.where("run = '20250305_143022'")).collect()}
    assert described["model.p.b"].status == "unknown" and described["model.p.b"].rows_affected == 4
    assert described["model.p.a"].rows_affected == 7
    top = ek.top_durations(nodes.where("run = '20250305_143022'"), ["run"], limit=2).orderBy("duration_rank").collect()
    assert [(r.name, r.duration) for r in top] == [("t", "5.0s"), ("a", "2.0s")]
    newest = ek.newest_first(ek.status_summary(nodes, ["run", "modified_at"])).collect()
    assert [r.modified_at for r in newest] == sorted((r.modified_at for r in newest), reverse=True)


def test_run_label(spark):
    from pyspark.sql import functions as F

    df = frame(spark, [("20250305_143022",), ("nightly",), ("2025-03-05-1430",)], "d string")
    assert [r[0] for r in df.select(run_label(F.col("d"))).collect()] == ["2025-03-05 14:30:22", "nightly", "2025-03-05-1430"]


def test_oddly_typed_documents_keep_their_rows(spark, tmp_path):
    node = {"unique_id": "model.p.a", "status": "error", "execution_time": 1.5, "failures": 2}
    odd = {
        "fraction": {"failures": 2.0},
        "text": {"execution_time": "1.5"},
        "object": {"adapter_response": "OK", "failures": None},
        "rows": {"adapter_response": {"rows_affected": "5"}},
    }
    for name, change in odd.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "run_results.json").write_text(json.dumps({"metadata": "none", "results": [node | change]}))
    found = {r.run: r for r in ek.read_run_results(spark, str(tmp_path)).collect()}
    assert found.keys() == odd.keys() and all(r.status == "error" and r.execution_time == 1.5 for r in found.values())
    assert (found["fraction"].failures, found["object"].failures, found["rows"].rows_affected) == (2, None, 5)


@pytest.mark.parametrize("seconds, text", [(0.15, "0.1s"), (0.25, "0.2s"), (2.65, "2.6s"), (61.25, "1m 1.2s"), (0.35, "0.3s")])
def test_durations_round_the_binary_value(spark, seconds, text):
    assert spark.range(1).select(duration_text(F.lit(seconds)).alias("t")).first().t == text == (
        f"{seconds:.1f}s" if seconds < 60 else f"{int(seconds // 60)}m {seconds % 60:.1f}s"
    )


def test_expire_keeps_what_any_snapshot_needs(spark, tmp_path):
    store = ek.TableStore(spark, str(tmp_path))
    store.write("t", spark.range(3))
    store.take_snapshot("t", "_OLD")
    store.write("t", spark.range(4))
    store.write("t", spark.range(5))
    assert store.expire("t") == 1
    assert store.read_snapshot("t", "_OLD").count() == 3 and store.read("t").count() == 5


def test_config_columns_are_found_by_name(spark, tmp_path):
    file = tmp_path / "tests.csv"
    file.write_text("Test_Type,model_name,key_column\nfull,m,\"a,\tb \"\n")
    config = ek.read_test_config(spark, str(file)).collect()
    assert [(r.model_name, r.test_type, r.base_model) for r in config] == [("m", "full", None)]


def failing(session):
    raise RuntimeError("no such source")


def test_a_failing_test_leaves_the_finished_ones_logged(spark, loaded):
    store, relations = loaded
    tests = config(
        spark,
        {"model_name": "t", "test_type": suite.DELETE, "key_column": "k", "base_model": "t"},
        {"model_name": "u", "test_type": suite.FULL, "key_column": "k", "test_query_model": "expected"},
        {"model_name": "v", "test_type": suite.FULL, "key_column": "k", "test_query_model": "expected"},
    )
    relations = relations | {"u": failing, "v": relations["expected"]}
    with pytest.raises(RuntimeError, match="no such source"):
        ek.run_suite(store, tests, relations, parallel=1, views=True)
    assert [r.model_name for r in ek.audit_view(store).collect()] == ["t"]
    assert [r.model_name for r in spark.table("v_validation_anomaly_log").collect()] == ["t"]
    assert spark.table("v_hard_delete_t_failures").count() == 1


def test_nothing_runs_when_a_test_cannot(spark, loaded):
    store, relations = loaded
    tests = config(
        spark,
        {"model_name": "a", "test_type": suite.DELETE, "key_column": "k", "base_model": "absent"},
        {"model_name": "t", "test_type": suite.DELETE, "key_column": "k", "base_model": "t"},
    )
    with pytest.raises(ek.TableMissing):
        ek.run_suite(store, tests, relations)
    assert ek.audit_view(store).count() == 0
    with pytest.raises(ek.TableMissing):
        store.read_log("hard_delete_t_failures")


def test_counts_include_rows_with_null_keys(spark, tmp_path):
    store = ek.TableStore(spark, str(tmp_path), log_schema="LOGS")
    store.load("t", frame(spark, [("1", "a", "x"), (None, "b", "y")]), "k")
    store.write("t", frame(spark, [("1", "a", "z"), (None, "b", "y"), (None, "c", "y")]))
    ek.run_suite(store, config(spark, {"model_name": "t", "test_type": suite.DELTA, "key_column": "k", "base_model": "t"}))
    (row,) = ek.audit_view(store).collect()
    assert (row.source_row_count, row.target_row_count_before, row.anomaly_count) == (3, 2, 1)
    assert (tmp_path / "LOGS" / suite.AUDIT_LOG).is_dir() and not (tmp_path / "QA" / suite.AUDIT_LOG).exists()


def test_audit_time_is_the_session_clock(spark, loaded, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        store, relations = loaded
        tests = config(spark, {"model_name": "t", "test_type": suite.DELETE, "key_column": "k", "base_model": "t"})
        ek.run_suite(store, tests, relations)
        audit = ek.audit_view(store).selectExpr("abs(timestampdiff(SECOND, audit_ts, cast(now() as timestamp_ntz))) as off")
        assert audit.first().off < 600
    finally:
        monkeypatch.undo()
        time.tzset()


def test_check_rows_are_counted_by_the_write(spark, tmp_path):
    store = ek.TableStore(spark, str(tmp_path))
    rows = frame(spark, [("1", None, "x"), ("2", None, "y")])
    assert [ek.store_check_failures(store, "c", rows, run) for run in ("run1", "run2", "run1")] == [2, 2, 2]
    assert store.read_log("c_failures").count() == 4  # a repeated run replaces its rows
