"""Logs that grow by columns, appends that can be repeated, the suite's journal, and the archive of run results."""

import json
import os
from collections import Counter

import pytest

from evenkeel import (
    TableStore,
    anomaly_view,
    audit_view,
    check_not_null,
    read_run_archive,
    run_suite,
    store_check_failures,
    update_run_archive,
)
from evenkeel.plans import suite
from evenkeel.sources.seeds import TEST_CONFIG_COLUMNS, text_schema
from tests.test_plans import plan_of


def frame(spark, values, schema="k string, a string"):
    return spark.createDataFrame(values, schema)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# -- logs ----------------------------------------------------------------------------------------------------


def test_a_log_is_read_by_its_recorded_schema(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append_log("log", frame(spark, [("1", "a")]))
    store.append_log("log", frame(spark, [("b", "2", 3)], "a string, k string, n int"))
    for _ in range(3):
        store.append_log("log", frame(spark, [("1", "a")]))
    assert len(list((tmp_path / "QA" / "log" / "_schemas").glob("[!.]*"))) == 2  # one per different schema
    # Without the files there is nothing to open a footer of, and the columns are known all the same.
    for file in (tmp_path / "QA" / "log").rglob("*.parquet"):
        file.unlink()
    found = store.read_log("log")
    assert found.columns == ["k", "a", "n"] and found.count() == 0


def test_a_column_of_another_type_is_refused(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append_log("log", frame(spark, [("1", "a")]))
    store.append_log("log", frame(spark, [(1, "a")], "k int, a string"))
    with pytest.raises(ValueError, match="column k was written as"):
        store.read_log("log")


def test_logs_from_before_schemas_were_recorded(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    frame(spark, [("1", "a")]).write.parquet(str(tmp_path / "QA" / "log" / "old1"))
    frame(spark, [("2", 5)], "k string, n int").write.parquet(str(tmp_path / "QA" / "log" / "old2"))
    assert {(r.k, r.a, r.n) for r in store.read_log("log").collect()} == {("1", "a", None), ("2", None, 5)}


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for run, key in (("r 1", "1"), ("r/2", "2"), ("r 1", "3")):
        store.append_log("log", frame(spark, [(key, run)]), run)
    assert rows(store.read_log("log")) == {("3", "r 1"): 1, ("2", "r/2"): 1}
    assert rows(store.read_log("log", run="r/2")) == {("2", "r/2"): 1} and store.read_log("log", run="r3").count() == 0
    broken = frame(spark, [("4", "x")]).selectExpr("k", "cast(raise_error('broken rows') as string) as a")
    with pytest.raises(Exception, match="broken rows"):
        store.append_log("log", broken, "r 1")
    assert rows(store.read_log("log")) == {("3", "r 1"): 1, ("2", "r/2"): 1}
    assert store_check_failures(store, "c", check_not_null(frame(spark, [("1", None), ("2", None)]), "a"), "run") == 2
    assert store_check_failures(store, "c", check_not_null(frame(spark, [("1", None)]), "a"), "run") == 1
    assert [r.k for r in store.read_log("c_failures").collect()] == ["1"]


def test_one_run_is_read_from_its_folder_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for run in ("one", "two"):
        store.append_log("log", frame(spark, [("1", run)]), run)
    assert all("run=one" in file for file in store.read_log("log", run="one").inputFiles())
    assert "run=one]" in plan_of(store.read_log("log", run="one"))


# -- journal -------------------------------------------------------------------------------------------------


def run(store, spark, relations, names, parallel=1):
    tests = [(name, suite.FULL, "k", "expected", *[None] * 5) for name in names]
    return run_suite(store, spark.createDataFrame(tests, text_schema(TEST_CONFIG_COLUMNS)), relations, parallel=parallel)


def test_a_run_that_is_cut_off_leaves_no_failure_row_without_audit_row(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    good, expected = frame(spark, [("1", "x")]), frame(spark, [("1", "y")])

    def killed(_):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        run(store, spark, {"a": good, "b": killed, "c": good, "expected": expected}, "abc")
    shown = {r.model_name: r.status for r in audit_view(store).collect()}
    assert shown == {"a": "MISMATCH", "b": "STARTED"}
    assert [(r.model_name, r.value_mismatch_count) for r in anomaly_view(store).collect()] == [("a", 1)]
    audited = {r.execution_id for r in audit_view(store).collect()}
    assert {r.execution_id for r in store.read_log("comprehensive_compare_a_failures").collect()} <= audited
    # A later run's rows come beside it, and leave nothing in the journal.
    later = run(store, spark, {"a": good, "expected": expected}, "a")
    assert sorted((r.model_name, r.status) for r in audit_view(store).collect()) == [
        ("a", "MISMATCH"), ("a", "MISMATCH"), ("b", "STARTED"),
    ]
    assert not any(entry.startswith(later.audit_run_id) for entry in store.read_journal(suite.AUDIT_LOG))


def test_rows_that_are_in_the_log_and_in_the_journal_are_shown_once(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    monkeypatch.setattr(TableStore, "clear_journal", lambda *_: None)  # the driver goes away before it clears it
    df = frame(spark, [("1", "x")])
    run(store, spark, {"a": df, "expected": df}, "a")
    assert len(store.read_journal(suite.AUDIT_LOG)) == 1
    assert [(r.model_name, r.status) for r in audit_view(store).collect()] == [("a", "MATCH")]
    assert anomaly_view(store).count() == 1


def test_a_run_writes_each_log_once_and_makes_its_views(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    written = []
    append = TableStore.append_log
    monkeypatch.setattr(TableStore, "append_log", lambda self, name, *rest: written.append(name) or append(self, name, *rest))
    df = frame(spark, [("1", "x")])
    run(store, spark, {**dict.fromkeys("abcde", df), "expected": df}, "abcde", parallel=3)
    assert sorted(n for n in written if n.startswith("validation")) == [suite.ANOMALY_LOG, suite.AUDIT_LOG]
    assert spark.table("v_validation_audit_log").count() == 5
    assert spark.table("v_comprehensive_compare_a_failures").count() == 0


# -- archive of run results ----------------------------------------------------------------------------------


def write(tmp_path, run_name, nodes, at):
    file = tmp_path / "reports" / run_name / "run_results.json"
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(nodes if isinstance(nodes, str) else json.dumps({"results": [{"unique_id": n, "status": "pass"} for n in nodes]}))
    os.utime(file, (at, at))


def test_only_new_and_changed_documents_are_read(spark, tmp_path):
    store, reports = TableStore(spark, str(tmp_path / "store")), str(tmp_path / "reports")
    day = 86_400
    write(tmp_path, "r1", ["a", "b"], 50 * day)
    write(tmp_path, "r2", "{ broken", 50 * day)
    write(tmp_path, "r3", [], 50 * day + 7)
    assert update_run_archive(store, reports) == 3 and update_run_archive(store, reports) == 0
    found = lambda: Counter((r.run, r.unique_id) for r in read_run_archive(store).collect())
    assert found() == {("r1", "a"): 1, ("r1", "b"): 1, ("r3", None): 1}
    write(tmp_path, "r4", ["d"], 50 * day + 7)  # as old as the newest known one
    write(tmp_path, "r1", ["c"], 50 * day + 9)  # written again
    write(tmp_path, "r5", ["late"], 48 * day)  # older than is looked at
    assert update_run_archive(store, reports) == 2
    assert found() == {("r1", "c"): 1, ("r3", None): 1, ("r4", "d"): 1}
    assert update_run_archive(store, reports, late_seconds=5 * day) == 1
    assert found()["r5", "late"] == 1


def test_an_update_that_fails_on_the_way_is_done_again(spark, tmp_path, monkeypatch):
    store, reports = TableStore(spark, str(tmp_path / "store")), str(tmp_path / "reports")
    write(tmp_path, "r1", ["a"], 10_000_000)
    append = TableStore.append_log

    def fails(self, name, *rest):
        if name == "run_document_ledger":
            raise OSError("lost")
        return append(self, name, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(TableStore, "append_log", fails)
        with pytest.raises(OSError, match="lost"):
            update_run_archive(store, reports)
    assert read_run_archive(store).count() == 0
    assert update_run_archive(store, reports) == 1 and read_run_archive(store).count() == 1


def test_an_archive_that_was_never_updated_is_empty(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    (tmp_path / "reports" / "r1").mkdir(parents=True)
    write(tmp_path, "r1", "not json", 10_000_000)
    assert update_run_archive(store, str(tmp_path / "reports")) == 1
    assert read_run_archive(store).count() == 0
