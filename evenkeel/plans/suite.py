"""Config-driven validation suite: run comparisons, store failing rows, log one audit and one anomaly row each."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import ref
from evenkeel.operators.delta_compare import compare_delta
from evenkeel.operators.full_compare import compare_full
from evenkeel.operators.hard_delete import compare_deletes
from evenkeel.operators.tally import real_anomalies
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits
from evenkeel.sources.seeds import SLICE_SUFFIX, filter_config, parse_config
from evenkeel.sources.tables import TableStore

# Test types, statuses, log names.
FULL = "comprehensive_compare"
DELTA = "delta_compare"
DELETE = "hard_delete_check"
MATCH = "MATCH"
MISMATCH = "MISMATCH"
STARTED = "STARTED"  # of a test that no finished row followed: its run was cut off
AUDIT_LOG = "validation_audit_log"
ANOMALY_LOG = "validation_anomaly_log"
FAILURE_PREFIX = {FULL: "comprehensive_compare", DELTA: "delta_compare", DELETE: "hard_delete"}

_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampNTZType()

# The columns of the two logs.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("audit_run_id", _TEXT),
        T.StructField("execution_id", _TEXT),
        T.StructField("audit_ts", _TIME),
        T.StructField("model_name", _TEXT),
        T.StructField("test_type", _TEXT),
        T.StructField("load_type", _TEXT),
        T.StructField("status", _TEXT),
        T.StructField("source_model", _TEXT),
        T.StructField("source_row_count", _COUNT),
        T.StructField("target_model", _TEXT),
        T.StructField("target_row_count_before", _COUNT),
        T.StructField("target_row_count_after", _COUNT),
        T.StructField("rows_compared", _COUNT),
        T.StructField("unique_keys_compared", _COUNT),
        T.StructField("duplicate_groups_count", _COUNT),
        T.StructField("duplicate_rows_count", _COUNT),
        T.StructField("match_count", _COUNT),
        T.StructField("anomaly_count", _COUNT),
        T.StructField("delta_new_count", _COUNT),
        T.StructField("delta_updated_count", _COUNT),
        T.StructField("execution_duration_ms", _COUNT),
        T.StructField("error_message", _TEXT),
    ]
)
ANOMALY_SCHEMA = T.StructType(
    [
        T.StructField("total_anomalies_count", _COUNT),
        T.StructField("value_mismatch_count", _COUNT),
        T.StructField("missing_in_target_count", _COUNT),
        T.StructField("missing_in_source_count", _COUNT),
        T.StructField("source_duplicate_count", _COUNT),
        T.StructField("target_duplicate_count", _COUNT),
        T.StructField("duplicate_no_match_count", _COUNT),
        T.StructField("duplicate_partial_match_count", _COUNT),
        T.StructField("duplicate_full_match_count", _COUNT),
        T.StructField("delta_new_count", _COUNT),
        T.StructField("delta_updated_count", _COUNT),
        T.StructField("execution_id", _TEXT),
        T.StructField("audit_run_id", _TEXT),
        T.StructField("audit_ts", _TIME),
        T.StructField("status", _TEXT),
        T.StructField("model_name", _TEXT),
        T.StructField("test_query_model", _TEXT),
        T.StructField("compare_mode", _TEXT),
        T.StructField("load_type", _TEXT),
    ]
)
# Column order of the presentation views.
AUDIT_VIEW = [
    "audit_ts",
    "audit_run_id",
    "execution_id",
    "load_type",
    "test_type",
    "status",
    "model_name",
    "source_model",
    "target_model",
    "source_row_count",
    "target_row_count_before",
    "target_row_count_after",
    "rows_compared",
    "unique_keys_compared",
    "duplicate_groups_count",
    "duplicate_rows_count",
    "match_count",
    "anomaly_count",
    "delta_new_count",
    "delta_updated_count",
    "execution_duration_ms",
    "error_message",
]
ANOMALY_VIEW = [
    "audit_ts",
    "audit_run_id",
    "execution_id",
    "load_type",
    "compare_mode",
    "status",
    "model_name",
    "test_query_model",
    "total_anomalies_count",
    "delta_new_count",
    "delta_updated_count",
    "value_mismatch_count",
    "missing_in_target_count",
    "missing_in_source_count",
    "duplicate_no_match_count",
    "duplicate_partial_match_count",
    "duplicate_full_match_count",
    "source_duplicate_count",
    "target_duplicate_count",
]
RUN_COLUMNS = ["run_at", "audit_run_id", "execution_id", "model_name"]
FULL_VIEW = [
    "anomaly_type",
    "anomaly_description",
    "source_key_count",
    "target_key_count",
    "matched_row_count",
    "total_anomalies_count",
    "anomaly_type_count",
    "detected_at",
    "source_hash",
    "target_hash",
]
DELTA_VIEW = [
    "change_type",
    "key_classification",
    "columns_changed",
    "total_changes_count",
    "change_type_count",
    "after_delta_row_hash",
    "before_delta_row_hash",
]
DELETE_VIEW = ["change_type", "total_deletes_count"]

Relation = DataFrame | Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class SuiteRun:
    """What a suite run did: its id and, per test, the name of the failure log."""

    audit_run_id: str
    executions: list[dict]


class _Models:
    """Names of models -> DataFrames: given relations first, then stored tables."""

    def __init__(self, store: TableStore, relations: Mapping[str, Relation]):
        self.store = store
        self.relations = relations

    def get(self, name: str) -> DataFrame:
        found = self.relations.get(name)
        if found is None:
            return self.store.read(name)
        return found if isinstance(found, DataFrame) else found(self.store.spark)


def failure_log(test_type: str, model_name: str) -> str:
    return f"{FAILURE_PREFIX[test_type]}_{model_name}_failures"


def _required(value: str | None, what: str, test: Row) -> str:
    if not value:
        raise ValueError(f"validation suite: {what} is required for {test.test_type}, model_name={test.model_name}")
    return value


def _store_failures(store: TableStore, log: str, failures: DataFrame, run: dict[str, str]) -> None:
    """Write a comparison's rows once, behind the columns that identify the run.

    The first append creates the table, also when there is no failing row.
    """
    stamped = failures.select(
        F.lit(run["execution_id"]).alias("execution_id"),
        F.lit(run["audit_run_id"]).alias("audit_run_id"),
        F.lit(run["model_name"]).alias("model_name"),
        F.current_timestamp().alias("run_at"),
        "*",
    )
    store.append_log(log, stamped, run["execution_id"])


def _log_frame(spark: SparkSession, schema: T.StructType, rows: Sequence[Mapping]) -> DataFrame:
    """Log rows as the log has them; ``audit_ts`` is an instant, shown on the session's clock."""
    stored = T.StructType([T.StructField(f.name, _COUNT if f.name == "audit_ts" else f.dataType) for f in schema])
    found = spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in rows], stored)
    return found.withColumn("audit_ts", F.timestamp_micros("audit_ts").cast(_TIME))


def _append_rows(store: TableStore, log: str, schema: T.StructType, rows: Sequence[Mapping], run: str) -> None:
    """Append a run's log rows in one write; the journal of these rows is no longer needed then."""
    store.append_log(log, _log_frame(store.spark, schema, rows).coalesce(1), run)
    store.clear_journal(log, [row["execution_id"] for row in rows])


def _with_journal(store: TableStore, log: str, schema: T.StructType) -> DataFrame:
    """The log, and the journal's rows of runs that did not come to write theirs."""
    rows = store.read_log(log, schema)
    journal = store.read_journal(log)
    if not journal:
        return rows
    # A run may have been cut off between writing its rows and clearing its journal. The journal is small: a few rows
    # per run that was cut off.
    written = rows.where(F.col("execution_id").isin(sorted(journal))).select("execution_id")
    left = _log_frame(store.spark, schema, list(journal.values()))
    return rows.unionByName(left.join(written, "execution_id", "left_anti").select(*rows.columns))


def _run_full(models: _Models, test: Row, limits: Limits) -> tuple[DataFrame, dict]:
    expected = _required(test.test_query_model, "test_query_model", test)
    found = compare_full(
        models.get(test.model_name),
        models.get(expected),
        test["keys"],
        list(test["columns"]) or None,
        source_name=test.model_name,
        target_name=expected,
        limits=limits,
    )
    stats = found.stats
    base, before, after = test.model_name, None, stats["source_rows"]
    if test.resolved_base_model and test.model_name.endswith(SLICE_SUFFIX):
        base = test.resolved_base_model
        before = models.store.read_snapshot(base, test.snapshot_suffix).count()
        after = models.get(base).count()
    return real_anomalies(found.rows), {
        "source_model": expected,
        "source_row_count": stats["target_rows"],
        "target_model": base,
        "target_row_count_before": before,
        "target_row_count_after": after,
        "rows_compared": stats["source_rows"],
        "unique_keys_compared": stats["unique_keys"],
        "duplicate_groups_count": stats["duplicate_groups"],
        "duplicate_rows_count": stats["source_duplicates"],
        "total_anomalies_count": stats["total_anomalies"],
        "missing_in_target_count": stats["missing_in_target"],
        "missing_in_source_count": stats["missing_in_source"],
        "value_mismatch_count": stats["value_mismatch"],
        "source_duplicate_count": stats["source_duplicates"],
        "target_duplicate_count": stats["target_duplicates"],
    }


def _run_delta(models: _Models, test: Row, limits: Limits) -> tuple[DataFrame, dict]:
    base = _required(test.resolved_base_model, "base_model", test)
    before = models.store.read_snapshot(base, test.snapshot_suffix)
    view = models.get(test.model_name)
    found = compare_delta(view, before, test["keys"], list(test["columns"]) or None, limits=limits)
    view_rows = found.stats["view_rows"]
    return found.rows, {
        "source_model": test.model_name,
        "source_row_count": view_rows,
        "target_model": base,
        "target_row_count_before": found.stats["before_rows"],
        "target_row_count_after": view_rows if base == test.model_name else models.get(base).count(),
        "rows_compared": view_rows,
        "total_anomalies_count": found.stats["total_changes"],
        "delta_new_count": found.stats["new"],
        "delta_updated_count": found.stats["updated"],
    }


def _run_delete(models: _Models, test: Row, limits: Limits) -> tuple[DataFrame, dict]:
    base = _required(test.resolved_base_model, "base_model", test)
    before, target = models.store.read_snapshot(base, test.snapshot_suffix), models.get(base)
    found = compare_deletes(target, before, test["keys"], list(test["columns"]) or None, limits=limits)
    before_rows = found.stats["before_rows"]
    return found.rows, {
        "source_model": base,
        "source_row_count": before_rows,
        "target_model": base,
        "target_row_count_before": before_rows,
        "target_row_count_after": target.count(),
        "rows_compared": before_rows,
        "unique_keys_compared": before_rows,
        "total_anomalies_count": found.stats["total_deletes"],
        "missing_in_target_count": found.stats["total_deletes"],
    }


_RUNNERS = {FULL: _run_full, DELTA: _run_delta, DELETE: _run_delete}
_COUNTS = [f.name for f in ANOMALY_SCHEMA if f.name.endswith("_count")]


def _check_test(store: TableStore, test: Row) -> None:
    """What can be known to be wrong before any job runs."""
    if not test["keys"]:
        raise ValueError(
            f"validation suite: key_column is empty for model_name={test.model_name}, test_type={test.test_type}"
        )
    if test.test_type not in _RUNNERS:
        raise ValueError(
            f"validation suite: unsupported test_type={test.test_type} for model_name={test.model_name}; "
            f"allowed: {', '.join(_RUNNERS)}"
        )
    if test.test_type == FULL:
        _required(test.test_query_model, "test_query_model", test)
        base = test.resolved_base_model if test.model_name.endswith(SLICE_SUFFIX) else None
    else:
        base = _required(test.resolved_base_model, "base_model", test)
    if base:
        store.snapshot_parts(base, test.snapshot_suffix)


def _log_rows(test: Row, run: dict[str, str], measured: dict, started: datetime, ended: datetime) -> tuple[dict, dict]:
    """The audit row and the anomaly row of one finished test."""
    counts = {name: 0 for name in _COUNTS} | {k: v for k, v in measured.items() if k in _COUNTS}
    unique_keys = measured.get("unique_keys_compared")
    unmatched = counts["missing_in_target_count"] + counts["missing_in_source_count"] + counts["value_mismatch_count"]
    common = run | {
        "audit_ts": int(ended.timestamp() * 1_000_000),
        "status": MISMATCH if counts["total_anomalies_count"] > 0 else MATCH,
        "load_type": test.load_type,
    }
    audit = common | measured | {
        "test_type": test.test_type,
        "match_count": None if unique_keys is None else unique_keys - unmatched,
        "anomaly_count": counts["total_anomalies_count"],
        "delta_new_count": counts["delta_new_count"],
        "delta_updated_count": counts["delta_updated_count"],
        "execution_duration_ms": int((ended - started).total_seconds() * 1000),
    }
    return audit, common | counts | {"test_query_model": test.test_query_model, "compare_mode": test.test_type}


def run_suite(
    store: TableStore,
    config: DataFrame,
    relations: Mapping[str, Relation] | None = None,
    column_lists: DataFrame | None = None,
    model_name: str | None = None,
    model_name_like: str | None = None,
    test_type: str | None = None,
    parallel: int = 4,
    limits: Limits = DEFAULT_LIMITS,
    views: bool = True,
) -> SuiteRun:
    """Run every configured test; number and log them in order of model and test type.

    Each test is a few Spark jobs: a narrow pass over its tables, which also yields its counts, and one write of
    the failing rows. Only the configuration and those counts come to the driver. Up to ``parallel`` tests submit
    their jobs at the same time, so that small tables do not leave a cluster idle. ``relations`` maps model names
    to DataFrames (or functions that make them); other names are tables of the store.

    A configuration that cannot run (no keys, unknown type, absent model name or snapshot) is refused before any job.
    When a test fails later, no further test starts, those under way end, every finished test is logged, and then the
    error is raised. ``views`` registers the log and failure views of the run.

    Each test's audit row is in the journal of the log before the test does anything, and complete as soon as it has
    stored its failing rows; the log itself is written once, at the end. So a driver that dies leaves no failing row
    without an audit row: the views show its finished tests, and as ``STARTED`` the test that it died in.
    """
    models = _Models(store, relations or {})
    audit_run_id = f"{datetime.now(UTC):%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"
    chosen = parse_config(filter_config(config, model_name, model_name_like, test_type), column_lists)
    tests = chosen.orderBy("model_name", "test_type").collect()
    store.ensure_log(AUDIT_LOG, AUDIT_SCHEMA)
    store.ensure_log(ANOMALY_LOG, ANOMALY_SCHEMA)
    for test in tests:
        _check_test(store, test)
    stopped = threading.Event()

    def execute(number: int, test: Row) -> tuple[dict, dict, dict]:
        started = datetime.now(UTC)
        run = {
            "audit_run_id": audit_run_id,
            "execution_id": f"{audit_run_id}_{number}",
            "model_name": test.model_name,
        }
        begun = {"test_type": test.test_type, "load_type": test.load_type, "status": STARTED}
        begun |= run | {"audit_ts": int(started.timestamp() * 1_000_000)}
        store.write_journal(AUDIT_LOG, run["execution_id"], begun)
        log = failure_log(test.test_type, test.model_name)
        try:
            failures, measured = _RUNNERS[test.test_type](models, test, limits)
            _store_failures(store, log, failures, run)
        except Exception:
            store.clear_journal(AUDIT_LOG, [run["execution_id"]])  # nothing was stored
            raise
        audit, anomaly = _log_rows(test, run, measured, started, datetime.now(UTC))
        store.write_journal(ANOMALY_LOG, run["execution_id"], anomaly)
        store.write_journal(AUDIT_LOG, run["execution_id"], audit)
        outcome = {
            "test_type": test.test_type,
            "status": audit["status"],
            "failure_log": log,
            "keys": list(test["keys"]),
            "columns": list(test["columns"]),
        }
        return audit, anomaly, run | outcome

    def attempt(number: int, test: Row) -> tuple[dict, dict, dict] | Exception | None:
        if stopped.is_set():
            return None
        try:
            return execute(number, test)
        except BaseException as error:
            stopped.set()
            if isinstance(error, Exception):
                return error
            raise

    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        outcomes = list(pool.map(attempt, range(1, len(tests) + 1), tests))
    finished = [found for found in outcomes if isinstance(found, tuple)]
    if finished:
        logs = [
            (AUDIT_LOG, AUDIT_SCHEMA, [audit for audit, _, _ in finished]),
            (ANOMALY_LOG, ANOMALY_SCHEMA, [anomaly for _, anomaly, _ in finished]),
        ]
        with ThreadPoolExecutor(max_workers=2) as pool:
            list(pool.map(lambda log: _append_rows(store, *log, audit_run_id), logs))
    run = SuiteRun(audit_run_id, [execution for _, _, execution in finished])
    if views:
        register_views(store, run)
    for found in outcomes:
        if isinstance(found, Exception):
            raise found
    return run


def audit_view(store: TableStore) -> DataFrame:
    return _with_journal(store, AUDIT_LOG, AUDIT_SCHEMA).select(*AUDIT_VIEW)


def anomaly_view(store: TableStore) -> DataFrame:
    return _with_journal(store, ANOMALY_LOG, ANOMALY_SCHEMA).select(*ANOMALY_VIEW)


def failure_view(
    store: TableStore, test_type: str, model_name: str, keys: Sequence[str], columns: Sequence[str] = ()
) -> DataFrame:
    """Stored failing rows of a test in reading order; value columns only for the columns asked for."""
    failures = store.read_log(failure_log(test_type, model_name))
    if test_type == FULL:
        head, pair = [*RUN_COLUMNS, "source_model", "target_model", *keys, *FULL_VIEW], ("source_", "target_")
    elif test_type == DELTA:
        head, pair = [*RUN_COLUMNS, *keys, *DELTA_VIEW], ("after_delta_", "before_delta_")
    else:
        head, pair = [*RUN_COLUMNS, *keys, *DELETE_VIEW], ("before_delta_", "after_delta_")
    return failures.select(*[ref(c) for c in head], *[ref(f"{p}{c}") for c in columns for p in pair])


def register_views(store: TableStore, run: SuiteRun) -> list[str]:
    """Temporary views over the logs and failure tables of a run; returns their names."""
    views = {f"v_{AUDIT_LOG}": audit_view(store), f"v_{ANOMALY_LOG}": anomaly_view(store)}
    for test in run.executions:
        view = failure_view(store, test["test_type"], test["model_name"], test["keys"], test["columns"])
        views[f"v_{test['failure_log']}"] = view
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def store_check_failures(store: TableStore, check_name: str, failing: DataFrame, run_id: str) -> int:
    """Append a data-quality check's failing rows to its own log; returns how many rows this run added.

    A run that is repeated with the same ``run_id`` replaces its rows.
    """
    seen = Observation()
    stamped = failing.select(F.lit(run_id).alias("audit_run_id"), F.current_timestamp().alias("run_at"), "*")
    store.append_log(f"{check_name}_failures", stamped.observe(seen, F.count(F.lit(1)).alias("rows")), run_id)
    return int(seen.get.get("rows", 0))
