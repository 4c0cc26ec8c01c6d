"""Incremental loads and table reconciliation on Spark DataFrames."""

from evenkeel.operators.checks import (
    check_accepted_values,
    check_freshness,
    check_not_null,
    check_relationships,
    check_row_count,
    check_row_tolerance,
    check_unique,
)
from evenkeel.operators.delta_compare import compare_delta, delta_compare
from evenkeel.operators.full_compare import compare_full, full_compare
from evenkeel.operators.hard_delete import compare_deletes, hard_delete_compare
from evenkeel.operators.load import append, delete_insert, latest_per_key, upsert
from evenkeel.operators.runs import describe_nodes, failed_nodes, status_summary, top_durations
from evenkeel.operators.slices import changed_rows, incremental_read, watermark, watermark_slice
from evenkeel.operators.staging import stage_customers, stage_material
from evenkeel.operators.tally import anomaly_tally, delete_tally, delta_tally, key_stats, real_anomalies
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits
from evenkeel.plans.suite import (
    anomaly_view,
    audit_view,
    failure_view,
    register_views,
    run_suite,
    store_check_failures,
)
from evenkeel.sources.run_results import (
    newest_first,
    parse_run_results,
    read_run_archive,
    read_run_results,
    update_run_archive,
)
from evenkeel.sources.seeds import filter_config, parse_config, read_column_lists, read_test_config
from evenkeel.sources.tables import TableMissing, TableStore

__all__ = [
    "DEFAULT_LIMITS",
    "Limits",
    "TableMissing",
    "TableStore",
    "anomaly_tally",
    "anomaly_view",
    "append",
    "audit_view",
    "changed_rows",
    "check_accepted_values",
    "check_freshness",
    "check_not_null",
    "check_relationships",
    "check_row_count",
    "check_row_tolerance",
    "check_unique",
    "compare_deletes",
    "compare_delta",
    "compare_full",
    "delete_insert",
    "delete_tally",
    "delta_compare",
    "delta_tally",
    "describe_nodes",
    "failed_nodes",
    "failure_view",
    "filter_config",
    "full_compare",
    "hard_delete_compare",
    "incremental_read",
    "key_stats",
    "latest_per_key",
    "newest_first",
    "parse_config",
    "parse_run_results",
    "read_column_lists",
    "read_run_archive",
    "read_run_results",
    "read_test_config",
    "real_anomalies",
    "register_views",
    "run_suite",
    "stage_customers",
    "stage_material",
    "status_summary",
    "store_check_failures",
    "top_durations",
    "update_run_archive",
    "upsert",
    "watermark",
    "watermark_slice",
]
