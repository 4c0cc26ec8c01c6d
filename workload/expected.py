"""Expected results as SQL over the test tables.

The comparison statements are built from the rules of the operators (who counts as missing, new, repeated…)
with per-row window counts and EXISTS tests, not from the way Spark runs them.
"""

from __future__ import annotations

from collections.abc import Sequence

from workload import recipes as r

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
ORDER_KEY = ["o_orderkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]


def others(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in keys]


def joined_text(columns: Sequence[str], token: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{token}')" for c in columns)


def row_hash(columns: Sequence[str]) -> str:
    return f"md5({joined_text(columns, 'NULL')})" if columns else "CAST(NULL AS VARCHAR)"


def key_hash(keys: Sequence[str]) -> str:
    return f"md5({joined_text(keys, '___NULL_KEY___')})"


def full_ctes(keys: Sequence[str], columns: Sequence[str], info: str = "") -> str:
    """CTE ``found``: one row per anomaly between the CTEs ``source`` and ``target``."""

    def side(name: str) -> str:
        return (
            f"SELECT *, {key_hash(keys)} AS kh, {row_hash(columns)} AS rh, "
            f"count(*) OVER (PARTITION BY {key_hash(keys)}) AS n FROM {name}"
        )

    def branch(kind: str, text: str, s: str, t: str, own: str, s_count: str, t_count: str, tail: str) -> str:
        picked = [f"{own}.kh AS row_key_hash", *[f"{own}.{k} AS {k}" for k in keys]]
        picked += [f"'{kind}' AS anomaly_type", f"{text} AS anomaly_description"]
        picked += [f"{s}.rh AS source_hash" if s else "NULL AS source_hash"]
        picked += [f"{t}.rh AS target_hash" if t else "NULL AS target_hash"]
        for c in columns:
            picked.append(f"{s}.{c} AS source_{c}" if s else f"NULL AS source_{c}")
            picked.append(f"{t}.{c} AS target_{c}" if t else f"NULL AS target_{c}")
        picked += [f"{s_count} AS source_key_count", f"{t_count} AS target_key_count"]
        return f"SELECT {', '.join(picked)} {tail}"

    absent = "NOT EXISTS (SELECT 1 FROM {0} o WHERE o.kh = {1}.kh)"
    repeated = "'Key appears ' || {0}.n || ' times in {1}; all rows reported for review'"
    branches = [
        branch(
            "MISSING_IN_TARGET", "'Unique key exists in source but not in target'", "a", "", "a", "NULL", "NULL",
            f"FROM s a WHERE a.n = 1 AND {absent.format('t', 'a')}",
        ),
        branch(
            "MISSING_IN_SOURCE", "'Unique key exists in target but not in source'", "", "b", "b", "NULL", "NULL",
            f"FROM t b WHERE b.n = 1 AND {absent.format('s', 'b')}",
        ),
        branch(
            "VALUE_MISMATCH", "'Unique key record values differ between source and target'", "a", "b", "a", "NULL",
            "NULL", "FROM s a JOIN t b ON a.kh = b.kh WHERE a.n = 1 AND b.n = 1 AND a.rh <> b.rh",
        ),
        branch(
            f"DUPLICATE_IN_SOURCE{info}", repeated.format("a", "source"), "a", "", "a", "a.n", "NULL",
            "FROM s a WHERE a.n > 1",
        ),
        branch(
            f"DUPLICATE_IN_TARGET{info}", repeated.format("b", "target"), "", "b", "b", "NULL", "b.n",
            "FROM t b WHERE b.n > 1",
        ),
    ]
    return f"s AS ({side('source')}),\nt AS ({side('target')}),\nfound AS (\n" + "\nUNION ALL\n".join(branches) + "\n)"


def full_sql(
    recipe: str,
    keys: Sequence[str],
    columns: Sequence[str],
    source_name: str,
    target_name: str = "test_query",
    info: str = "",
) -> str:
    return f"""WITH {recipe},
{full_ctes(keys, columns, info)}
SELECT *, CAST(NULL AS BIGINT) AS matched_row_count, '{source_name}' AS source_model,
       '{target_name}' AS target_model, count(*) OVER () AS total_anomalies_count,
       count(*) OVER (PARTITION BY anomaly_type) AS anomaly_type_count
FROM found"""


def delta_ctes(keys: Sequence[str], columns: Sequence[str]) -> str:
    """CTE ``changes``: one row per changed key of ``after_load`` against ``before_load``."""
    columns = sorted(columns)
    key_names = ", ".join(keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)

    def same(one: str, other: str) -> str:
        return " AND ".join(f"{one}.{k} = {other}.{k}" for k in keys)

    def side(name: str) -> str:
        order = ", ".join(["rh", *[f"{c} NULLS FIRST" for c in columns]])
        return (
            f"SELECT *, count(*) OVER (PARTITION BY {key_names}) AS n, "
            f"row_number() OVER (PARTITION BY {key_names} ORDER BY {order}) AS place "
            f"FROM (SELECT *, {row_hash(columns)} AS rh FROM {name} WHERE {known})"
        )

    changed = " || ".join(
        f"CASE WHEN v.{c} IS DISTINCT FROM b.{c} THEN ', {c}' ELSE '' END" for c in columns
    )
    values = ", ".join(f"v.{c} AS after_delta_{c}, b.{c} AS before_delta_{c}" for c in columns)
    return f"""v0 AS ({side('after_load')}),
b0 AS ({side('before_load')}),
pairs AS (
  SELECT {', '.join(f'v.{k} AS {k}' for k in keys)}, count(*) AS m
  FROM v0 v JOIN b0 b ON {same('v', 'b')} AND v.rh = b.rh GROUP BY ALL
),
judged AS (
  SELECT {', '.join(f'v.{k} AS {k}' for k in keys)},
    CASE WHEN b.n IS NULL THEN 'NEW'
         WHEN v.n = 1 AND b.n = 1 THEN CASE WHEN v.rh <> b.rh THEN 'UPDATED' ELSE 'UNCHANGED' END
         WHEN p.m = v.n AND p.m = b.n THEN 'UNCHANGED' ELSE 'UPDATED' END AS change_type,
    CASE WHEN v.n > 1 OR b.n > 1 THEN 'DUPLICATE' ELSE 'UNIQUE' END AS key_classification,
    CASE WHEN b.n IS NULL AND v.n = 1 THEN 'NEW'
         WHEN b.n IS NULL THEN 'NEW (duplicate key)'
         WHEN v.n = 1 AND b.n = 1 THEN substr({changed}, 3)
         WHEN p.m IS NULL THEN 'DUPLICATE KEY — no content match (' || v.n || ' view rows, ' || b.n || ' before rows)'
         ELSE 'DUPLICATE KEY — partial match (' || p.m || ' of ' || v.n || ' view rows matched)' END AS columns_changed,
    v.rh AS after_delta_row_hash, b.rh AS before_delta_row_hash, {values}
  FROM v0 v
  LEFT JOIN b0 b ON {same('v', 'b')} AND b.place = 1
  LEFT JOIN pairs p ON {same('v', 'p')}
  WHERE v.place = 1
),
changes AS (
  SELECT *, count(*) OVER () AS total_changes_count, count(*) OVER (PARTITION BY change_type) AS change_type_count
  FROM judged WHERE change_type <> 'UNCHANGED'
)"""


def delta_sql(recipe: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    return f"WITH {recipe},\n{delta_ctes(keys, columns)}\nSELECT * FROM changes"


def delete_ctes(keys: Sequence[str], columns: Sequence[str], types: dict[str, str]) -> str:
    """CTE ``deleted``: rows of ``before_load`` whose key is not in ``after_load``."""
    values = ", ".join(
        f"b.{c} AS before_delta_{c}, CAST(NULL AS {types[c]}) AS after_delta_{c}" for c in sorted(columns)
    )
    match = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    return f"""deleted AS (
  SELECT {', '.join(f'b.{k}' for k in keys)}, 'HARD_DELETED' AS change_type, {values},
         count(*) OVER () AS total_deletes_count
  FROM before_load b WHERE NOT EXISTS (SELECT 1 FROM after_load a WHERE {match})
)"""


ORDER_TYPES = {
    "o_orderkey": "BIGINT",
    "o_custkey": "BIGINT",
    "o_orderstatus": "VARCHAR",
    "o_totalprice": "DOUBLE",
    "o_orderdate": "TIMESTAMP",
    "o_orderpriority": "VARCHAR",
}


def delete_sql(keys: Sequence[str]) -> str:
    return f"WITH {r.ORDERS_LOAD_SQL},\n{delete_ctes(keys, others(ORDERS, keys), ORDER_TYPES)}\nSELECT * FROM deleted"


def changed_rows_sql(ctes: str, current: str, key: str, columns: Sequence[str]) -> str:
    differs = " OR ".join(f"c.{c} IS DISTINCT FROM b.{c}" for c in columns)
    return f"WITH {ctes}\nSELECT c.* FROM {current} c LEFT JOIN snapshot b ON c.{key} = b.{key} WHERE b.{key} IS NULL OR {differs}"


ANOMALY_COUNTS = """
CAST(count(*) FILTER (anomaly_type NOT LIKE '%_INFO') AS BIGINT) AS total_anomalies_count,
count(*) FILTER (anomaly_type = 'MISSING_IN_TARGET') AS missing_in_target_count,
count(*) FILTER (anomaly_type = 'MISSING_IN_SOURCE') AS missing_in_source_count,
count(*) FILTER (anomaly_type = 'VALUE_MISMATCH') AS value_mismatch_count,
count(*) FILTER (anomaly_type LIKE 'DUPLICATE_IN_SOURCE%') AS source_duplicate_count,
count(*) FILTER (anomaly_type LIKE 'DUPLICATE_IN_TARGET%') AS target_duplicate_count"""
DELTA_COUNTS = """
count(*) AS total_anomalies_count,
count(*) FILTER (change_type = 'NEW') AS delta_new_count,
count(*) FILTER (change_type = 'UPDATED') AS delta_updated_count"""


def key_stats_sql(name: str, keys: Sequence[str]) -> str:
    return f"""SELECT count(*) FILTER (n = 1) AS unique_keys_count, count(*) FILTER (n > 1) AS duplicate_groups_count,
       CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows_count
FROM (SELECT count(*) AS n FROM {name} GROUP BY {key_hash(keys)})"""


SUITE_VALUES = ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"]
SUITE_CTES = f"""{r.ORDERS_PAIR_SQL},
{full_ctes(ORDER_KEY, others(ORDERS, ORDER_KEY))},
{r.ORDERS_LOAD_SQL},
{delta_ctes(ORDER_KEY, SUITE_VALUES)},
{delete_ctes(ORDER_KEY, ['o_custkey', 'o_totalprice'], ORDER_TYPES)},
full_counts AS (SELECT {ANOMALY_COUNTS} FROM found),
key_counts AS ({key_stats_sql('source', ORDER_KEY)}),
delta_counts AS (SELECT {DELTA_COUNTS} FROM changes),
delete_counts AS (SELECT count(*) AS total_anomalies_count FROM deleted),
sizes AS (
  SELECT (SELECT count(*) FROM source) AS n_source, (SELECT count(*) FROM target) AS n_target,
         (SELECT count(*) FROM after_load) AS n_after, (SELECT count(*) FROM before_load) AS n_before
)"""
STATUS = "CASE WHEN total_anomalies_count > 0 THEN 'MISMATCH' ELSE 'MATCH' END AS status"
NO_NUMBER = "CAST(NULL AS BIGINT)"
ZERO = "CAST(0 AS BIGINT)"

SUITE_AUDIT_SQL = f"""WITH {SUITE_CTES}
SELECT 'FULL_LOAD' AS load_type, 'comprehensive_compare' AS test_type, {STATUS}, 'orders_loaded' AS model_name,
       'orders_expected' AS source_model, 'orders_loaded' AS target_model, n_target AS source_row_count,
       {NO_NUMBER} AS target_row_count_before, n_source AS target_row_count_after, n_source AS rows_compared,
       unique_keys_count AS unique_keys_compared, duplicate_groups_count, duplicate_rows_count,
       unique_keys_count - missing_in_target_count - missing_in_source_count - value_mismatch_count AS match_count,
       total_anomalies_count AS anomaly_count, {ZERO} AS delta_new_count, {ZERO} AS delta_updated_count,
       CAST(NULL AS VARCHAR) AS error_message
FROM full_counts, key_counts, sizes
UNION ALL
SELECT 'DELTA', 'delta_compare', {STATUS}, 'orders_delta_slice', 'orders_delta_slice', 'orders', n_after, n_before,
       n_after, n_after, NULL, NULL, NULL, NULL, total_anomalies_count, delta_new_count, delta_updated_count, NULL
FROM delta_counts, sizes
UNION ALL
SELECT 'DELETES', 'hard_delete_check', {STATUS}, 'orders', 'orders', 'orders', n_before, n_before, n_after, n_before,
       n_before, NULL, NULL, n_before - total_anomalies_count, total_anomalies_count, 0, 0, NULL
FROM delete_counts, sizes"""

SUITE_ANOMALIES_SQL = f"""WITH {SUITE_CTES}
SELECT 'FULL_LOAD' AS load_type, 'comprehensive_compare' AS compare_mode, {STATUS}, 'orders_loaded' AS model_name,
       'orders_expected' AS test_query_model, total_anomalies_count, {ZERO} AS delta_new_count,
       {ZERO} AS delta_updated_count, value_mismatch_count, missing_in_target_count, missing_in_source_count,
       {ZERO} AS duplicate_no_match_count, {ZERO} AS duplicate_partial_match_count,
       {ZERO} AS duplicate_full_match_count, source_duplicate_count, target_duplicate_count
FROM full_counts
UNION ALL
SELECT 'DELTA', 'delta_compare', {STATUS}, 'orders_delta_slice', NULL, total_anomalies_count, delta_new_count,
       delta_updated_count, 0, 0, 0, 0, 0, 0, 0, 0
FROM delta_counts
UNION ALL
SELECT 'DELETES', 'hard_delete_check', {STATUS}, 'orders', NULL, total_anomalies_count, 0, 0, 0, total_anomalies_count,
       0, 0, 0, 0, 0, 0
FROM delete_counts"""

SUITE_FULL_SQL = f"""WITH {r.ORDERS_PAIR_SQL},
{full_ctes(ORDER_KEY, others(ORDERS, ORDER_KEY))}
SELECT 'orders_loaded' AS model_name, 'orders_loaded' AS source_model, 'orders_expected' AS target_model, o_orderkey,
       anomaly_type, anomaly_description, source_key_count, target_key_count, CAST(NULL AS BIGINT) AS matched_row_count,
       count(*) OVER () AS total_anomalies_count, count(*) OVER (PARTITION BY anomaly_type) AS anomaly_type_count,
       source_hash, target_hash
FROM found"""

SUITE_CONFIG_SQL = """WITH config AS (
  SELECT 'part_' || p_partkey || CASE WHEN p_size < 20 THEN '_delta_slice' ELSE '' END AS model_name, *
  FROM part
),
lists AS (SELECT p_brand, min(p_type) || '/' || max(p_type) AS listed FROM part GROUP BY p_brand)
SELECT model_name,
       CASE WHEN p_size < 15 THEN 'delta_compare' WHEN p_size < 40 THEN 'comprehensive_compare'
            ELSE 'hard_delete_check' END AS test_type,
       p_brand || '/' || p_type AS key_names,
       CASE WHEN p_size >= 15 THEN model_name || '_source' END AS test_query_model,
       CASE WHEN p_size > 30 THEN replace(p_name, ' ', '/') ELSE listed END AS column_names,
       CASE WHEN p_size = 7 THEN p_type WHEN p_size < 20 THEN 'part_' || p_partkey END AS resolved_base_model,
       CASE WHEN p_size > 45 THEN '_OLD' ELSE '_BEFORE_DELTA' END AS snapshot_suffix,
       CASE WHEN p_size > 25 THEN 'NIGHTLY' WHEN p_size < 15 THEN 'DELTA' ELSE 'FULL_LOAD' END AS load_type
FROM config JOIN lists USING (p_brand)"""

NODE_COLUMNS = "run, unique_id, name, type, status, execution_time, rows_affected"
# Durations are shown with one decimal, halves rounded up.
DURATION = """CASE WHEN execution_time IS NULL OR execution_time < 0 THEN '—'
  WHEN execution_time < 60 THEN printf('%.1fs', execution_time)
  ELSE printf('%dm %.1fs', CAST(floor(execution_time / 60) AS BIGINT),
    execution_time - 60 * CAST(floor(execution_time / 60) AS BIGINT)) END"""

UPSERTED = "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch) UNION ALL SELECT * FROM batch"

MOVED = f"""WITH {r.ORDERS_MOVING_BATCH_SQL}
SELECT *, 'after' AS state, CAST(1 AS INTEGER) AS kept_slots FROM ({UPSERTED})
UNION ALL SELECT *, 'before', 1 FROM orders"""

EXPECTED: dict[str, str] = {
    "full_compare": full_sql(r.ORDERS_PAIR_SQL, ORDER_KEY, others(ORDERS, ORDER_KEY), "orders", "orders_expected"),
    "full_compare_bucketed": full_sql(r.ORDERS_PAIR_SQL, ORDER_KEY, others(ORDERS, ORDER_KEY), "orders", "orders_expected"),
    "full_compare_composite": full_sql(
        r.LINEITEM_PAIR_SQL, LINE_KEY, others(LINEITEM, LINE_KEY), "lineitem", "lineitem_expected"
    ),
    "full_compare_dup_info": full_sql(
        r.ORDERS_NULL_KEYS_SQL, ORDER_KEY, ["o_totalprice", "o_orderstatus"], "orders", info="_INFO"
    ),
    "full_compare_null_keys": full_sql(
        r.ORDERS_NULL_KEYS_SQL, ORDER_KEY, others(ORDERS, ORDER_KEY), "orders", "orders_expected"
    ),
    "full_compare_keys_only": full_sql(r.ORDERS_PAIR_SQL, ORDER_KEY, [], "orders"),
    "anomaly_tally": f"""WITH {r.ORDERS_PAIR_SQL},
{full_ctes(ORDER_KEY, others(ORDERS, ORDER_KEY))}
SELECT {ANOMALY_COUNTS} FROM found""",
    "key_stats": key_stats_sql("lineitem", LINE_KEY),
    "delta_compare": delta_sql(r.ORDERS_LOAD_SQL, ORDER_KEY, others(ORDERS, ORDER_KEY)),
    "delta_compare_composite": delta_sql(
        r.ORDERS_LOAD_SQL, ["o_orderkey", "o_custkey"], others(ORDERS, ["o_orderkey", "o_custkey"])
    ),
    "delta_compare_dups": delta_sql(r.LINEITEM_LOAD_SQL, LINE_KEY, others(LINEITEM, LINE_KEY)),
    "delta_tally": f"""WITH {r.LINEITEM_LOAD_SQL},
{delta_ctes(LINE_KEY, others(LINEITEM, LINE_KEY))}
SELECT {DELTA_COUNTS} FROM changes""",
    "hard_delete_compare": delete_sql(ORDER_KEY),
    "hard_delete_composite": delete_sql(["o_orderkey", "o_custkey"]),
    "delete_tally": f"""WITH {r.ORDERS_LOAD_SQL}
SELECT count(*) AS total_deletes_count FROM before_load
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM after_load)""",
    "stage_customers": f"WITH {r.STAGED_CUSTOMERS_SQL} SELECT * FROM staged",
    "stage_material": f"WITH {r.STAGED_MATERIAL_SQL} SELECT * FROM staged",
    "incremental_read": f"WITH {r.EVENTS_SQL} SELECT * FROM events WHERE ts > (SELECT max(ts) FROM loaded)",
    "incremental_read_buffered": f"""WITH {r.EVENTS_SQL}
SELECT * FROM events WHERE ts > (SELECT max(ts) - INTERVAL 3600 SECOND FROM loaded)""",
    "delta_slice_watermark": f"""WITH {r.EVENTS_SQL}
SELECT * FROM events WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01 00:00:00') FROM loaded)""",
    "delta_source_watermark": f"""WITH {r.STAGED_CUSTOMERS_SQL}
SELECT * FROM staged
WHERE FIVETRANSYNC_DATE > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')""",
    "delta_slice_columns": changed_rows_sql(
        r.PART_PAIR_SQL, "part", "p_partkey", ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    ),
    "delta_source_columns": changed_rows_sql(
        f"{r.STAGED_MATERIAL_SQL},{r.OLDER_MATERIAL_SQL}",
        "staged",
        "M_NBR",
        ["LVL_CD", "M_GRP", "OM_NBR", "M_TP", "T_SH_LF", "M_SH_LF", "BA_UOM", "B_M_IND"],
    ),
    "delta_slice_duplicates": f"""WITH {r.LINEITEM_LOAD_SQL}
SELECT a.* FROM after_load a
WHERE NOT EXISTS (SELECT 1 FROM before_load b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)
   OR EXISTS (
     SELECT 1 FROM before_load b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber
     AND ({' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in others(LINEITEM, LINE_KEY))}))""",
    "upsert_by_key": f"WITH {r.ORDERS_BATCH_SQL} {UPSERTED}",
    "append_load": f"WITH {r.ORDERS_BATCH_SQL} SELECT * FROM orders UNION ALL SELECT * FROM batch",
    "delete_insert_load": f"WITH {r.ORDERS_REPEATED_BATCH_SQL} {UPSERTED}",
    "snapshot_then_upsert": f"""WITH {r.ORDERS_BATCH_SQL}
SELECT *, 'after' AS state FROM ({UPSERTED}) UNION ALL SELECT *, 'before' AS state FROM orders""",
    "upsert_partitioned": MOVED,
    "delete_insert_partitioned": MOVED,
    "append_store": f"""WITH {r.ORDERS_BATCH_SQL}
SELECT *, 'after' AS state FROM (SELECT * FROM orders UNION ALL SELECT * FROM batch)
UNION ALL SELECT *, 'before' AS state FROM orders""",
    "upsert_latest": f"""WITH {r.ORDERS_BATCH_SQL}
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM batch""",
    "suite_after_failure": f"""WITH {SUITE_CTES}
SELECT 'a_orders' AS model_name, 'comprehensive_compare' AS test_type, {STATUS}, n_target AS source_row_count,
       n_source AS rows_compared,
       unique_keys_count - missing_in_target_count - missing_in_source_count - value_mismatch_count AS match_count
FROM full_counts, key_counts, sizes""",
    "suite_interrupted": f"""WITH {SUITE_CTES}
SELECT 'a_orders' AS model_name, 'comprehensive_compare' AS test_type, {STATUS}, n_target AS source_row_count,
       n_source AS rows_compared,
       unique_keys_count - missing_in_target_count - missing_in_source_count - value_mismatch_count AS match_count
FROM full_counts, key_counts, sizes
UNION ALL SELECT 'b_lost', 'comprehensive_compare', 'STARTED', NULL, NULL, NULL""",
    "suite_execution_order": f"""WITH audit AS ({SUITE_AUDIT_SQL})
SELECT CAST(row_number() OVER (ORDER BY model_name, test_type) AS INTEGER) AS test_number, model_name, test_type, anomaly_count
FROM audit""",
    "log_evolution": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderdate END AS o_orderdate
FROM orders""",
    "check_failures_rerun": f"""WITH {r.ORDERS_PAIR_SQL}
SELECT 'first' AS audit_run_id, l_orderkey, l_linenumber, l_partkey, l_tax FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM target WHERE o_orderkey = l_orderkey)
UNION ALL
SELECT 'second', l_orderkey, l_linenumber, l_partkey, l_tax FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM source WHERE o_orderkey = l_orderkey)""",
    "run_documents_scan": f"""WITH {r.RUN_NODES_SQL}
SELECT run, unique_id, status, execution_time, rows_affected, CAST(2.5 AS DOUBLE) AS elapsed_time FROM nodes""",
    "runs_incremental": f"""WITH {r.RUN_NODES_SQL}
SELECT run, unique_id, status, execution_time,
       CAST((SELECT count(DISTINCT run) FROM nodes WHERE run >= '20240116' OR run = '20240105') AS INTEGER) AS second_call,
       CAST(0 AS INTEGER) AS third_call
FROM nodes""",
    "runs_newest_first": """SELECT strftime(ts, '%Y%m%d') AS run, max(ts) AS modified_at, count(*) AS nodes
FROM events GROUP BY 1 ORDER BY modified_at DESC, run DESC LIMIT 10""",
    "suite_config_csv": """SELECT 'part_' || p_partkey AS model_name, 'comprehensive_compare' AS test_type,
       p_brand || '/' || p_type AS key_names, CAST(NULL AS VARCHAR) AS resolved_base_model,
       '_BEFORE_DELTA' AS snapshot_suffix, 'FULL_LOAD' AS load_type
FROM part""",
    "check_failures_stored": f"""WITH {r.ORDERS_PAIR_SQL},
both_runs AS (SELECT 'first' AS audit_run_id, * FROM source UNION ALL SELECT 'second', * FROM target),
repeated AS (
  SELECT audit_run_id, count(*) AS n FROM (
    SELECT audit_run_id, o_orderkey FROM both_runs GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL
)
SELECT audit_run_id, o_orderkey,
       CAST(coalesce(n, 0) * 1000000 + count(*) OVER (PARTITION BY audit_run_id) AS BIGINT) AS counts
FROM both_runs LEFT JOIN repeated USING (audit_run_id) WHERE o_orderstatus IS NULL""",
    "run_documents": f"""WITH {r.RUN_NODES_SQL}
SELECT run || '_' || rows_affected AS run, unique_id, status, execution_time, rows_affected,
       CAST(1.5 AS DOUBLE) AS elapsed_time
FROM nodes WHERE rows_affected % 97 <> 5""",
    "suite_config": SUITE_CONFIG_SQL,
    "validation_suite_audit": SUITE_AUDIT_SQL,
    "validation_suite_anomalies": SUITE_ANOMALIES_SQL,
    "suite_failures_full": SUITE_FULL_SQL,
    "suite_failures_delta": f"""WITH {r.ORDERS_LOAD_SQL},
{delta_ctes(ORDER_KEY, SUITE_VALUES)}
SELECT 'orders_delta_slice' AS model_name, * FROM changes""",
    "suite_failures_delete": f"""WITH {r.ORDERS_LOAD_SQL},
{delete_ctes(ORDER_KEY, ['o_custkey', 'o_totalprice'], ORDER_TYPES)}
SELECT 'orders' AS model_name, * FROM deleted""",
    "run_status_summary": f"""WITH {r.RUN_NODES_SQL}
SELECT run, count(*) FILTER (status = 'success') AS success_count, count(*) FILTER (status = 'pass') AS pass_count,
       count(*) FILTER (status = 'fail') AS fail_count, count(*) FILTER (status = 'error') AS error_count,
       count(*) FILTER (status = 'skip') AS skip_count, count(*) AS total_nodes,
       count(*) FILTER (status IN ('fail', 'error')) = 0 AS overall_success
FROM nodes GROUP BY run""",
    "run_failed_nodes": f"WITH {r.RUN_NODES_SQL} SELECT {NODE_COLUMNS} FROM nodes WHERE status IN ('fail', 'error')",
    "run_top_durations": f"""WITH {r.RUN_NODES_SQL}
SELECT * FROM (
  SELECT {NODE_COLUMNS}, CAST(row_number() OVER (PARTITION BY run ORDER BY execution_time DESC, unique_id) AS INTEGER)
         AS duration_rank, {DURATION} AS duration
  FROM nodes)
WHERE duration_rank <= 10""",
    "check_unique": f"""WITH {r.ORDERS_NULL_KEYS_SQL}
SELECT o_orderkey, count(*) AS n_records FROM target WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "check_not_null": f"WITH {r.ORDERS_PAIR_SQL} SELECT * FROM target WHERE o_orderstatus IS NULL",
    "check_accepted_values": f"""WITH {r.ORDERS_PAIR_SQL}
SELECT o_orderstatus, count(*) AS n_records FROM target WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1""",
    "check_relationships": f"""WITH {r.ORDERS_PAIR_SQL}
SELECT l.* FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = l.l_orderkey)""",
    "check_row_count": f"""WITH {r.LINEITEM_PAIR_SQL}
SELECT * FROM (SELECT (SELECT count(*) FROM source) AS source_rows, (SELECT count(*) FROM target) AS target_rows)
WHERE source_rows <> target_rows""",
    "check_row_tolerance": f"""WITH {r.LINEITEM_PAIR_SQL}
SELECT *, abs(source_rows - target_rows) AS difference
FROM (SELECT (SELECT count(*) FROM source) AS source_rows, (SELECT count(*) FROM target) AS target_rows)
WHERE abs(source_rows - target_rows) > 10""",
    "check_freshness": """SELECT max_loaded_at, age_seconds,
       CASE WHEN age_seconds > 48 * 3600 THEN 'error' WHEN age_seconds > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ts) AS max_loaded_at,
             date_sub('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') AS age_seconds FROM events)""",
}
