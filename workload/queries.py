"""One registered query per operator of the survey's work list."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import evenkeel as ek
from evenkeel.operators.staging import CUSTOMER_KEY, MATERIAL_KEY, SYNC_COLUMN
from evenkeel.plans import suite
from evenkeel.plans.keyed import scratch_path
from evenkeel.sources.seeds import TEST_CONFIG_COLUMNS, text_schema
from workload import recipes
from workload.recipes import Query, table

# Output columns that differ from run to run and so cannot be checked against SQL.
VOLATILE = ["detected_at", "run_at", "audit_ts", "audit_run_id", "execution_id", "execution_duration_ms"]
ORDER_KEY = "o_orderkey"
ORDER_COMPOSITE = ["o_orderkey", "o_custkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
ORDER_VALUES = ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"]
FRESHNESS_AS_OF = datetime(2024, 1, 31, 12, 0, 0)


def steady(df: DataFrame) -> DataFrame:
    return df.drop(*VOLATILE)


# -- full comparison -----------------------------------------------------------------------------------------


def full_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.orders_pair(spark, sf_dir)
    return steady(ek.full_compare(source, target, ORDER_KEY, source_name="orders", target_name="orders_expected"))


def full_compare_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.lineitem_pair(spark, sf_dir)
    return steady(ek.full_compare(source, target, LINE_KEY, source_name="lineitem", target_name="lineitem_expected"))


def full_compare_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables written in buckets by their key."""
    source, target = recipes.orders_pair(spark, sf_dir)
    store = ek.TableStore(spark, scratch_path(spark, "store"))
    one = store.write("orders", source, bucket_by=ORDER_KEY, buckets=8)
    two = store.write("orders_expected", target, bucket_by=ORDER_KEY, buckets=8)
    found = ek.full_compare(one, two, ORDER_KEY, source_name="orders", target_name="orders_expected", co_located=True)
    return steady(found)


def full_compare_dup_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.orders_pair(spark, sf_dir, null_keys=True)
    found = ek.full_compare(
        source,
        target,
        ORDER_KEY,
        compare_columns=["o_totalprice", "o_orderstatus"],
        fail_on_duplicates=False,
        source_name="orders",
    )
    return steady(found)


def full_compare_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.orders_pair(spark, sf_dir, null_keys=True)
    return steady(ek.full_compare(source, target, ORDER_KEY, source_name="orders", target_name="orders_expected"))


def full_compare_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.orders_pair(spark, sf_dir)
    found = ek.full_compare(source.select(ORDER_KEY), target.select(ORDER_KEY), ORDER_KEY, source_name="orders")
    return steady(found)


def anomaly_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.orders_pair(spark, sf_dir)
    return ek.anomaly_tally(ek.full_compare(source, target, ORDER_KEY))


def key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.key_stats(table(spark, sf_dir, "lineitem"), LINE_KEY)


# -- change classification, hard deletes ---------------------------------------------------------------------


def delta_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.orders_load(spark, sf_dir)
    return ek.delta_compare(after, before, ORDER_KEY)


def delta_compare_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.orders_load(spark, sf_dir)
    return ek.delta_compare(after, before, ORDER_COMPOSITE)


def delta_compare_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.lineitem_load(spark, sf_dir)
    return ek.delta_compare(after, before, LINE_KEY)


def delta_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.lineitem_load(spark, sf_dir)
    return ek.delta_tally(ek.delta_compare(after, before, LINE_KEY))


def hard_delete_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.orders_load(spark, sf_dir)
    return ek.hard_delete_compare(after, before, ORDER_KEY)


def hard_delete_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.orders_load(spark, sf_dir)
    return ek.hard_delete_compare(after, before, ORDER_COMPOSITE)


def delete_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.orders_load(spark, sf_dir)
    return ek.delete_tally(ek.hard_delete_compare(after, before, ORDER_KEY))


# -- staging, watermarks, slices -----------------------------------------------------------------------------


def stage_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.stage_customers(recipes.raw_customers(spark, sf_dir))


def stage_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.stage_material(recipes.raw_material(spark, sf_dir))


def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, loaded = recipes.events_so_far(spark, sf_dir)
    return ek.incremental_read(events, loaded, "ts")


def incremental_read_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, loaded = recipes.events_so_far(spark, sf_dir)
    return ek.incremental_read(events, loaded, "ts", buffer_seconds=3600)


def delta_slice_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, loaded = recipes.events_so_far(spark, sf_dir)
    return ek.watermark_slice(events, loaded, "ts")


def delta_source_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = ek.stage_customers(recipes.raw_customers(spark, sf_dir))
    orders = table(spark, sf_dir, "orders")
    loaded = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return ek.watermark_slice(staged, loaded.select(F.col("o_orderdate").alias(SYNC_COLUMN)), SYNC_COLUMN)


def delta_slice_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, snapshot = recipes.part_pair(spark, sf_dir)
    return ek.changed_rows(current, snapshot, "p_partkey")


def delta_slice_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, before = recipes.lineitem_load(spark, sf_dir)
    return ek.changed_rows(after, before, LINE_KEY)


def delta_source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = ek.stage_material(recipes.raw_material(spark, sf_dir))
    return ek.changed_rows(staged, recipes.older_material(staged), MATERIAL_KEY)


# -- loads ---------------------------------------------------------------------------------------------------


def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = recipes.orders_batch(spark, sf_dir)
    return ek.upsert(target, batch, ORDER_KEY)


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = recipes.orders_batch(spark, sf_dir)
    return ek.append(target, batch)


def delete_insert_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = recipes.orders_batch(spark, sf_dir, repeats=True)
    return ek.delete_insert(target, batch, ORDER_KEY)


def snapshot_then_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = recipes.orders_batch(spark, sf_dir)
    store = ek.TableStore(spark, scratch_path(spark, "store"))
    store.load("orders", target, ORDER_KEY)
    loaded = store.load("orders", batch, ORDER_KEY)
    snapshot = store.read_snapshot("orders")
    return loaded.withColumn("state", F.lit("after")).unionByName(snapshot.withColumn("state", F.lit("before")))


def _load_partitioned(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    """The table after a load that touches two of three slots, its state before, and how many folders were kept."""
    target, batch = recipes.orders_moving_batch(spark, sf_dir)
    store = ek.TableStore(spark, scratch_path(spark, "store"))
    store.load("orders", target, partition_by="o_orderstatus")
    before = set(store.parts("orders"))
    loaded = store.load("orders", batch, ORDER_KEY, strategy=strategy)
    kept = len(before & set(store.parts("orders")))
    both = loaded.withColumn("state", F.lit("after")).unionByName(store.read_snapshot("orders").withColumn("state", F.lit("before")))
    return both.withColumn("kept_slots", F.lit(kept))


def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_partitioned(spark, sf_dir, "upsert")


def delete_insert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_partitioned(spark, sf_dir, "delete_insert")


def append_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = recipes.orders_batch(spark, sf_dir)
    store = ek.TableStore(spark, scratch_path(spark, "store"))
    store.load("orders", target, ORDER_KEY)
    loaded = store.load("orders", batch, strategy="append")
    snapshot = store.read_snapshot("orders")
    return loaded.withColumn("state", F.lit("after")).unionByName(snapshot.withColumn("state", F.lit("before")))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = recipes.orders_batch(spark, sf_dir, repeats=True)
    later = batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return ek.upsert(target, batch.unionByName(later), ORDER_KEY, order_by="o_totalprice")


# -- validation suite ----------------------------------------------------------------------------------------


def suite_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is read as one configured test, with lists, blanks and gaps made from its columns."""
    part = table(spark, sf_dir, "part")
    size, name, brand, kind = F.col("p_size"), F.col("p_name"), F.col("p_brand"), F.col("p_type")
    model = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"), F.when(size < 20, "_delta_slice").otherwise(""))
    config = part.select(
        model.alias("model_name"),
        F.when(size < 15, "delta_compare").when(size < 40, "comprehensive_compare").otherwise("hard_delete_check").alias("test_type"),
        F.concat(F.lit(" "), brand, F.lit(" ,, "), kind, F.lit(",")).alias("key_column"),
        F.when(size >= 15, F.concat(model, F.lit("_source"))).alias("test_query_model"),
        brand.alias("compare_columns_ref"),
        F.when(size > 30, F.replace(name, F.lit(" "), F.lit(" , "))).alias("compare_columns"),
        F.when(size == 7, kind).otherwise("").alias("base_model"),
        F.when(size > 45, "_OLD").alias("clone_suffix"),
        F.when(size > 25, "NIGHTLY").alias("config_set"),
    )
    lists = part.groupBy(F.col("p_brand").alias("compare_columns_ref")).agg(
        F.concat(F.min("p_type"), F.lit(", "), F.max("p_type"), F.lit(", ")).alias("compare_columns")
    )
    parsed = ek.parse_config(ek.filter_config(config, model_name_like="part\\_%"), lists)
    return parsed.select(
        "model_name",
        "test_type",
        F.array_join("keys", "/").alias("key_names"),
        "test_query_model",
        F.array_join("columns", "/").alias("column_names"),
        "resolved_base_model",
        "snapshot_suffix",
        "load_type",
    )


# The tests of the registered suite.
SUITE_TESTS = [
    ("orders_loaded", suite.FULL, ORDER_KEY, "orders_expected", None, None, None, None, "FULL_LOAD"),
    ("orders_delta_slice", suite.DELTA, ORDER_KEY, None, "order_values", None, None, None, None),
    ("orders", suite.DELETE, ORDER_KEY, None, None, "o_custkey, o_totalprice", "orders", "_BEFORE_DELTA", "DELETES"),
]


def run_orders_suite(spark: SparkSession, sf_dir: str, test_type: str | None = None) -> tuple[ek.TableStore, suite.SuiteRun]:
    """Validate orders after a load: against an expected set, against the snapshot, and for deletions."""
    after, before = recipes.orders_load(spark, sf_dir)
    loaded, expected = recipes.orders_pair(spark, sf_dir)
    store = ek.TableStore(spark, scratch_path(spark, "suite"))
    if test_type != suite.FULL:
        store.load("orders", before, ORDER_KEY)
        store.write("orders", after)
    config = spark.createDataFrame(SUITE_TESTS, text_schema(TEST_CONFIG_COLUMNS))
    lists = spark.createDataFrame(
        [("order_values", ",".join(ORDER_VALUES))], text_schema(["compare_columns_ref", "compare_columns"])
    )
    relations = {"orders_loaded": loaded, "orders_expected": expected, "orders_delta_slice": after}
    return store, ek.run_suite(store, config, relations, lists, test_type=test_type)


def validation_suite_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = run_orders_suite(spark, sf_dir)
    return steady(ek.audit_view(store))


def validation_suite_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = run_orders_suite(spark, sf_dir)
    return steady(ek.anomaly_view(store))


def _suite_failures(spark: SparkSession, sf_dir: str, test_type: str) -> DataFrame:
    store, run = run_orders_suite(spark, sf_dir, test_type)
    (test,) = run.executions
    return steady(ek.failure_view(store, test_type, test["model_name"], test["keys"], test["columns"]))


def suite_failures_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite_failures(spark, sf_dir, suite.FULL)


def suite_failures_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite_failures(spark, sf_dir, suite.DELTA)


def suite_failures_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suite_failures(spark, sf_dir, suite.DELETE)


def suite_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is logged of a run in which the second of three tests fails."""
    source, target = recipes.orders_pair(spark, sf_dir)
    broken = source.withColumn("o_totalprice", F.raise_error(F.lit("source is broken")).cast("double"))
    tests = [(name, suite.FULL, ORDER_KEY, "orders_expected", *[None] * 5) for name in ("a_orders", "b_broken", "c_orders")]
    store = ek.TableStore(spark, scratch_path(spark, "suite"))
    relations = {"a_orders": source, "b_broken": broken, "c_orders": source, "orders_expected": target}
    try:
        ek.run_suite(store, spark.createDataFrame(tests, text_schema(TEST_CONFIG_COLUMNS)), relations, parallel=1)
    except Exception as error:
        if "source is broken" not in str(error):
            raise
    return ek.audit_view(store).select("model_name", "test_type", "status", "source_row_count", "rows_compared", "match_count")


def suite_interrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit view shows of a run whose driver goes away in the second of three tests."""
    source, target = recipes.orders_pair(spark, sf_dir)

    def gone(_: SparkSession) -> DataFrame:
        raise KeyboardInterrupt

    tests = [(name, suite.FULL, ORDER_KEY, "orders_expected", *[None] * 5) for name in ("a_orders", "b_lost", "c_orders")]
    store = ek.TableStore(spark, scratch_path(spark, "suite"))
    relations = {"a_orders": source, "b_lost": gone, "c_orders": source, "orders_expected": target}
    try:
        ek.run_suite(store, spark.createDataFrame(tests, text_schema(TEST_CONFIG_COLUMNS)), relations, parallel=1)
    except KeyboardInterrupt:
        pass
    return ek.audit_view(store).select("model_name", "test_type", "status", "source_row_count", "rows_compared", "match_count")


def suite_execution_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests are numbered by model and type, whatever the configuration's order."""
    store, _ = run_orders_suite(spark, sf_dir)
    number = F.element_at(F.split("execution_id", "_"), -1).cast("int")
    return ek.audit_view(store).select(number.alias("test_number"), "model_name", "test_type", "anomaly_count")


def log_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log whose later appends have more columns than the first, in another order."""
    orders = table(spark, sf_dir, "orders")
    store = ek.TableStore(spark, scratch_path(spark, "log"))
    store.ensure_log("orders_seen", orders.select("o_orderkey", "o_totalprice").schema)
    store.append_log("orders_seen", orders.where("o_orderkey % 3 = 0").select("o_orderkey", "o_totalprice"))
    store.append_log("orders_seen", orders.where("o_orderkey % 3 = 1").select("o_orderstatus", "o_orderkey", "o_totalprice"))
    store.append_log("orders_seen", orders.where("o_orderkey % 3 = 2").select("o_orderkey", "o_orderdate"))
    return store.read_log("orders_seen")


def suite_config_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a line of a configuration file whose columns stand in another order."""
    path = scratch_path(spark, "config")
    table(spark, sf_dir, "part").select(
        F.lit("comprehensive_compare").alias("Test_Type"),
        F.concat(F.lit(" "), "p_brand", F.lit(",\t"), "p_type", F.lit(" ")).alias("KEY_COLUMN"),
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("model_name"),
    ).write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    parsed = ek.parse_config(ek.read_test_config(spark, path))
    return parsed.select(
        "model_name", "test_type", F.array_join("keys", "/").alias("key_names"), "resolved_base_model", "snapshot_suffix", "load_type"
    )


def check_failures_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows of a check in two runs, with the counts that storing them returned."""
    store = ek.TableStore(spark, scratch_path(spark, "checks"))
    stored = F.lit(None).cast("bigint")
    for run, orders in zip(("first", "second"), recipes.orders_pair(spark, sf_dir), strict=True):
        count = ek.store_check_failures(store, "orders_key_unique", ek.check_unique(orders, ORDER_KEY), run)
        store_rows = ek.store_check_failures(store, "orders_status_set", ek.check_not_null(orders, "o_orderstatus"), run)
        stored = F.when(F.col("audit_run_id") == run, F.lit(count * 1_000_000 + store_rows)).otherwise(stored)
    return store.read_log("orders_status_set_failures").select("audit_run_id", ORDER_KEY, stored.cast("bigint").alias("counts"))


def check_failures_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows of a check whose first run was repeated after its table had changed."""
    store = ek.TableStore(spark, scratch_path(spark, "checks"))
    source, target = recipes.orders_pair(spark, sf_dir)
    lines, _ = recipes.lineitem_pair(spark, sf_dir)
    for run, orders in (("first", source.where("o_orderkey % 2 = 0")), ("second", source), ("first", target)):
        failing = ek.check_relationships(lines, "l_orderkey", orders, ORDER_KEY)
        ek.store_check_failures(store, "lines_have_orders", failing, run)
    return store.read_log("lines_have_orders_failures").select("audit_run_id", *LINE_KEY, "l_partkey", "l_tax")


# -- run results ---------------------------------------------------------------------------------------------


def run_status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.status_summary(recipes.run_nodes(spark, sf_dir), ["run"])


def run_failed_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.failed_nodes(recipes.run_nodes(spark, sf_dir))


def run_top_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.top_durations(recipes.run_nodes(spark, sf_dir), ["run"])


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = ek.parse_run_results(recipes.run_documents(spark, sf_dir))
    return nodes.select("run", "unique_id", F.lower("status").alias("status"), "execution_time", "rows_affected", "elapsed_time")


def run_documents_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written to and read from their folders."""
    reports = scratch_path(spark, "reports")
    recipes.write_documents(recipes.daily_documents(spark, sf_dir), reports)
    nodes = ek.read_run_results(spark, reports)
    return nodes.select("run", "unique_id", F.lower("status").alias("status"), "execution_time", "rows_affected", "elapsed_time")


def runs_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive read in two calls: the second finds the new runs and one that was written again."""
    reports, store = scratch_path(spark, "reports"), ek.TableStore(spark, scratch_path(spark, "archive"))
    documents = recipes.daily_documents(spark, sf_dir)
    early = documents.where("run < '20240116'")
    again = F.col("run") == "20240105"
    recipes.write_documents(early.withColumn("text", F.when(again, '{"results": []}').otherwise(F.col("text"))), reports)
    ek.update_run_archive(store, reports)
    recipes.write_documents(documents.where(again | (F.col("run") >= "20240116")), reports)
    found = ek.update_run_archive(store, reports)
    nothing = ek.update_run_archive(store, reports)
    return ek.read_run_archive(store).select(
        "run",
        "unique_id",
        F.lower("status").alias("status"),
        "execution_time",
        F.lit(found).alias("second_call"),
        F.lit(nothing).alias("third_call"),
    )


def runs_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive's page of the ten newest runs."""
    runs = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("run"))
    runs = runs.agg(F.max("ts").alias("modified_at"), F.count(F.lit(1)).alias("nodes"))
    return ek.newest_first(runs).limit(10)


# -- data-quality checks -------------------------------------------------------------------------------------


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = recipes.orders_pair(spark, sf_dir, null_keys=True)
    return ek.check_unique(target, ORDER_KEY)


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = recipes.orders_pair(spark, sf_dir)
    return ek.check_not_null(target, "o_orderstatus")


def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = recipes.orders_pair(spark, sf_dir)
    return ek.check_accepted_values(target, "o_orderstatus", ["O", "F"])


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = recipes.orders_pair(spark, sf_dir)
    return ek.check_relationships(table(spark, sf_dir, "lineitem"), "l_orderkey", target, ORDER_KEY)


def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.lineitem_pair(spark, sf_dir)
    return ek.check_row_count(source, target)


def check_row_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = recipes.lineitem_pair(spark, sf_dir)
    return ek.check_row_tolerance(source, target, 10)


def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ek.check_freshness(table(spark, sf_dir, "events"), "ts", FRESHNESS_AS_OF)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        full_compare,
        full_compare_composite,
        full_compare_bucketed,
        full_compare_dup_info,
        full_compare_null_keys,
        full_compare_keys_only,
        anomaly_tally,
        key_stats,
        delta_compare,
        delta_compare_composite,
        delta_compare_dups,
        delta_tally,
        hard_delete_compare,
        hard_delete_composite,
        delete_tally,
        stage_customers,
        stage_material,
        incremental_read,
        incremental_read_buffered,
        delta_slice_watermark,
        delta_source_watermark,
        delta_slice_columns,
        delta_slice_duplicates,
        delta_source_columns,
        upsert_by_key,
        append_load,
        delete_insert_load,
        snapshot_then_upsert,
        upsert_partitioned,
        delete_insert_partitioned,
        append_store,
        upsert_latest,
        suite_config,
        validation_suite_audit,
        validation_suite_anomalies,
        suite_failures_full,
        suite_failures_delta,
        suite_failures_delete,
        suite_after_failure,
        suite_interrupted,
        suite_execution_order,
        suite_config_csv,
        log_evolution,
        check_failures_stored,
        check_failures_rerun,
        run_documents,
        run_documents_scan,
        runs_incremental,
        runs_newest_first,
        run_status_summary,
        run_failed_nodes,
        run_top_durations,
        check_unique,
        check_not_null,
        check_accepted_values,
        check_relationships,
        check_row_count,
        check_row_tolerance,
        check_freshness,
    )
}
