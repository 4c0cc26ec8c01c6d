"""Scan of archived run-result documents: one JSON file per run folder."""

from __future__ import annotations

import uuid
from datetime import UTC, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.plans.keyed import scratch_path
from evenkeel.sources.tables import TableMissing, TableStore

# File name, fields of a document, and the command shown when a document names none.
FILE_NAME = "run_results.json"
DEFAULT_COMMAND = "dbt"
DOCUMENT = "metadata STRING, elapsed_time STRING, args STRING, results STRING"
RUN_COLUMNS = [
    "run",
    "run_label",
    "modified_at",
    "generated_at",
    "tool_version",
    "invocation_id",
    "command",
    "elapsed_time",
]
_BROKEN = "_ek_broken"
_OPTIONS = {"columnNameOfCorruptRecord": _BROKEN}


def run_label(folder: Column) -> Column:
    """'20250305_143022' -> '2025-03-05 14:30:22'; other folder names stay as they are."""
    stamped = F.regexp_replace(
        folder, "^(.{4})(.{2})(.{2})_(.{2})(.{2})(.{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return F.when(F.length(folder) == 15, stamped).otherwise(folder)


def _field(document: str, *path: str) -> Column:
    """Text of a field of a JSON text; null where a step is absent or no object."""
    return F.get_json_object(document, "$." + ".".join(path))


def _number(text: Column, kind: str) -> Column:
    """A number, also one written as text or with a fraction of zero; null for anything else."""
    exact = text.try_cast("double")
    return exact if kind == "double" else exact.try_cast(kind)


def _documents(spark: SparkSession, reports: str, *columns: Column, **options: str) -> DataFrame:
    """``run``, ``modified_at`` and the columns asked for, one row per file; without the text only metadata is read."""
    files = spark.read.options(**options).text(f"{reports.rstrip('/')}/*/{FILE_NAME}", wholetext=True)
    return files.select(
        F.element_at(F.split("_metadata.file_path", "/"), -2).alias("run"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        *columns,
    )


def read_run_results(spark: SparkSession, reports: str) -> DataFrame:
    """Node rows of every ``<reports>/<run folder>/run_results.json``, as :func:`parse_run_results` makes them.

    A document is as large as one run's node list, so a whole file per task is bounded; runs spread over tasks.
    """
    return parse_run_results(_documents(spark, reports, F.col("value").alias("text")))


# The ledger names the documents that were read, and the batch that their nodes were stored in.
LEDGER_LOG = "run_document_ledger"
NODE_LOG = "run_result_nodes"
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
    ]
)


def update_run_archive(store: TableStore, reports: str, late_seconds: int = 86_400) -> int:
    """Read the documents that are new or were written again since the last call; returns how many there were.

    Their nodes are stored as Parquet, so that summaries over all runs never parse a document twice. Files changed more
    than ``late_seconds`` before the newest known one are not looked at; the others are held against the ledger. The
    ledger is written last: nodes of a call that failed on the way are never shown, and its documents are read again.
    """
    spark = store.spark
    store.ensure_log(LEDGER_LOG, LEDGER_SCHEMA)
    ledger = store.read_log(LEDGER_LOG, LEDGER_SCHEMA)
    newest = ledger.agg(F.max("modified_at").alias("at")).first().at
    options = {}
    if newest is not None:
        # Driver-side datetimes are in the machine's zone; the option is read in the zone that is named.
        bound = newest.astimezone(UTC) - timedelta(seconds=late_seconds + 1)
        options = {"modifiedAfter": f"{bound:%Y-%m-%dT%H:%M:%S}", "timeZone": "UTC"}
    batch, same = uuid.uuid4().hex, ["run", "modified_at"]
    path = scratch_path(spark, "run-documents")
    _documents(spark, reports, **options).join(ledger, same, "left_anti").write.parquet(path)
    found = spark.read.parquet(path)
    count = found.count()
    if count:
        # A document written again in the meantime has another time; the next call reads it.
        texts = _documents(spark, reports, F.col("value").alias("text"), **options).join(found, same, "left_semi")
        nodes = parse_run_results(texts).select(F.lit(batch).alias("batch"), "*")
        store.append_log(NODE_LOG, nodes, batch)
        store.append_log(LEDGER_LOG, found.select(F.lit(batch).alias("batch"), *same), batch)
    return count


def read_run_archive(store: TableStore) -> DataFrame:
    """Node rows of the latest version of every document that :func:`update_run_archive` has read."""
    ledger = store.read_log(LEDGER_LOG, LEDGER_SCHEMA)
    latest = ledger.groupBy("run").agg(F.max("modified_at").alias("modified_at"), F.max_by("batch", "modified_at").alias("batch"))
    try:
        nodes = store.read_log(NODE_LOG)
    except TableMissing:
        nodes = parse_run_results(store.spark.createDataFrame([], "run string, modified_at timestamp, text string"))
        nodes = nodes.select(F.lit("").alias("batch"), "*")
    return nodes.join(latest, ["batch", "run", "modified_at"], "left_semi").drop("batch")


def parse_run_results(documents: DataFrame) -> DataFrame:
    """Node rows of documents given as ``run``, ``modified_at`` and ``text``; texts that are not JSON are skipped.

    A field of another type than expected never costs the row: numbers may be text, objects may be absent or text. A run
    without results keeps one row with null node columns.
    """
    read = F.from_json("text", f"{DOCUMENT}, {_BROKEN} STRING", _OPTIONS)
    documents = (
        documents.select("run", "modified_at", read.alias("_ek_read"))
        .where(f"_ek_read is not null and _ek_read.{_BROKEN} is null")
        .select("run", "modified_at", "_ek_read.*")
    )
    invoked, which = _field("args", "invocation_command"), _field("args", "which")
    command = F.coalesce(F.when(F.length(invoked) > 0, invoked), F.when(F.length(which) > 0, which), F.lit(DEFAULT_COMMAND))
    words = F.from_json(command, "array<string>")
    affected = F.coalesce(_field("node", "adapter_response", "rows_affected"), _field("node", "rows_affected"))
    return documents.select(
        "run",
        run_label(F.col("run")).alias("run_label"),
        "modified_at",
        _field("metadata", "generated_at").alias("generated_at"),
        _field("metadata", "dbt_version").alias("tool_version"),
        _field("metadata", "invocation_id").alias("invocation_id"),
        F.when(command.startswith("["), F.concat_ws(" ", words)).otherwise(command).alias("command"),
        _number(F.col("elapsed_time"), "double").alias("elapsed_time"),
        F.explode_outer(F.from_json("results", "array<string>")).alias("node"),
    ).select(
        *RUN_COLUMNS,
        _field("node", "unique_id").alias("unique_id"),
        _field("node", "status").alias("status"),
        _number(_field("node", "execution_time"), "double").alias("execution_time"),
        _number(affected, "bigint").alias("rows_affected"),
        _number(_field("node", "failures"), "bigint").alias("failures"),
        F.coalesce(_field("node", "message"), F.lit("")).alias("message"),
        F.coalesce(_field("node", "relation_name"), F.lit("")).alias("relation_name"),
    )


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("modified_at").desc(), F.col("run").desc())
