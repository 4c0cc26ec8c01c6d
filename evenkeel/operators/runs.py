"""Summaries over archived run results: one input row per executed node."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The statuses that are counted, and those that make a run fail.
COUNTED_STATUSES = ["success", "pass", "fail", "error", "skip"]
FAILED_STATUSES = ["fail", "error"]
# Limits of the display-name rule.
LONGEST_NAME = 48
CUT_NAME = 45
SHORT_HASH = (6, 16)
LONG_HASH = 32


def node_type(unique_id: Column) -> Column:
    """First part of a dotted id."""
    return F.when(F.coalesce(unique_id, F.lit("")) == "", "unknown").otherwise(F.split(unique_id, "\\.")[0])


def node_name(unique_id: Column) -> Column:
    """Readable part of a dotted id: the last part, or the one before it where the last looks like a hash.

    Ids of fewer than three parts stay as they are; long names are cut.
    """
    parts = F.split(unique_id, "\\.")
    count = F.size(parts)
    last = F.element_at(parts, -1)
    letters = F.replace(last, F.lit("_"), F.lit("")).rlike("^[\\p{L}\\p{N}]+$")
    hashed = letters & (F.length(last).between(*SHORT_HASH) | (F.length(last) >= LONG_HASH))
    name = F.when((count > 3) & hashed, F.element_at(parts, -2)).otherwise(last)
    cut = F.concat(F.substring(name, 1, CUT_NAME), F.lit("..."))
    shown = F.when(F.length(name) > LONGEST_NAME, cut).otherwise(name)
    return F.when(count >= 3, shown).otherwise(unique_id)


def _tenths(seconds: Column) -> Column:
    """Seconds in tenths, rounded by the exact binary value, ties to the even digit."""
    whole = F.floor(seconds)
    scaled = ((seconds - whole) * float(1 << 58)).cast("long") * 10
    digit = F.shiftright(scaled, 58)
    rest, half = scaled.bitwiseAND(F.lit((1 << 58) - 1)), F.lit(1 << 57)
    up = (rest > half) | ((rest == half) & (digit % 2 == 1))
    return whole * 10 + digit + up.cast("long")


def duration_text(seconds: Column) -> Column:
    """'—' without a duration, '12.3s' below a minute, '2m 5.0s' from there on."""
    seconds = seconds.cast("double")
    minutes = F.floor(seconds / 60).cast("long")
    tenths = _tenths(F.when(seconds < 60, seconds).otherwise(seconds - minutes * 60))
    rest = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("s"))
    return (
        F.when(seconds.isNull() | (seconds < 0), "—")
        .when(seconds < 60, rest)
        .otherwise(F.concat(minutes.cast("string"), F.lit("m "), rest))
    )


def describe_nodes(nodes: DataFrame) -> DataFrame:
    """Add display name, node type and lower-case status to node rows (``unique_id``, ``status``, …)."""
    unique_id = F.coalesce("unique_id", F.lit(""))
    return nodes.select(
        *[c for c in nodes.columns if c not in ("unique_id", "status")],
        unique_id.alias("unique_id"),
        node_name(unique_id).alias("name"),
        node_type(unique_id).alias("type"),
        F.when(F.coalesce("status", F.lit("")) == "", "unknown").otherwise(F.lower("status")).alias("status"),
    )


def status_summary(nodes: DataFrame, run_columns: list[str]) -> DataFrame:
    """Per run: nodes per counted status, all nodes, and whether none failed.

    Rows without a node (``unique_id`` and ``status`` null) keep a run without results in the summary.
    """
    status = F.lower(F.coalesce("status", F.lit("")))
    counts = [F.count_if(status == s).alias(f"{s}_count") for s in COUNTED_STATUSES]
    present = F.col("unique_id").isNotNull() | F.col("status").isNotNull()
    summary = nodes.groupBy(*run_columns).agg(*counts, F.count_if(present).alias("total_nodes"))
    failures = sum((F.col(f"{s}_count") for s in FAILED_STATUSES), F.lit(0))
    return summary.withColumn("overall_success", failures == 0)


def failed_nodes(nodes: DataFrame) -> DataFrame:
    """Described node rows that failed."""
    return describe_nodes(nodes).where(F.col("status").isin(FAILED_STATUSES))


def top_durations(nodes: DataFrame, run_columns: list[str], limit: int = 10) -> DataFrame:
    """The longest-running nodes of each run, with their rank; ties go to the smaller id.

    Spark keeps only ``limit`` rows per run in every task before it shuffles, so one huge run is no hot spot.
    """
    seconds = F.coalesce(F.col("execution_time"), F.lit(0.0))
    order = Window.partitionBy(*run_columns).orderBy(seconds.desc(), F.col("unique_id"))
    ranked = describe_nodes(nodes).withColumn("duration_rank", F.row_number().over(order))
    return ranked.where(F.col("duration_rank") <= limit).withColumn("duration", duration_text(F.col("execution_time")))
