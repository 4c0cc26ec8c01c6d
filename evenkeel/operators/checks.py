"""Data-quality checks. Each returns the failing rows or values; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import all_set, quoted, ref
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits, fetch, key_bytes, max_where, nothing, pin, sum_where


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values found more than once, with their number of rows; nulls are ignored."""
    counts = df.where(ref(column).isNotNull()).groupBy(ref(column)).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.where(ref(column).isNull())


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their number of rows; nulls are ignored."""
    outside = df.where(~ref(column).isin(list(values)))
    return outside.groupBy(ref(column)).agg(F.count(F.lit(1)).alias("n_records"))


def check_relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Child rows whose non-null key has no parent row.

    The keys of both tables are reduced to one row each before they meet, so a key that many children share
    costs no more than any other.
    """
    name = quoted(column)
    child_keys = child.where(all_set([column])).selectExpr(name, "1 as _ek_c", "0 as _ek_p")
    parent_keys = parent.where(all_set([parent_column])).selectExpr(
        f"{quoted(parent_column)} as {name}", "0 as _ek_c", "1 as _ek_p"
    )
    orphaned = "_ek_n_c > 0 and _ek_has_parent = 0"
    orphans, stats = pin(
        child_keys.unionByName(parent_keys)
        .groupBy(name)
        .agg(F.expr("sum(_ek_c) as _ek_n_c"), F.expr("max(_ek_p) as _ek_has_parent")),
        keep=orphaned,
        stats={
            "child_rows": "sum(_ek_n_c)",
            "orphan_rows": sum_where(orphaned, "_ek_n_c"),
            "bytes": sum_where(orphaned, key_bytes([column])),
            "heaviest": max_where(orphaned, "_ek_n_c"),
        },
        label="orphans",
    )
    found = fetch(
        child,
        orphans.select(name, "_ek_n_c"),
        [column],
        "_ek_n_c",
        stats["bytes"],
        stats["heaviest"],
        stats["child_rows"],
        limits,
    ).select(*[quoted(c) for c in child.columns])
    return found if stats["orphan_rows"] else nothing(found)


def _row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both row counts in one row, from one aggregation over both tables."""
    sides = source.select(F.lit(True).alias("s")).unionByName(target.select(F.lit(False).alias("s")))
    return sides.agg(F.count_if(F.col("s")).alias("source_rows"), F.count_if(~F.col("s")).alias("target_rows"))


def check_row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with both counts when they differ."""
    return _row_counts(source, target).where(F.col("source_rows") != F.col("target_rows"))


def check_row_tolerance(source: DataFrame, target: DataFrame, tolerance: int) -> DataFrame:
    """One row with both counts when they differ by more than ``tolerance``."""
    difference = F.abs(F.col("source_rows") - F.col("target_rows"))
    return (
        _row_counts(source, target).withColumn("difference", difference).where(F.col("difference") > tolerance)
    )


def check_freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: datetime,
    warn_after_hours: float | None = 24,
    error_after_hours: float | None = 48,
) -> DataFrame:
    """One row: newest load time, its age at ``as_of`` in seconds, and pass / warn / error.

    A table without any load time is an error.
    """
    newest = df.agg(F.max(ref(loaded_at)).alias("max_loaded_at"))
    age = F.timestamp_diff(
        "SECOND", F.col("max_loaded_at").cast("timestamp_ntz"), F.lit(as_of.isoformat(" ")).cast("timestamp_ntz")
    )
    state = F.when(F.col("age_seconds").isNull(), "error")
    if error_after_hours is not None:
        state = state.when(F.col("age_seconds") > int(error_after_hours * 3600), "error")
    if warn_after_hours is not None:
        state = state.when(F.col("age_seconds") > int(warn_after_hours * 3600), "warn")
    return newest.withColumn("age_seconds", age).withColumn("status", state.otherwise("pass"))
