"""One-row summaries of keys and of comparison results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import key_list
from evenkeel.functions.hashing import key_digest, plain_columns
from evenkeel.operators import delta_compare as delta
from evenkeel.operators import full_compare as full


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def key_stats(df: DataFrame, key_columns: str | Sequence[str]) -> DataFrame:
    """Keys found once, keys found more often, and the rows of the latter."""
    keys = key_list(key_columns, "key_stats")
    first, second = key_digest(df, keys, plain_columns(df, df, keys))
    counts = (
        df.selectExpr(f"{first} as k1", f"{second} as k2")
        .groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    repeated = F.col("n") > 1
    return counts.agg(
        _count(F.col("n") == 1).alias("unique_keys_count"),
        _count(repeated).alias("duplicate_groups_count"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("duplicate_rows_count"),
    )


def real_anomalies(rows: DataFrame) -> DataFrame:
    """Without the rows that are only for information."""
    info = [full.DUPLICATE_IN_SOURCE + full.INFO_SUFFIX, full.DUPLICATE_IN_TARGET + full.INFO_SUFFIX]
    return rows.where(~F.col("anomaly_type").isin(info))


def anomaly_tally(rows: DataFrame) -> DataFrame:
    """Counts per anomaly type of full-compare rows; informational rows do not count in the total."""
    kind = F.col("anomaly_type")
    source_kinds = [full.DUPLICATE_IN_SOURCE, full.DUPLICATE_IN_SOURCE + full.INFO_SUFFIX]
    target_kinds = [full.DUPLICATE_IN_TARGET, full.DUPLICATE_IN_TARGET + full.INFO_SUFFIX]
    return rows.agg(
        _count(~kind.isin(source_kinds[1], target_kinds[1])).alias("total_anomalies_count"),
        _count(kind == full.MISSING_IN_TARGET).alias("missing_in_target_count"),
        _count(kind == full.MISSING_IN_SOURCE).alias("missing_in_source_count"),
        _count(kind == full.VALUE_MISMATCH).alias("value_mismatch_count"),
        _count(kind.isin(source_kinds)).alias("source_duplicate_count"),
        _count(kind.isin(target_kinds)).alias("target_duplicate_count"),
    )


def delta_tally(rows: DataFrame) -> DataFrame:
    """Counts of delta-compare rows."""
    return rows.agg(
        F.count(F.lit(1)).alias("total_anomalies_count"),
        _count(F.col("change_type") == delta.NEW).alias("delta_new_count"),
        _count(F.col("change_type") == delta.UPDATED).alias("delta_updated_count"),
    )


def delete_tally(rows: DataFrame) -> DataFrame:
    """Number of hard-deleted rows."""
    return rows.agg(F.count(F.lit(1)).alias("total_deletes_count"))
