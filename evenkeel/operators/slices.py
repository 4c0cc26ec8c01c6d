"""The part of a table that a load has brought: by watermark, or by comparing columns with a snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import all_set, any_null, column_type, key_list, non_key_columns, quoted, ref, require_same_types
from evenkeel.functions.hashing import value_digest
from evenkeel.plans.keyed import (
    DEFAULT_LIMITS,
    Limits,
    fetch,
    key_bytes,
    max_where,
    nothing,
    pin,
    sum_where,
)

# Fixed value: the watermark of an empty table.
BEGINNING = "1900-01-01 00:00:00"


def watermark(df: DataFrame, column: str, buffer_seconds: int = 0) -> Column:
    """``max(column) - buffer`` of a table as a scalar subquery, planned into the scan it filters."""
    data_type = column_type(df, column)
    newest = F.coalesce(F.max(ref(column)), F.lit(BEGINNING).cast(data_type))
    if buffer_seconds:
        newest = newest - F.make_dt_interval(secs=F.lit(buffer_seconds))
    return df.select(ref(column)).agg(newest.alias("watermark")).scalar()


def incremental_read(
    source: DataFrame, target: DataFrame | None, column: str, buffer_seconds: int = 0
) -> DataFrame:
    """Source rows newer than the target's watermark; all rows when there is no target yet."""
    if target is None:
        return source
    return source.where(ref(column) > watermark(target, column, buffer_seconds))


def watermark_slice(current: DataFrame, snapshot: DataFrame, column: str) -> DataFrame:
    """Rows of ``current`` newer than anything in ``snapshot``."""
    return current.where(ref(column) > watermark(snapshot, column))


def changed_rows(
    current: DataFrame,
    snapshot: DataFrame,
    key_columns: str | Sequence[str],
    compare_columns: Sequence[str] | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Rows of ``current`` that are new or differ from the snapshot in any compare column.

    Every current row appears at most once, however often its key occurs: it is new when its key is not in the
    snapshot (or is null), and changed when at least one snapshot row of its key differs from it (null-safe). Both
    are decided on digests that the narrow profile keeps per key, so the snapshot is read once and never joined.
    Map columns count as equal when they hold the same entries.
    """
    keys = key_list(key_columns, "changed_rows")
    columns = list(compare_columns or non_key_columns(current, keys))
    require_same_types(current, snapshot, [*keys, *columns], "changed_rows")
    key_names, names = [quoted(k) for k in keys], [quoted(c) for c in columns]
    d1, d2 = value_digest(current, columns)

    def narrow(df: DataFrame, is_current: int) -> DataFrame:
        sides = [f"{is_current} as _ek_c", f"{1 - is_current} as _ek_b"]
        return df.selectExpr(*key_names, f"{d1} as _ek_d1", f"{d2} as _ek_d2", *sides)

    def before(number: str) -> str:
        return f"case when _ek_b = 1 then {number} end"

    profile = (
        narrow(current, 1)
        .unionByName(narrow(snapshot.where(all_set(keys)), 0))
        .groupBy(*key_names)
        .agg(
            F.expr("sum(_ek_c) as _ek_n_c"),
            F.expr("sum(_ek_b) as _ek_n_b"),
            F.expr("min(_ek_d1) = max(_ek_d1) and min(_ek_d2) = max(_ek_d2) as _ek_alike"),
            F.expr(f"min({before('_ek_d1')}) as _ek_b_d1"),
            F.expr(f"min({before('_ek_d2')}) as _ek_b_d2"),
            F.expr(
                f"min({before('_ek_d1')}) = max({before('_ek_d1')}) and min({before('_ek_d2')}) = max({before('_ek_d2')})"
                " as _ek_b_alike"
            ),
        )
    )
    wanted = f"(_ek_n_c > 0 and {all_set(keys)} and (_ek_n_b = 0 or not _ek_alike))"
    picked, stats = pin(
        profile,
        keep=wanted,
        stats={
            "current_rows": "sum(_ek_n_c)",
            "null_key_rows": sum_where(any_null(keys), "_ek_n_c"),
            "picked_keys": f"count_if{wanted}",
            "picked_bytes": sum_where(wanted, key_bytes(keys)),
            "heaviest_current": max_where(wanted, "_ek_n_c"),
        },
        label="changed-rows",
    )
    ours = fetch(
        current.where(all_set(keys)).select(*key_names, *names),
        picked.select(*key_names, "_ek_n_c", "_ek_n_b", "_ek_b_d1", "_ek_b_d2", "_ek_b_alike"),
        keys,
        "_ek_n_c",
        stats["picked_bytes"],
        stats["heaviest_current"],
        stats["current_rows"],
        limits,
    )
    differs = f"_ek_n_b = 0 or not _ek_b_alike or {d1} <> _ek_b_d1 or {d2} <> _ek_b_d2"
    found = ours.where(differs).select(*key_names, *names)
    if stats["picked_keys"] == 0:
        found = nothing(found)
    if stats["null_key_rows"]:
        found = found.unionByName(current.where(any_null(keys)).select(*key_names, *names))
    return found
