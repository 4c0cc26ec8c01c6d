"""Rows of a snapshot whose key is gone from the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import (
    all_set,
    any_null,
    column_type,
    key_list,
    non_key_columns,
    quoted,
    require_same_types,
    sorted_columns,
    text_literal,
)
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits, fetch, key_bytes, max_where, nothing, pin, sum_where

# Fixed value: the change name.
HARD_DELETED = "HARD_DELETED"


@dataclass(frozen=True)
class DeleteComparison:
    """Deleted rows (lazy) and the counts measured while finding them."""

    rows: DataFrame
    stats: dict[str, int]


def compare_deletes(
    target: DataFrame,
    before: DataFrame,
    key_columns: str | Sequence[str],
    compare_columns: Sequence[str] | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DeleteComparison:
    """Like :func:`hard_delete_compare`, and also returns the number of deleted rows."""
    keys = key_list(key_columns, "hard_delete_compare")
    columns = sorted_columns(compare_columns or non_key_columns(before, keys))
    require_same_types(before, target, keys, "hard_delete_compare")
    key_names = [quoted(k) for k in keys]

    before_keys = before.selectExpr(*key_names, "1 as _ek_b", "0 as _ek_t")
    target_keys = target.where(all_set(keys)).selectExpr(*key_names, "0 as _ek_b", "1 as _ek_t")
    profile = (
        before_keys.unionByName(target_keys)
        .groupBy(*key_names)
        .agg(F.expr("sum(_ek_b) as _ek_n_b"), F.expr("sum(_ek_t) as _ek_n_t"))
    )
    # Keys with a null part never equal anything, so all their snapshot rows are reported.
    gone = f"_ek_n_b > 0 and _ek_n_t = 0 and {all_set(keys)}"
    picked, stats = pin(
        profile,
        keep=gone,
        stats={
            "before_rows": "sum(_ek_n_b)",
            "null_key_rows": sum_where(any_null(keys), "_ek_n_b"),
            "gone_rows": sum_where(gone, "_ek_n_b"),
            "picked_bytes": sum_where(gone, key_bytes(keys)),
            "heaviest_before": max_where(gone, "_ek_n_b"),
        },
        label="hard-delete",
    )
    stats["total_deletes"] = stats["null_key_rows"] + stats["gone_rows"]

    payload = before.select(*key_names, *[quoted(c) for c in columns])
    found = fetch(
        payload.where(all_set(keys)),
        picked.select(*key_names, "_ek_n_b"),
        keys,
        "_ek_n_b",
        stats["picked_bytes"],
        stats["heaviest_before"],
        stats["before_rows"],
        limits,
    ).drop("_ek_n_b")
    if stats["gone_rows"] == 0:
        found = nothing(found)
    if stats["null_key_rows"]:
        found = found.unionByName(payload.where(any_null(keys)))

    values = []
    for c in columns:
        values.append(f"{quoted(c)} as {quoted(f'before_delta_{c}')}")
        values.append(f"cast(null as {column_type(before, c).simpleString()}) as {quoted(f'after_delta_{c}')}")
    rows = found.selectExpr(
        *key_names,
        f"{text_literal(HARD_DELETED)} as change_type",
        *values,
        f"cast({stats['total_deletes']} as bigint) as total_deletes_count",
    )
    return DeleteComparison(rows, stats)


def hard_delete_compare(target: DataFrame, before: DataFrame, key_columns: str | Sequence[str], **options) -> DataFrame:
    """Every row of ``before`` whose key has no equal key in ``target``.

    Options: ``compare_columns`` (default: all non-key columns of the snapshot), ``limits``.
    """
    return compare_deletes(target, before, key_columns, **options).rows
