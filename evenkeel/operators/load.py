"""Load strategies over immutable tables: upsert by key, append, delete and insert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import all_set, any_null, column_type, key_list, orderable, quoted, ref, require_same_types
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits, key_bytes, keyed_join, pin


def latest_per_key(batch: DataFrame, key_columns: str | Sequence[str], order_by: str) -> DataFrame:
    """Per key the row with the greatest ``order_by`` (ties: the greatest row); null-key rows all stay.

    Columns without an order (maps) go with the row that is chosen by the others.
    """
    keys = key_list(key_columns, "latest_per_key")
    others = [c for c in batch.columns if c not in keys and c != order_by]
    ordered = [c for c in others if orderable(column_type(batch, c))]
    follow = [c for c in others if c not in ordered]
    rank = F.struct(ref(order_by).alias("by"), *[ref(c).alias(f"c{i}") for i, c in enumerate(ordered)])
    known = batch.where(all_set(keys)).groupBy(*[ref(k) for k in keys])
    if follow:
        rest = F.struct(*[ref(c).alias(f"c{i}") for i, c in enumerate(follow)])
        best = known.agg(F.max(rank).alias("_ek_rank"), F.max_by(rest, rank).alias("_ek_rest"))
    else:
        best = known.agg(F.max(rank).alias("_ek_rank"))
    place = {c: f"_ek_rank.c{i}" for i, c in enumerate(ordered)} | {c: f"_ek_rest.c{i}" for i, c in enumerate(follow)}
    place[order_by] = "_ek_rank.by"
    chosen = [ref(c) if c in keys else F.col(place[c]).alias(c) for c in batch.columns]
    return best.select(*chosen).unionByName(batch.where(any_null(keys)))


def _by_batch_keys(
    target: DataFrame, batch: DataFrame, keys: list[str], operator: str, how: str, unique: bool, limits: Limits
) -> DataFrame:
    """Target rows with set keys that are in the batch (``left_semi``) or not in it (``left_anti``)."""
    require_same_types(target, batch, keys, operator)
    key_names = [quoted(k) for k in keys]
    batch_keys, stats = pin(
        batch.where(all_set(keys)).groupBy(*key_names).agg(F.expr("count(1) as _ek_n")),
        keep="true",
        stats={"bytes": f"sum({key_bytes(keys)})", "repeated": "count_if(_ek_n > 1)"},
        label="batch-keys",
    )
    if unique and stats["repeated"]:
        raise ValueError(f"{operator}: {stats['repeated']} keys occur more than once in the batch")
    batch_keys = batch_keys.select(*key_names)
    if stats["bytes"] <= limits.broadcast_bytes:
        return keyed_join(target, batch_keys, keys, how, stats["bytes"], None, "_ek_n", 1, limits)

    # Too many keys to broadcast: find the target's hot keys, so that their rows can be spread.
    per_slice = limits.rows_per_slice(target.count())
    hot, found = pin(
        target.where(all_set(keys)).groupBy(*key_names).agg(F.expr("count(1) as _ek_n")),
        keep=f"_ek_n > {per_slice}",
        stats={"keys": f"count_if(_ek_n > {per_slice})"},
        label="hot-keys",
    )
    kept = keyed_join(
        target.where(all_set(keys)),
        batch_keys,
        keys,
        how,
        stats["bytes"],
        hot if found["keys"] else None,
        "_ek_n",
        per_slice,
        limits,
    )
    kept = kept.select(*[quoted(c) for c in target.columns])
    return kept.unionByName(target.where(any_null(keys))) if how == "left_anti" else kept


def keys_in(rows: DataFrame, batch: DataFrame, keys: list[str], limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """The rows whose key is in the batch (null keys never are)."""
    return _by_batch_keys(rows, batch, keys, "load", "left_semi", False, limits)


def _untouched(
    target: DataFrame, batch: DataFrame, keys: list[str], operator: str, unique: bool, limits: Limits
) -> DataFrame:
    """Target rows whose key is not in the batch (null keys never are)."""
    return _by_batch_keys(target, batch, keys, operator, "left_anti", unique, limits)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key_columns: str | Sequence[str],
    order_by: str | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """The target after replacing rows whose key is in the batch and adding the batch's other rows.

    A key that occurs twice in the batch is refused, unless ``order_by`` names the column whose greatest
    value wins. Batch rows with a null key part are always added.
    """
    keys = key_list(key_columns, "upsert")
    if order_by is not None:
        batch = latest_per_key(batch, keys, order_by)
    return _untouched(target, batch, keys, "upsert", True, limits).unionByName(batch)


def delete_insert(
    target: DataFrame, batch: DataFrame, key_columns: str | Sequence[str], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Like :func:`upsert`, but repeated batch keys are allowed and all their rows are kept."""
    keys = key_list(key_columns, "delete_insert")
    return _untouched(target, batch, keys, "delete_insert", False, limits).unionByName(batch)


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target with the batch's rows added, matched by column name."""
    return target.unionByName(batch)
