"""Full reconciliation of two tables by key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import any_null, column_type, key_list, non_key_columns, quoted, text_literal
from evenkeel.functions.hashing import exact_type, key_digest, key_hash, plain_columns, row_digest, row_hash
from evenkeel.plans.keyed import DEFAULT_LIMITS, ROW_OVERHEAD_BYTES, Limits, buckets_as_sorted, fetch, max_where, nothing, pin, sum_where

# Anomaly names and their descriptions.
MISSING_IN_TARGET = "MISSING_IN_TARGET"
MISSING_IN_SOURCE = "MISSING_IN_SOURCE"
VALUE_MISMATCH = "VALUE_MISMATCH"
DUPLICATE_IN_SOURCE = "DUPLICATE_IN_SOURCE"
DUPLICATE_IN_TARGET = "DUPLICATE_IN_TARGET"
INFO_SUFFIX = "_INFO"
MISSING_IN_TARGET_TEXT = "Unique key exists in source but not in target"
MISSING_IN_SOURCE_TEXT = "Unique key exists in target but not in source"
VALUE_MISMATCH_TEXT = "Unique key record values differ between source and target"
DUPLICATE_IN_SOURCE_TEXT = ("Key appears ", " times in source; all rows reported for review")
DUPLICATE_IN_TARGET_TEXT = ("Key appears ", " times in target; all rows reported for review")

_KEY = ["_ek_key1", "_ek_key2"]
_SIDE = "_ek_side"


@dataclass(frozen=True)
class FullComparison:
    """Anomaly rows (lazy) and the counts measured while finding them."""

    rows: DataFrame
    stats: dict[str, int]


def _profile(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], plain: set[str]
) -> DataFrame:
    """Per key: rows on each side, and the xor of all row digests (zero for a 1:1 pair of equal rows).

    Keys whose values are equal exactly where their texts are, are grouped by value, which is narrower than digests.
    """
    by_value = _by_value(source, keys, plain)

    def narrow(df: DataFrame, in_source: int) -> DataFrame:
        key1, key2 = key_digest(df, keys, plain)
        row1, row2 = row_digest(df, columns, plain)
        grouping = [quoted(k) for k in keys] if by_value else [f"{key1} as {_KEY[0]}", f"{key2} as {_KEY[1]}"]
        return df.selectExpr(
            *grouping, f"{in_source} as _ek_s", f"{1 - in_source} as _ek_t", f"{row1} as _ek_r1", f"{row2} as _ek_r2"
        )

    sums = {"n_s": "sum(_ek_s)", "n_t": "sum(_ek_t)", "x1": "bit_xor(_ek_r1)", "x2": "bit_xor(_ek_r2)"}
    rows = narrow(source, 1).unionByName(narrow(target, 0))
    grouped = rows.groupBy(*([quoted(k) for k in keys] if by_value else _KEY))
    found = grouped.agg(*[F.expr(f"{total} as _ek_{name}") for name, total in sums.items()])
    digests = key_digest(found, keys, plain) if by_value else _KEY
    return found.selectExpr(
        *[f"{digest} as {name}" for digest, name in zip(digests, _KEY)], *[f"_ek_{name} as {name}" for name in sums]
    )


def _by_value(source: DataFrame, keys: list[str], plain: set[str]) -> bool:
    return all(k in plain and exact_type(column_type(source, k)) for k in keys)


def _bucketed_profile(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], plain: set[str]
) -> DataFrame:
    """The same for tables in equally many buckets by their keys, which are aggregated and joined where they lie.

    A union would lose the buckets, a null-safe join too; ``null_key`` tells the rows that this join cannot match.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        row1, row2 = row_digest(df, columns, plain)
        rows = df.selectExpr(*[quoted(k) for k in keys], f"{row1} as _ek_r1", f"{row2} as _ek_r2")
        sums = {"n": "count(1)", "x1": "bit_xor(_ek_r1)", "x2": "bit_xor(_ek_r2)"}
        return rows.groupBy(*[quoted(k) for k in keys]).agg(*[F.expr(f"{e} as _ek_{c}_{name}") for c, e in sums.items()])

    found = side(source, "s").join(side(target, "t"), keys, "full")
    key1, key2 = key_digest(found, keys, plain)
    return found.selectExpr(
        f"{key1} as {_KEY[0]}",
        f"{key2} as {_KEY[1]}",
        *[f"coalesce(_ek_n_{side}, 0) as n_{side}" for side in "st"],
        *[f"coalesce(_ek_{x}_s, 0) ^ coalesce(_ek_{x}_t, 0) as {x}" for x in ("x1", "x2")],
        f"{any_null(keys)} as null_key",
    )


def compare_full(
    source: DataFrame,
    target: DataFrame,
    key_columns: str | Sequence[str],
    compare_columns: Sequence[str] | None = None,
    fail_on_duplicates: bool = True,
    source_name: str = "source",
    target_name: str | None = None,
    limits: Limits = DEFAULT_LIMITS,
    co_located: bool = False,
) -> FullComparison:
    """Like :func:`full_compare`, and also returns row counts, key statistics and anomaly counts.

    One job shuffles (key digest, row digest) of both tables once and pins the anomalous keys; the returned
    rows fetch the columns of just those keys.
    """
    keys = key_list(key_columns, "full_compare")
    columns = list(compare_columns or non_key_columns(source, keys, ignore_case=False))
    target_name = target_name or "test_query"
    plain = plain_columns(source, target, [*keys, *columns])

    missing_t = "(n_s = 1 and n_t = 0)"
    missing_s = "(n_s = 0 and n_t = 1)"
    mismatch = "(n_s = 1 and n_t = 1 and (x1 <> 0 or x2 <> 0))"
    anomalous = f"({missing_t} or {missing_s} or {mismatch} or n_s > 1 or n_t > 1)"

    measures = {
        "source_rows": "sum(n_s)",
        "target_rows": "sum(n_t)",
        "unique_keys": "count_if(n_s = 1)",
        "duplicate_groups": "count_if(n_s > 1)",
        "source_duplicates": sum_where("n_s > 1", "n_s"),
        "target_duplicates": sum_where("n_t > 1", "n_t"),
        "missing_in_target": f"count_if{missing_t}",
        "missing_in_source": f"count_if{missing_s}",
        "value_mismatch": f"count_if{mismatch}",
        "picked_keys": f"count_if{anomalous}",
        "heaviest_source": max_where(anomalous, "n_s"),
        "heaviest_target": max_where(anomalous, "n_t"),
    }
    found = None
    if co_located and _by_value(source, keys, plain):
        profile = _bucketed_profile(source, target, keys, columns, plain)
        with buckets_as_sorted(source.sparkSession):
            found = pin(profile, anomalous, measures | {"null_keys": "count_if(null_key)"}, "full-compare")
        if found[1]["null_keys"]:  # null keys match each other, which takes the general way
            found = None
    picked, stats = found or pin(_profile(source, target, keys, columns, plain), anomalous, measures, "full-compare")
    per_type = {
        MISSING_IN_TARGET: stats["missing_in_target"],
        MISSING_IN_SOURCE: stats["missing_in_source"],
        VALUE_MISMATCH: stats["value_mismatch"],
        DUPLICATE_IN_SOURCE: stats["source_duplicates"],
        DUPLICATE_IN_TARGET: stats["target_duplicates"],
    }
    stats["total_anomalies"] = sum(per_type.values())
    picked_bytes = stats["picked_keys"] * ROW_OVERHEAD_BYTES

    pair = "(n_s = 1 and n_t = 1)"
    lone = {"source": "(n_s > 1 or (n_s = 1 and n_t = 0))", "target": "(n_t > 1 or (n_t = 1 and n_s = 0))"}

    def side(df: DataFrame, name: str, wanted: str) -> DataFrame:
        """Rows of one table whose keys meet a condition on the profile."""
        key1, key2 = key_digest(df, keys, plain)
        weight = "n_s" if name == "source" else "n_t"
        payload = [f"{quoted(k)} as _ek_{name}_key{i}" for i, k in enumerate(keys)]
        payload += [f"{quoted(c)} as {quoted(f'{name}_{c}')}" for c in columns]
        found = fetch(
            df.selectExpr(f"{key1} as {_KEY[0]}", f"{key2} as {_KEY[1]}", *payload),
            picked.where(wanted).select(*_KEY, "n_s", "n_t"),
            _KEY,
            weight,
            picked_bytes,
            stats[f"heaviest_{name}"],
            stats[f"{name}_rows"],
            limits,
        )
        # Lone rows get a token that the other side never has: they cannot pair up, and the rows of one hot key
        # do not meet in one partition.
        alone = f"spark_partition_id() * 2 + {int(name == 'source')}"
        return found.selectExpr(
            *_KEY,
            f"case when {pair} then -1 else {alone} end as {_SIDE}",
            f"{weight} as _ek_{name}_rows",
            *[f"_ek_{name}_key{i}" for i in range(len(keys))],
            *[quoted(f"{name}_{c}") for c in columns],
        )

    lone_rows = stats["total_anomalies"] - stats["value_mismatch"]
    if lone_rows > limits.reread_share * (stats["source_rows"] + stats["target_rows"]):
        # Many lone rows: reading the tables once more for the pairs is cheaper than shuffling them all.
        paired = side(source, "source", lone["source"]).unionByName(
            side(target, "target", lone["target"]), allowMissingColumns=True
        )
        if stats["value_mismatch"]:
            pairs = side(source, "source", pair).join(side(target, "target", pair), [*_KEY, _SIDE])
            paired = paired.unionByName(pairs, allowMissingColumns=True)
    else:
        paired = side(source, "source", f"{lone['source']} or {pair}").join(
            side(target, "target", f"{lone['target']} or {pair}"), [*_KEY, _SIDE], "full"
        )
    if stats["picked_keys"] == 0:
        paired = nothing(paired)

    s_keys = [f"_ek_source_key{i}" for i in range(len(keys))]
    t_keys = [f"_ek_target_key{i}" for i in range(len(keys))]
    in_s, in_t = "_ek_source_rows is not null", "_ek_target_rows is not null"
    dup_s, dup_t = "_ek_source_rows > 1", "_ek_target_rows > 1"
    suffix = "" if fail_on_duplicates else INFO_SUFFIX

    def by_kind(mismatch: object, in_source: object, in_target: object, only_source: object, only_target: object) -> str:
        return (
            f"case when {in_s} and {in_t} then {mismatch} when {dup_s} then {in_source} when {dup_t} then {in_target} "
            f"when {in_s} then {only_source} else {only_target} end"
        )

    def repeated(texts: tuple[str, str], count: str) -> str:
        return f"concat({text_literal(texts[0])}, {count}, {text_literal(texts[1])})"

    kind = by_kind(
        text_literal(VALUE_MISMATCH),
        text_literal(DUPLICATE_IN_SOURCE + suffix),
        text_literal(DUPLICATE_IN_TARGET + suffix),
        text_literal(MISSING_IN_TARGET),
        text_literal(MISSING_IN_SOURCE),
    )
    description = by_kind(
        text_literal(VALUE_MISMATCH_TEXT),
        repeated(DUPLICATE_IN_SOURCE_TEXT, "_ek_source_rows"),
        repeated(DUPLICATE_IN_TARGET_TEXT, "_ek_target_rows"),
        text_literal(MISSING_IN_TARGET_TEXT),
        text_literal(MISSING_IN_SOURCE_TEXT),
    )
    kind_count = by_kind(
        per_type[VALUE_MISMATCH],
        per_type[DUPLICATE_IN_SOURCE],
        per_type[DUPLICATE_IN_TARGET],
        per_type[MISSING_IN_TARGET],
        per_type[MISSING_IN_SOURCE],
    )
    rows = paired.selectExpr(
        f"case when {in_s} then {key_hash(s_keys)} else {key_hash(t_keys)} end as row_key_hash",
        *[
            f"case when {in_s} then {s} else {t} end as {quoted(k)}"
            for k, s, t in zip(keys, s_keys, t_keys, strict=True)
        ],
        f"{kind} as anomaly_type",
        f"{description} as anomaly_description",
        f"case when {in_s} then {row_hash([f'source_{c}' for c in columns])} end as source_hash",
        f"case when {in_t} then {row_hash([f'target_{c}' for c in columns])} end as target_hash",
        *[quoted(f"{name}_{c}") for c in columns for name in ("source", "target")],
        f"case when {dup_s} then _ek_source_rows end as source_key_count",
        f"case when {dup_t} then _ek_target_rows end as target_key_count",
        "cast(null as bigint) as matched_row_count",
        "current_timestamp() as detected_at",
        f"{text_literal(source_name)} as source_model",
        f"{text_literal(target_name)} as target_model",
        f"cast({stats['total_anomalies']} as bigint) as total_anomalies_count",
        f"cast({kind_count} as bigint) as anomaly_type_count",
    )
    return FullComparison(rows, stats)


def full_compare(source: DataFrame, target: DataFrame, key_columns: str | Sequence[str], **options) -> DataFrame:
    """Anomaly rows between ``source`` and ``target``.

    A key found once in one table and not at all in the other is missing; a key found once in both is a
    mismatch when the texts of its compare columns differ; every row of a key found more than once in a table
    is a duplicate there. Keys are matched by text, so null keys match each other.

    Options: ``compare_columns`` (default: all non-key columns), ``fail_on_duplicates``, ``source_name``,
    ``target_name``, ``limits``, ``co_located`` (both tables are in equally many buckets by the keys: nothing is shuffled
    to find the anomalies; the result is the same for any tables).
    """
    return compare_full(source, target, key_columns, **options).rows
