"""Classification of a load's rows against the snapshot taken before the load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import (
    all_set,
    column_type,
    key_list,
    non_key_columns,
    orderable,
    quoted,
    require_same_types,
    sorted_columns,
    text_literal,
)
from evenkeel.functions.hashing import plain_columns, row_digest, row_hash
from evenkeel.plans.keyed import DEFAULT_LIMITS, Limits, fetch, key_bytes, max_where, nothing, pin, sum_where

# Change names, key classes and messages.
NEW = "NEW"
UPDATED = "UPDATED"
UNIQUE = "UNIQUE"
DUPLICATE = "DUPLICATE"
NEW_DUPLICATE_TEXT = "NEW (duplicate key)"
NO_MATCH_TEXT = ("DUPLICATE KEY — no content match (", " view rows, ", " before rows)")
PARTIAL_MATCH_TEXT = ("DUPLICATE KEY — partial match (", " of ", " view rows matched)")

# Pair counts can exceed a bigint: one key may hold billions of equal rows on both sides. Contents with at most
# _SMALL rows per side are summed as bigints, the rare others as decimals.
_SMALL = 1 << 20
_TASK_ROWS = 500_000
_WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class DeltaComparison:
    """Changed rows (lazy) and the counts measured while finding them."""

    rows: DataFrame
    stats: dict[str, int]


def _narrow(df: DataFrame, keys: list[str], columns: list[str], plain: set[str], in_view: int) -> DataFrame:
    row1, row2 = row_digest(df, columns, plain)
    return df.selectExpr(
        *[quoted(k) for k in keys], f"{row1} as _ek_r1", f"{row2} as _ek_r2", f"{in_view} as _ek_v", f"{1 - in_view} as _ek_b"
    )


def _profile(view: DataFrame, before: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key: rows on each side, and the xor of all row digests (zero for a 1:1 pair of equal rows).

    One shuffle of a few numbers per row, combined map-side, so a key with many rows meets nobody in one task.
    """
    plain = plain_columns(view, before, columns)
    rows = _narrow(view, keys, columns, plain, 1).unionByName(_narrow(before, keys, columns, plain, 0))
    sums = ["sum(_ek_v) as _ek_n_v", "sum(_ek_b) as _ek_n_b", "bit_xor(_ek_r1) as _ek_x1", "bit_xor(_ek_r2) as _ek_x2"]
    return rows.groupBy(*[quoted(k) for k in keys]).agg(*[F.expr(e) for e in sums])


def _pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: rows on each side and the number of (view row, before row) pairs with equal content.

    Rows are first counted per (key, content), so neither equal copies nor a key with many different contents meet in
    one task; the second step combines those counts map-side before its shuffle. The pairs of frequent contents are
    summed apart, as decimals (null: there are none).
    """
    key_names = [quoted(k) for k in keys]
    contents = rows.groupBy(*key_names, "_ek_r1", "_ek_r2").agg(
        F.expr("sum(_ek_v) as _ek_n_v"), F.expr("sum(_ek_b) as _ek_n_b")
    )
    small = f"_ek_n_v <= {_SMALL} and _ek_n_b <= {_SMALL}"
    product = f"cast(_ek_n_v as {_WIDE}) * cast(_ek_n_b as {_WIDE})"
    return contents.groupBy(*key_names).agg(
        F.expr("sum(_ek_n_v) as _ek_n_v"),
        F.expr("sum(_ek_n_b) as _ek_n_b"),
        F.expr(f"coalesce(sum(case when {small} then _ek_n_v * _ek_n_b end), 0) as _ek_small_pairs"),
        F.expr(f"cast(sum(case when not ({small}) then {product} end) as {_WIDE}) as _ek_large_pairs"),
    )


_ALL_PAIRS = f"(_ek_large_pairs + cast(_ek_small_pairs as {_WIDE}))"
_PAIR_COUNTS = ["_ek_n_v", "_ek_n_b", "_ek_small_pairs", "_ek_large_pairs"]


def _pairs_are(number: str) -> str:
    return f"(case when _ek_large_pairs is null then _ek_small_pairs = {number} else {_ALL_PAIRS} = {number} end)"


def _message(parts: tuple[str, str, str], first: str, second: str) -> str:
    one, two, three = (text_literal(part) for part in parts)
    return f"concat({one}, {first}, {two}, {second}, {three})"


@dataclass
class _Changes:
    """Keys found to be changed, what is known of their sizes, and how to fetch their rows."""

    view: DataFrame
    before: DataFrame
    keys: list[str]
    columns: list[str]
    limits: Limits
    total_rows: dict[str, int]

    def fetch(
        self, name: str, rows: DataFrame, picked: DataFrame, picked_bytes: int, heaviest: int, task_rows: int | None = None
    ) -> DataFrame:
        weight = "_ek_n_v" if name == "view" else "_ek_n_b"
        return fetch(rows, picked, self.keys, weight, picked_bytes, heaviest, self.total_rows[name], self.limits, task_rows)

    def side(self, name: str, prefix: str, columns: list[str]) -> DataFrame:
        df = self.view if name == "view" else self.before
        named = [f"{quoted(c)} as {prefix}{i}" for i, c in enumerate(columns)]
        return df.where(all_set(self.keys)).selectExpr(*[quoted(k) for k in self.keys], *named)

    def pair_counts(self, picked: DataFrame, stats: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
        """Of the repeated keys with rows on both sides, those that count as changed, with their pair counts."""
        plain = plain_columns(self.view, self.before, self.columns)
        sides = [("view", self.view, 1), ("before", self.before, 0)]
        found = [
            self.fetch(
                name,
                _narrow(df.where(all_set(self.keys)), self.keys, self.columns, plain, in_view),
                picked,
                stats["repeated_bytes"],
                stats[f"heaviest_{name}"],
                _TASK_ROWS,
            ).drop("_ek_n_v", "_ek_n_b")
            for name, df, in_view in sides
        ]
        changed = f"(not ({_pairs_are('_ek_n_v')} and {_pairs_are('_ek_n_b')}))" if self.columns else "true"
        return pin(
            _pairs(found[0].unionByName(found[1]), self.keys),
            keep=changed,
            stats={
                "updated": f"count_if({changed})",
                "bytes": sum_where(changed, key_bytes(self.keys)),
                "view": max_where(changed, "_ek_n_v"),
                "before": max_where(changed, "_ek_n_b"),
            },
            label="delta-pairs",
        )

    def lone_rows(self, picked: DataFrame, picked_bytes: int, updated: bool) -> DataFrame:
        """Rows of keys with one row in the view and at most one before, beside each other; nothing is aggregated."""
        key_names = [quoted(k) for k in self.keys]
        after = self.fetch("view", self.side("view", "_ek_v", self.columns), picked, picked_bytes, 1)
        if updated:
            earlier = self.side("before", "_ek_b", self.columns)
            earlier = self.fetch("before", earlier, picked, picked_bytes, 1).drop("_ek_n_v", "_ek_n_b")
            paired = after.join(earlier, self.keys, "left")
        else:
            types = {c: column_type(self.before, c) for c in self.columns}
            empty = [F.lit(None).cast(types[c]).alias(f"_ek_b{i}") for i, c in enumerate(self.columns)]
            paired = after.select("*", *empty)
        values = [f"_ek_{side}{i}" for i in range(len(self.columns)) for side in "vb"]
        hashes = [row_hash([f"_ek_{side}{i}" for i in range(len(self.columns))]) for side in "vb"]
        return paired.selectExpr(
            *key_names,
            "_ek_n_v",
            "_ek_n_b",
            "0L as _ek_small_pairs",
            f"cast(null as {_WIDE}) as _ek_large_pairs",
            f"{hashes[0]} as _ek_v_hash",
            f"case when _ek_n_b > 0 then {hashes[1]} end as _ek_b_hash",
            *values,
        )

    def representatives(self, picked: DataFrame, picked_bytes: int, heaviest: dict[str, int]) -> DataFrame:
        """One row per repeated key: on each side the row with the smallest (hash, columns) stands for all.

        Columns that have no order (maps) follow that row.
        """
        key_names = [quoted(k) for k in self.keys]
        ranked = [i for i, c in enumerate(self.columns) if orderable(column_type(self.view, c))]
        names = [f"_ek_c{i}" for i in range(len(self.columns))]

        def side(name: str) -> DataFrame:
            found = self.fetch(name, self.side(name, "_ek_c", self.columns), picked, picked_bytes, heaviest[name])
            rank = "".join(f", 'c{i}', _ek_c{i}" for i in ranked)
            rest = "".join(f", 'c{i}', _ek_c{i}" for i in range(len(names)) if i not in ranked)
            return found.selectExpr(
                *key_names,
                *_PAIR_COUNTS,
                f"'{name}' as _ek_side",
                f"named_struct('row_hash', {row_hash(names)}{rank}) as _ek_rank",
                f"named_struct('side', '{name}'{rest}) as _ek_rest",
            )

        of = {"v": "case when _ek_side = 'view' then _ek_rank end", "b": "case when _ek_side = 'before' then _ek_rank end"}
        grouped = (
            side("view")
            .unionByName(side("before"))
            .groupBy(*key_names)
            .agg(
                *[F.expr(f"max({c}) as {c}") for c in _PAIR_COUNTS],
                *[F.expr(f"min({rank}) as _ek_{s}_rank") for s, rank in of.items()],
                *[F.expr(f"min_by(_ek_rest, {rank}) as _ek_{s}_rest") for s, rank in of.items()],
            )
        )
        values = [
            f"_ek_{s}_{'rank' if i in ranked else 'rest'}.c{i} as _ek_{s}{i}" for i in range(len(names)) for s in "vb"
        ]
        hashes = [f"_ek_{s}_rank.row_hash as _ek_{s}_hash" for s in "vb"]
        return grouped.selectExpr(*key_names, *_PAIR_COUNTS, *hashes, *values)


def compare_delta(
    view: DataFrame,
    before: DataFrame,
    key_columns: str | Sequence[str],
    compare_columns: Sequence[str] | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DeltaComparison:
    """Like :func:`delta_compare`, and also returns the counts of new and updated keys.

    One shuffle finds new keys and 1:1 pairs that differ. Only keys with several rows on a side and rows on both need
    their contents counted; where there are none, nothing else is shuffled to find the changes.
    """
    keys = key_list(key_columns, "delta_compare")
    columns = sorted_columns(compare_columns or non_key_columns(view, keys))
    require_same_types(view, before, [*keys, *columns], "delta_compare")
    key_names = [quoted(k) for k in keys]

    # Rows with a null key part stay in the profile for the row counts only.
    known = all_set(keys)
    is_new = f"(_ek_n_v > 0 and _ek_n_b = 0 and {known})"
    is_pair = f"(_ek_n_v = 1 and _ek_n_b = 1 and {known} and (_ek_x1 <> 0 or _ek_x2 <> 0))"
    is_repeated = f"(_ek_n_v > 0 and _ek_n_b > 0 and (_ek_n_v > 1 or _ek_n_b > 1) and {known})"
    lone = "(_ek_n_v = 1 and _ek_n_b <= 1)"
    unsure = "(_ek_n_b > 0 and (_ek_n_v > 1 or _ek_n_b > 1))"
    picked, stats = pin(
        _profile(view, before, keys, columns),
        keep=f"({is_new} or {is_pair} or {is_repeated})",
        stats={
            "view_rows": "sum(_ek_n_v)",
            "before_rows": "sum(_ek_n_b)",
            "new": f"count_if{is_new}",
            "new_lone": f"count_if({is_new} and _ek_n_v = 1)",
            "updated": f"count_if{is_pair}",
            "repeated": f"count_if{is_repeated}",
            "lone_bytes": sum_where(f"({is_pair} or ({is_new} and _ek_n_v = 1))", key_bytes(keys)),
            "new_bytes": sum_where(f"({is_new} and _ek_n_v > 1)", key_bytes(keys)),
            "heaviest_new": max_where(is_new, "_ek_n_v"),
            "repeated_bytes": sum_where(is_repeated, key_bytes(keys)),
            "heaviest_view": max_where(is_repeated, "_ek_n_v"),
            "heaviest_before": max_where(is_repeated, "_ek_n_b"),
        },
        label="delta-compare",
    )
    changes = _Changes(view, before, keys, columns, limits, {"view": stats["view_rows"], "before": stats["before_rows"]})
    picked = picked.select(*key_names, "_ek_n_v", "_ek_n_b")
    pairs = stats["updated"]

    # Keys that need a representative: repeated new ones, and repeated ones whose contents differ.
    repeated_new = stats["new"] - stats["new_lone"]
    no_pairs = ["0L as _ek_small_pairs", f"cast(null as {_WIDE}) as _ek_large_pairs"]
    repeated = picked.where("_ek_n_v > 1 and _ek_n_b = 0").selectExpr(*key_names, "_ek_n_v", "_ek_n_b", *no_pairs)
    repeated_bytes, heaviest = stats["new_bytes"], {"view": stats["heaviest_new"], "before": 0}
    if stats["repeated"]:
        judged, found = changes.pair_counts(picked.where(unsure), stats)
        stats["updated"] += found["updated"]
        repeated_bytes += found["bytes"]
        heaviest = {"view": max(heaviest["view"], found["view"]), "before": found["before"]}
        repeated = repeated.unionByName(judged.select(*[quoted(c) for c in repeated.columns])) if repeated_new else judged
    stats["total_changes"] = stats["new"] + stats["updated"]

    parts = []
    if stats["new_lone"] + pairs:
        parts.append(changes.lone_rows(picked.where(lone), stats["lone_bytes"], pairs > 0))
    if repeated_new + stats["updated"] - pairs:
        parts.append(changes.representatives(repeated, repeated_bytes, heaviest))
    found = parts[0] if parts else nothing(changes.lone_rows(picked, 0, False))
    for part in parts[1:]:
        found = found.unionByName(part)

    def same(place: int) -> str:
        one, other = f"_ek_v{place}", f"_ek_b{place}"
        if not orderable(column_type(view, columns[place])):
            one, other = f"cast({one} as string)", f"cast({other} as string)"
        return f"{one} <=> {other}"

    differing = "".join(f", case when not ({same(i)}) then {text_literal(c)} end" for i, c in enumerate(columns))
    no_match = _pairs_are("0") if columns else "true"
    pairs_text = f"case when _ek_large_pairs is null then cast(_ek_small_pairs as string) else cast({_ALL_PAIRS} as string) end"
    texts = (
        f"case when _ek_n_v = 1 and _ek_n_b = 0 then {text_literal(NEW)} when _ek_n_b = 0 then {text_literal(NEW_DUPLICATE_TEXT)} "
        f"when {lone} then concat_ws(', '{differing}) "
        f"when {no_match} then {_message(NO_MATCH_TEXT, '_ek_n_v', '_ek_n_b')} "
        f"else {_message(PARTIAL_MATCH_TEXT, pairs_text, '_ek_n_v')} end"
    )
    values = []
    for i, c in enumerate(columns):
        values += [f"_ek_v{i} as {quoted(f'after_delta_{c}')}", f"_ek_b{i} as {quoted(f'before_delta_{c}')}"]
    rows = found.selectExpr(
        *key_names,
        f"case when _ek_n_b = 0 then {text_literal(NEW)} else {text_literal(UPDATED)} end as change_type",
        f"case when {lone} then {text_literal(UNIQUE)} else {text_literal(DUPLICATE)} end as key_classification",
        f"{texts} as columns_changed",
        "_ek_v_hash as after_delta_row_hash",
        "_ek_b_hash as before_delta_row_hash",
        *values,
        f"cast({stats['total_changes']} as bigint) as total_changes_count",
        f"cast(case when _ek_n_b = 0 then {stats['new']} else {stats['updated']} end as bigint) as change_type_count",
    )
    return DeltaComparison(rows, stats)


def delta_compare(view: DataFrame, before: DataFrame, key_columns: str | Sequence[str], **options) -> DataFrame:
    """One row per key of ``view`` that is new or changed since ``before``.

    Keys are matched with ``=``, so rows with a null key part take no part. A key found more than once on
    either side is judged by how many of its row pairs have equal content, and shown by one representative
    row. Options: ``compare_columns`` (default: all non-key columns), ``limits``.
    """
    return compare_delta(view, before, key_columns, **options).rows
