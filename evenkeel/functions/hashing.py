"""Text hashes of keys and rows, as SQL expressions.

Rows are compared through a text form of their columns. The published hash columns are md5 of that text; the
comparisons themselves use two 64-bit numbers that agree exactly where the texts do, because numeric buffers keep
Spark on HashAggregate and make the shuffled rows narrow.

The functions return expression text for ``selectExpr``: a wide table's expression is then handed to Spark at once
instead of function by function.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from evenkeel.functions.columns import column_type, quoted

# The separator and the tokens that stand for null.
SEPARATOR = "|"
NULL_VALUE = "NULL"
NULL_KEY = "___NULL_KEY___"

# Types whose text form is different for every different value and never holds the separator.
_PLAIN_TYPES = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.DateType,
    T.TimestampNTZType,
)


def _text(column: str, null_token: str) -> str:
    return f"coalesce(cast({quoted(column)} as string), '{null_token}')"


def _joined(columns: Iterable[str], null_token: str) -> str:
    return f"concat_ws('{SEPARATOR}', {', '.join(_text(c, null_token) for c in columns)})"


def row_hash(columns: list[str]) -> str:
    """md5 of the row text; null when there is nothing to compare."""
    return f"md5({_joined(columns, NULL_VALUE)})" if columns else "cast(null as string)"


def key_hash(columns: list[str]) -> str:
    return f"md5({_joined(columns, NULL_KEY)})"


def plain_columns(left: DataFrame, right: DataFrame, columns: Iterable[str]) -> set[str]:
    """Columns that can be compared by value instead of by text: same type on both sides, and a plain one."""
    return {
        c
        for c in columns
        if isinstance(column_type(left, c), _PLAIN_TYPES) and column_type(left, c) == column_type(right, c)
    }


def exact_type(data_type: T.DataType) -> bool:
    """Whether two values of a plain type are equal exactly where their texts are (-0.0 and 0.0 are not)."""
    return isinstance(data_type, _PLAIN_TYPES) and not isinstance(data_type, (T.FloatType, T.DoubleType))


def _value(df: DataFrame, column: str) -> str:
    """What to hash for a plain column. The hash function skips nulls and takes -0.0 for 0.0; their texts differ."""
    value = quoted(column)
    if isinstance(column_type(df, column), (T.FloatType, T.DoubleType)):
        return f"isnull({value}), {value}, case when {value} = 0 then cast({value} as string) end"
    return f"isnull({value}), {value}"


def _digest(df: DataFrame, columns: list[str], plain: set[str], null_token: str) -> tuple[str, str]:
    """128 bits (two bigints) that agree exactly where the joined texts of the columns agree.

    Joining matters only where a text column holds the separator; other rows are hashed column by column, plain
    columns by value, which saves most of the casts to text. Rows with and without a separator inside a column
    have a different number of separators, so they never have equal texts.
    """
    texts = {c: _text(c, null_token) for c in columns if c not in plain}
    parts = ", ".join(texts[c] if c in texts else _value(df, c) for c in columns)

    def half(seed: int) -> str:
        by_column = f"xxhash64({seed}, {parts})"
        if not texts or len(columns) == 1:
            return by_column
        holds_separator = " or ".join(f"contains({text}, '{SEPARATOR}')" for text in texts.values())
        by_text = f"xxhash64({seed}, {_joined(columns, null_token)})"
        return f"case when {holds_separator} then {by_text} else {by_column} end"

    return half(1), half(2)


def key_digest(df: DataFrame, keys: list[str], plain: set[str]) -> tuple[str, str]:
    return _digest(df, keys, plain, NULL_KEY)


def row_digest(df: DataFrame, columns: list[str], plain: set[str]) -> tuple[str, str]:
    return _digest(df, columns, plain, NULL_VALUE) if columns else ("0L", "0L")


def _holds_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _holds_map(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_holds_map(f.dataType) for f in data_type.fields)
    return isinstance(data_type, (T.MapType, T.VariantType))


def _typed_value(df: DataFrame, column: str) -> str:
    """What to hash for a column of any type. The hash function skips nulls inside nested values and takes no maps,
    so nested values go in as JSON as well; a map is a list of entries in key order."""
    value, data_type = quoted(column), column_type(df, column)
    if not isinstance(data_type, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return value
    is_map = isinstance(data_type, T.MapType) and not _holds_map(data_type.valueType)
    if is_map:
        value = f"array_sort(map_entries({value}))"
    text = f"to_json(named_struct('v', {value}), map('ignoreNullFields', 'false'))"
    return f"{value}, {text}" if is_map or not _holds_map(data_type) else text


def value_digest(df: DataFrame, columns: list[str]) -> tuple[str, str]:
    """Digest of the typed values: equal exactly where every column is null-safe equal."""
    parts = "".join(f", isnull({quoted(c)}), {_typed_value(df, c)}" for c in columns)
    return f"xxhash64(1{parts})", f"xxhash64(2{parts})"
