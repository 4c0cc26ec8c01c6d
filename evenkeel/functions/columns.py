"""Helpers for key lists, compare-column lists and schema checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as it is written in an SQL expression, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A text constant as it is written in an SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ref(name: str) -> Column:
    """Column by its literal name."""
    return F.col(quoted(name))


def key_list(key_columns: str | Sequence[str] | None, operator: str) -> list[str]:
    """One key name or a list of names -> a non-empty list."""
    keys = [key_columns] if isinstance(key_columns, str) else list(key_columns or [])
    keys = [k for k in keys if k]
    if not keys:
        raise ValueError(f"{operator}: key_columns is required and must not be empty")
    return keys


def non_key_columns(df: DataFrame, keys: Iterable[str], ignore_case: bool = True) -> list[str]:
    """Every column of ``df`` that is not a key, in table order."""
    if ignore_case:
        skip = {k.lower() for k in keys}
        return [c for c in df.columns if c.lower() not in skip]
    skip = set(keys)
    return [c for c in df.columns if c not in skip]


def sorted_columns(columns: Iterable[str]) -> list[str]:
    """A stable, case-insensitive order, so that a hash survives a table rebuild."""
    return sorted(columns, key=str.lower)


def split_names_col(text: Column) -> Column:
    """'a, b,,c ' -> ['a', 'b', 'c']; all white space around a name goes; null text gives an empty array."""
    parts = F.transform(F.split(text, ","), lambda part: F.regexp_replace(part, r"^\s+|\s+$", ""))
    return F.coalesce(F.filter(parts, lambda p: F.length(p) > 0), F.array().cast("array<string>"))


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Declared type of a column, found the way Spark resolves names: ignoring case."""
    for field in df.schema:
        if field.name.lower() == name.lower():
            return field.dataType
    raise ValueError(f"column {name!r} is absent; there are {df.columns}")


def all_set(columns: Iterable[str]) -> str:
    return "(" + " and ".join(f"{quoted(c)} is not null" for c in columns) + ")"


def any_null(columns: Iterable[str]) -> str:
    return "(" + " or ".join(f"{quoted(c)} is null" for c in columns) + ")"


def require_same_types(left: DataFrame, right: DataFrame, columns: Iterable[str], operator: str) -> None:
    """Refuse to compare columns whose declared types differ."""
    for name in columns:
        one, other = column_type(left, name), column_type(right, name)
        if one != other:
            raise ValueError(
                f"{operator}: column {name!r} has type {one.simpleString()} on one side "
                f"and {other.simpleString()} on the other"
            )


def orderable(data_type: T.DataType) -> bool:
    """Whether values of this type can be compared by order."""
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))
