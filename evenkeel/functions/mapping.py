"""Reusable value mappings, as functions from Column to Column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sales role names and their codes.
SALES_ROLES = {
    "SALES ASSOCIATE": "SA",
    "ACCOUNT MANAGER": "AM",
    "INSIDE SALES": "IS",
}


def map_values(value: Column, table: Mapping[str, str]) -> Column:
    """Look ``value`` up in a small fixed table; anything else becomes null."""
    result = F.lit(None).cast("string")
    for name, code in reversed(list(table.items())):
        result = F.when(value == name, code).otherwise(result)
    return result


def sales_role(value: Column) -> Column:
    """Role code, ignoring case and surrounding blanks."""
    return map_values(F.trim(F.upper(value)), SALES_ROLES)


def marker(value: Column, expected: str, mark: str = "X", blank: str = " ") -> Column:
    """``mark`` where the value equals ``expected``, else (null included) ``blank``."""
    return F.when(value == expected, mark).otherwise(blank)
