"""Run registered queries in Spark and their expected SQL in DuckDB, and compare names, types and values."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

FAMILIES = {
    "tinyint": "integer",
    "smallint": "integer",
    "int": "integer",
    "bigint": "integer",
    "INTEGER": "integer",
    "BIGINT": "integer",
    "float": "double",
    "double": "double",
    "DOUBLE": "double",
    "string": "text",
    "VARCHAR": "text",
    "boolean": "boolean",
    "BOOLEAN": "boolean",
    "timestamp_ntz": "timestamp",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Reasons why the two results are not equal; empty when they are."""
    names = sorted(df.columns)
    spark_types = {f.name: FAMILIES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    spark_rows = Counter(tuple(_value(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    cursor = con.execute(sql)
    sql_types = {d[0]: FAMILIES.get(str(d[1]), str(d[1])) for d in cursor.description}
    if sorted(sql_types) != names:
        return [f"columns: only Spark {sorted(set(names) - set(sql_types))}, only SQL {sorted(set(sql_types) - set(names))}"]
    order = [d[0] for d in cursor.description]
    place = [order.index(n) for n in names]
    sql_rows = Counter(tuple(_value(row[i]) for i in place) for row in cursor.fetchall())
    problems = [f"type of {n}: {spark_types[n]} / {sql_types[n]}" for n in names if spark_types[n] != sql_types[n]]
    if spark_rows != sql_rows:
        problems.append(f"rows: {sum(spark_rows.values())} / {sum(sql_rows.values())}")
        problems.append(f"columns {names}")
        problems += [f"only Spark: {row}" for row in list((spark_rows - sql_rows))[:2]]
        problems += [f"only SQL:   {row}" for row in list((sql_rows - spark_rows))[:2]]
    return problems
