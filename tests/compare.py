"""Run a registered query in Spark and its SQL in DuckDB and compare types and values."""

from __future__ import annotations

import glob
import os

import duckdb

# Result types on both sides, as one name each.
_SPARK = {"bigint": "i64", "int": "i32", "double": "f64", "string": "text", "boolean": "bool"}
_DUCK = {"BIGINT": "i64", "INTEGER": "i32", "DOUBLE": "f64", "VARCHAR": "text", "BOOLEAN": "bool"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, connection, sql: str) -> str:
    """Empty when equal, otherwise a description of the difference."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    duck_types = dict(zip(names, [str(d[1]) for d in result.description], strict=True))
    expected_rows = result.fetchall()
    spark_types = dict(df.dtypes)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    for name in names:
        left, right = _SPARK.get(spark_types[name], spark_types[name]), _DUCK.get(duck_types[name], duck_types[name])
        if left != right:
            return f"type of {name}: {spark_types[name]} vs {duck_types[name]}"
    order = sorted(names)
    actual = sorted((tuple(r[c] for c in order) for r in df.collect()), key=_key)
    positions = [names.index(c) for c in order]
    expected = sorted((tuple(r[p] for p in positions) for r in expected_rows), key=_key)
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    return f"{len(different)} rows differ, first {order}: {different[0]}" if different else ""
