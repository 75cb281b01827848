"""Runs a registered query and its SQL oracle and compares rows, regardless of order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def as_rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    relation = con.execute(f"DESCRIBE {sql}").fetchall()
    expected = {r[0]: r[1] for r in relation}
    actual = {name: TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    found = [] if expected == actual else [f"schema {actual} != {expected}"]
    result = con.execute(sql)
    want = as_rows([d[0] for d in result.description], result.fetchall())
    got = as_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sum(want.values()) != sum(got.values()):
        found.append(f"{sum(got.values())} rows != {sum(want.values())}")
    found += [f"only in Spark: {str(r)[:300]}" for r in list((got - want))[:3]]
    found += [f"only in SQL: {str(r)[:300]}" for r in list((want - got))[:3]]
    return found
