"""Runs registered queries beside their SQL in DuckDB and compares every value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


_SPARK_TYPE = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def _sort_key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=_sort_key)
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return [f"columns {columns} but expected {sorted(names)}"]
    types = {d[0]: _SPARK_TYPE.get(str(d[1]), str(d[1])) for d in cursor.description}
    if types != dict(df.dtypes):
        return [f"types {df.dtypes} but expected {types}"]
    order = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_sort_key)
    if len(got) != len(want):
        return [f"{len(got)} rows but expected {len(want)}"]
    return [
        f"{g} but expected {w}"
        for g, w in zip(got, want, strict=True)
        if not all(_same(a, b) for a, b in zip(g, w, strict=True))
    ][:3]
