"""Run a registered query on Spark and its SQL on DuckDB and compare the results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
_KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "integer": "int",
          "varchar": "string", "timestamp_ntz": "timestamp", "float": "double"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{Path(sf_dir) / table}.parquet'")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    return _KINDS.get(name, name)


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return ("nan",)
        return ("f", round(value, 9) + 0.0)
    if value is None:
        return ("",)
    return ("v", str(value))


def spark_rows(df):
    columns = sorted(df.columns)
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    rows = sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    return kinds, rows


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = con.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {t[0]: _kind(t[1]) for t in types}
    data = con.execute(sql).fetchall()
    order = [names.index(c) for c in sorted(names)]
    return kinds, sorted(tuple(_cell(r[i]) for i in order) for r in data)


def differences(spark_result, duckdb_result) -> str | None:
    kinds, rows = spark_result
    other_kinds, other_rows = duckdb_result
    if kinds != other_kinds:
        return f"schema {kinds} / {other_kinds}"
    if len(rows) != len(other_rows):
        return f"rows {len(rows)} / {len(other_rows)}"
    for a, b in zip(rows, other_rows):
        if a != b:
            return f"values {a} / {b}"
    return None
