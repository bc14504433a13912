"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "FLOAT": "float",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    return value


def _key(row):
    return tuple((v is not None, str(type(v).__name__), v if v is not None else 0) for v in row)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty when columns, types and rows agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    other = cursor.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = sorted(spark_df.columns)
    if mine != sorted(names):
        return [f"columns differ: {sorted(set(mine) ^ set(names))}"]
    problems = [
        f"type of {f.name}: spark {f.dataType.simpleString()} vs {types[f.name]}"
        for f in spark_df.schema.fields
        if KINDS.get(types[f.name], types[f.name].lower()) != f.dataType.simpleString()
    ]
    a = [tuple(_norm(r[c]) for c in mine) for r in spark_df.select(mine).collect()]
    index = [names.index(c) for c in mine]
    b = [tuple(_norm(r[i]) for i in index) for r in other]
    if len(a) != len(b):
        return [*problems, f"rows: spark {len(a)} vs sql {len(b)}"]
    a.sort(key=_key)
    b.sort(key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} of {len(a)} rows differ")
        for x, y in bad[:3]:
            diff = [(c, p, q) for c, p, q in zip(mine, x, y) if p != q]
            problems.append(str(diff[:6]))
    return problems
