"""Compare a registered query with its SQL twin: names, types and every row."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canon(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences found; an empty list means equal."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = [tuple(row) for row in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        mine = TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if mine != kinds[f.name]:
            problems.append(f"type of {f.name}: {mine} != {kinds[f.name]}")
    if len(got) != len(want):
        return problems + [f"rows {len(got)} != {len(want)}"]
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} of {len(a)} rows differ ({sorted(names)}): {bad[0][0]} != {bad[0][1]}")
    return problems
