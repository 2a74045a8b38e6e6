"""Compare a query with its SQL in DuckDB: same columns, types and rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(_plain(r[i])) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    out = []
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        mine = TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if mine != types[f.name]:
            out.append(f"type of {f.name}: {mine} != {types[f.name]}")
    a, b = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(names, want)
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        out.append(f"only spark {sorted(sa - sb)[:3]}")
        out.append(f"only sql {sorted(sb - sa)[:3]}")
        out.append(f"order {sorted(names)}")
    return out
