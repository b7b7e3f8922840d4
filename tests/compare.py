"""Compare a Spark result with SQL on the same tables, ignoring row order."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def open_tables(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value if value is None or isinstance(value, (bool, str)) else str(value)


def _type_class(name: str) -> str:
    name = name.upper()
    for short, full in (("BIGINT", "LONG"), ("HUGEINT", "LONG"), ("INTEGER", "INT"), ("VARCHAR", "STRING")):
        name = name.replace(short, full)
    return {"TIMESTAMP_NTZ": "TIMESTAMP", "TIMESTAMP WITH TIME ZONE": "TIMESTAMP"}.get(name, name)


def spark_rows(df):
    names = sorted(df.columns)
    kinds = {f.name: _type_class(f.dataType.typeName()) for f in df.schema.fields}
    rows = sorted((tuple(_plain(r[n]) for n in names) for r in df.select(*names).collect()), key=repr)
    return names, [kinds[n].replace("INTEGER", "INT") for n in names], rows


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    described = [(d[0], _type_class(str(d[1]))) for d in cursor.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    return [described[i][0] for i in order], [described[i][1] for i in order], rows


def differences(df, con, sql: str) -> list[str]:
    names, kinds, rows = spark_rows(df)
    want_names, want_kinds, want = sql_rows(con, sql)
    out = []
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    out += [f"type of {n}: {a} != {b}" for n, a, b in zip(names, kinds, want_kinds) if a != b]
    if len(rows) != len(want):
        out.append(f"rows {len(rows)} != {len(want)}")
    if rows != want:
        extra = [r for r in rows if r not in set(want)][:3]
        lacking = [r for r in want if r not in set(rows)][:3]
        out.append(f"values differ: only here {extra}; only in SQL {lacking}")
    return out
