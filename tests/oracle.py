"""Compares a query with its SQL twin in DuckDB over the same files."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata/sf0.001")


def connect(data=DATA):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in data.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows(names, values):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in at], sorted(tuple(shown(r[i]) for i in at) for r in values)


def compare(spark, con, query, sql, data=DATA):
    df = query(spark, str(data))
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = rows([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1], (sorted(set(got[1]) - set(want[1]))[:3], sorted(set(want[1]) - set(got[1]))[:3])
    return len(got[1])
