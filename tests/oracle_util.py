"""Spark-vs-DuckDB comparison used by the tests (same rules as the driver:
column names sorted, order-insensitive value comparison)."""

import math
import os

import duckdb

from storecast.sources.tables import TABLES


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in records)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    s_types = {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert s_types == d_types
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    return len(s_rows)
