"""Compare a Spark result with DuckDB SQL over the same rows."""
from collections import Counter

import duckdb


def rows(df):
    cols = sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def duck_rows(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow() if hasattr(df, "toArrow") else df)
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    order = [cols.index(c) for c in sorted(cols)]
    return Counter(tuple(r[i] for i in order) for r in rel.fetchall())
