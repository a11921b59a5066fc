"""Queries against their SQL on the small tables."""

import glob
import os

import duckdb

SF = "/root/testdata/sf0.001"


def _plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str([_plain(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def rows_of_sql(sql: str, folder: str = SF):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    order = sorted(range(len(cols)), key=cols.__getitem__)
    return sorted(cols), sorted(tuple(_plain(r[i]) for i in order) for r in cur.fetchall())


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())
