"""Runs a query and its SQL side by side."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if isinstance(v, float) and math.isnan(v) else format(float(v), ".9g")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(v) for v in r) for r in df.select(*cols).collect())


def oracle(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
