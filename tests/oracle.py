"""Runs a query and its SQL side by side and compares the rows in any order."""

import datetime
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(repr([plain(r[names.index(c)]) for c in columns]) for r in found.fetchall())
    assert sorted(repr([plain(r[c]) for c in columns]) for r in df.collect()) == want
