from __future__ import annotations

import datetime as dt
import decimal
import math
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    res = con.execute(sql)
    return table([d[0] for d in res.description], res.fetchall())
