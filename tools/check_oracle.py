"""Run registered keys on Spark and their oracle SQL on DuckDB; compare the results.

    python tools/check_oracle.py [--sf /root/testdata/sf0.01] [key ...]

Compares row count, column names and the multiset of rows (values normalised the same
way on both sides: floats to 9 significant digits, dates to ISO text).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


EXACT = False


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if EXACT else float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(norm(float(x)) for x in v.toArray())
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "smallint": "SMALLINT",
                 "array<float>": "FLOAT[]", "array<double>": "DOUBLE[]", "array<string>": "VARCHAR[]",
                 "array<bigint>": "BIGINT[]", "array<int>": "INTEGER[]"}


def type_mismatches(sdf, desc):
    smap = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    out = []
    for d in desc:
        st = smap.get(d[0])
        want = SPARK_TO_DUCK.get(st, st)
        if st is not None and str(d[1]).upper() != str(want).upper():
            out.append((d[0], st, str(d[1])))
    return out


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr), [columns[i] for i in order]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--tz", default=None, help="session time zone to run Spark under")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    import duckdb

    from tessera.plans.registry import load_all
    from tessera.session import build_session
    from tessera.sources.tables import TABLES

    spark = build_session("local[8]", 8)
    if a.tz:
        spark.conf.set("spark.sql.session.timeZone", a.tz)
    reg = load_all()
    keys = a.keys or sorted(reg)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    bad = 0
    for k in keys:
        p = reg[k]
        t0 = time.time()
        try:
            sdf = p.build(spark, a.sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # report and go on
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not p.oracle:
            print(f"rows {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(p.oracle)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:
            print(f"FAIL {k}: duckdb error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        s_sorted, s_names = rows_of(scols, srows)
        d_sorted, d_names = rows_of(dcols, drows)
        if s_names != d_names:
            print(f"FAIL {k}: columns spark={s_names} duckdb={d_names}")
            bad += 1
        elif len(s_sorted) != len(d_sorted):
            print(f"FAIL {k}: rows spark={len(s_sorted)} duckdb={len(d_sorted)}")
            bad += 1
        elif s_sorted != d_sorted:
            diff = [(x, y) for x, y in zip(s_sorted, d_sorted) if x != y][:3]
            print(f"FAIL {k}: values differ, e.g. {diff}")
            bad += 1
        else:
            global EXACT
            EXACT = True
            exact = rows_of(scols, srows)[0] == rows_of(dcols, drows)[0]
            EXACT = False
            tm = type_mismatches(sdf, res.description)
            print(f"ok   {k}: {len(srows)} rows {ts:.1f}s {'exact' if exact else 'APPROX-ONLY'}"
                  + (f" TYPES {tm}" if tm else ""))
    print(f"{len(keys) - bad}/{len(keys)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
