"""

    python tools/duckdb_times.py [--sf /root/testdata/sf0.1] [key ...]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--threads", type=int, default=8)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    import duckdb

    from tessera.plans.registry import load_all
    from tessera.sources.tables import TABLES

    reg = load_all()
    con = duckdb.connect()
    con.execute(f"SET threads = {a.threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    out = {}
    for k in a.keys or sorted(reg):
        sql = reg[k].oracle
        if not sql:
            continue
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            best = time.perf_counter() - t0
        out[k] = round(best, 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
