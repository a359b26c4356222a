"""Summarise the physical plan of each key (``explain("formatted")``) into PLANS.md.

    python tools/plan_report.py [--sf /root/testdata/sf0.1] [--out PLANS.md]

Counts per key: shuffles (Exchange), broadcasts, join strategies, windows, and for each
parquet scan the pushed filters and the columns read.  Model keys are skipped (their plans
are those of pyspark.ml); layout keys are built (their writes run) and the read-back plan
is reported.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(text: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", text, flags=re.M)
    scans = []
    for block in re.split(r"\n\n", text):
        block = block.strip("\n")
        if block.startswith("(") and "Scan parquet" in block.splitlines()[0]:
            loc = re.search(r"Location: \w+ \[(.*?)\]", block)
            pf = re.search(r"PushedFilters: \[(.*?)\]\n", block)
            rs = re.search(r"ReadSchema: struct<(.*?)>\n", block + "\n")
            table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
            cols = [c.split(":")[0] for c in rs.group(1).split(",")] if rs and rs.group(1) else []
            scans.append((table, len(cols), pf.group(1) if pf else ""))
    return {
        "exchanges": sum(1 for n in nodes if n == "Exchange"),
        "broadcasts": sum(1 for n in nodes if n == "BroadcastExchange"),
        "smj": sum(1 for n in nodes if n == "SortMergeJoin"),
        "bhj": sum(1 for n in nodes if n == "BroadcastHashJoin"),
        "bnlj": sum(1 for n in nodes if n == "BroadcastNestedLoopJoin"),
        "windows": sum(1 for n in nodes if n == "Window"),
        "scans": scans,
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default="PLANS.md")
    a = ap.parse_args()

    from tessera.plans.registry import load_all
    from tessera.session import build_session

    spark = build_session("local[8]", 8)
    reg = load_all()
    lines = ["# Physical plans", "",
             f"Generated by `tools/plan_report.py` on `{a.sf}`",
             "(the plans a cluster runs).  Initial (pre-AQE) physical plans: AQE may still turn a",
             "sort-merge join into a broadcast join or merge/split partitions at run time.",
             "Columns: shuffles = Exchange nodes; B = broadcast exchanges; SMJ / BHJ / BNLJ = join",
             "strategies; W = window operators; scans = table(columns read; pushed filters).", "",
             "| key | shuffles | B | SMJ | BHJ | BNLJ | W | scans |", "| --- | ---: | ---: | ---: | ---: | ---: | ---: | --- |"]
    for k in sorted(reg):
        p = reg[k]
        if p.group == "models":
            continue
        try:
            df = p.build(spark, a.sf)
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                df.explain("formatted")
            s = summarise(buf.getvalue())
        except Exception as e:  # report and go on
            lines.append(f"| {k} | error: {type(e).__name__} | | | | | | |")
            continue
        scans = "; ".join(f"{t}({n}{'; ' + f if f else ''})" for t, n, f in s["scans"])
        lines.append(f"| {k} | {s['exchanges']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
                     f"{s['bnlj']} | {s['windows']} | {scans} |")
    open(a.out, "w").write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
