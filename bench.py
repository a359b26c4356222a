"""Benchmark of the headline keys.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each key is built and fully executed (``noop`` sink: every row computed, nothing collected)
twice; the second run is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # retail reports
    "low_stock", "inactive_customers", "inactive_customers_anti", "order_details",
    "category_revenue", "no_sales_products", "no_orders_in_year", "employee_hierarchy",
    "top_customers", "daily_running", "monthly_sales", "monthly_sales_status", "monthly_kpis",
    "reorder_all_warehouses", "restock_cost", "restock_cost_single_site", "warehouse_transfers",
    "cohort_retention", "monthly_churn", "tier_upgrade", "tier_top_decile", "product_pairs",
    "discount_buckets", "discount_buckets_amount", "discount_buckets_list_price",
    "warehouse_revenue_item", "warehouse_revenue_order", "warehouse_revenue_shipment",
    # metrics, series, preparation
    "daily_rollup", "describe_numeric", "histogram", "sliding_windows", "zscore", "early_stop",
    "cohort_grid", "fill_median", "stratified_split", "classification_report",
    "regression_metrics",
    # text and retrieval
    "paragraphs", "chunk_documents", "cosine_topk", "assemble_prompt", "clean_answers",
    "parse_mcq", "score_quiz",
    # layout
    "zorder_write", "assign_identity", "partitioned_write", "csv_roundtrip",
]


def main():
    from tessera.plans.registry import load_all
    from tessera.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          app_name="tessera-bench")
    reg = load_all()
    times = {}
    for k in keys:
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            reg[k].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = time.perf_counter() - t0
        times[k] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
