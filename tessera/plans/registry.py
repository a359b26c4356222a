"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame`` plus oracle SQL.

The oracle text is DuckDB SQL over the same parquet tables.  Keys whose result has no
SQL form (model fits, file layout jobs) register no oracle and are checked by pytest.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.common import round_half_up
from ..sources.retail_model import duckdb_with


@dataclass(frozen=True)
class Plan:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    group: str


REGISTRY: dict[str, Plan] = {}


def register(key: str, group: str, oracle: str | None = None):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate key {key}")
        REGISTRY[key] = Plan(key, fn, oracle, group)
        return fn

    return deco


def with_views(views, body: str) -> str:
    """DuckDB oracle text: retail views as CTEs, then ``body`` (which may have its own WITH)."""
    b = body.strip()
    if not views:
        return b
    head = duckdb_with(views, "")
    if b[:4].upper() == "WITH":
        return head.rstrip() + ",\n" + b[4:].lstrip()
    return head + b


def r2_sql(x: str, places: int = 2) -> str:
    s = float(10 ** places)
    return f"(floor(({x}) * {s} + 0.5) / {s})"


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Columns rounded half up for the comparison with the oracle; operators do not round."""
    return df.withColumns({c: round_half_up(c, places) for c in cols})


def pct_sql(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) * 100.0 / CAST({d} AS DOUBLE))"


def money_sql(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def msum_sql(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mavg_sql(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({x}))"


#: Products and their stock in one relation; a group is one product.
SHORT_SQL = """WITH both_sides AS (
  SELECT product_id, product_name, reorder_level, cost_price, CAST(0 AS HUGEINT) AS held FROM products
  UNION ALL
  SELECT product_id, NULL, NULL, NULL, quantity FROM warehouse_inventory),
short AS (
  SELECT product_id, MAX(product_name) AS product_name, MAX(reorder_level) AS reorder_level,
         MAX(cost_price) AS cost_price, SUM(held) AS held
  FROM both_sides GROUP BY product_id HAVING MAX(reorder_level) > SUM(held))"""
SHORT_PRODUCTS_SQL = SHORT_SQL + """
SELECT product_id, product_name, CAST(held AS BIGINT) AS total_qty_across_warehouses, reorder_level,
       CAST(reorder_level - held AS BIGINT) AS units_to_order
FROM short"""


def load_all() -> dict[str, Plan]:
    """Import every plan module (registration happens on import)."""
    from . import retail_plans  # noqa: F401
    for mod in ("metric_plans", "prep_plans", "text_plans", "layout_plans", "model_plans", "report_plans"):
        try:
            __import__(f"{__package__}.{mod}")
        except ModuleNotFoundError as e:  # a group not written yet
            if mod not in str(e):
                raise
    return REGISTRY
