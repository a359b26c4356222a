"""Catalog probes and schema-driven variant choice.

The retail reports adapt to the tables that exist: a probe of the Spark catalog picks the
variant, and each report returns ``(DataFrame or None, note)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import retail as R

# The notes each report variant returns, as the dashboard shows them.
NOTES = {
    "reorder_multi": "Using warehouse_inventory to aggregate stock across all warehouses.",
    "reorder_single": "warehouse_inventory table not found; falling back to products.stock_quantity.",
    "restock_multi": "Using total stock across warehouses to compute deficit * cost_price.",
    "restock_single": "warehouse_inventory not available; using products.stock_quantity as single-site.",
    "transfer_missing": "warehouse_inventory table is required for transfer recommendations.",
    "transfer": "Transfers computed from warehouses with surplus to those with deficit per product.",
    "tier_table": "Using loyalty_tiers thresholds and last-N-days spend.",
    "tier_fallback": "Fallback heuristic: top 10% spenders within tier (last N days).",
    "discount_pct": "Using order_items.discount_pct.",
    "discount_amount": "Using order_items.discount_amount derived %.",
    "discount_list": "Inferring discount % from products.list_price vs order_items.unit_price.",
    "discount_none": "No discount fields found (order_items.discount_* or products.list_price).",
    "wh_item": "Using order_items.warehouse_id.",
    "wh_order": "Using orders.warehouse_id.",
    "wh_shipment": "Using shipments mapping of order_items to warehouses.",
    "wh_none": "No warehouse mapping found (order_items/ orders/ shipments).",
}


def current_database(spark: SparkSession) -> str:
    """S11."""
    return spark.catalog.currentDatabase()


def table_exists(spark: SparkSession, name: str) -> bool:
    """Table or (temporary) view of that name in the current catalog."""
    return spark.catalog.tableExists(name)


def column_exists(spark: SparkSession, table: str, column: str) -> bool:
    """S10."""
    return table_exists(spark, table) and column in spark.table(table).columns


def reorder_report(spark: SparkSession) -> tuple[DataFrame, str]:
    """C1.1 with fallback to Q1 when stock is not kept per warehouse."""
    if table_exists(spark, "warehouse_inventory"):
        return (R.reorder_all_warehouses(spark.table("products"), spark.table("warehouse_inventory")),
                NOTES["reorder_multi"])
    return (R.low_stock(spark.table("products"), spark.table("suppliers")),
            NOTES["reorder_single"])


def restock_report(spark: SparkSession) -> tuple[DataFrame, str]:
    """C1.2: all-warehouse or single-site cost to restock."""
    if table_exists(spark, "warehouse_inventory"):
        return (R.restock_cost(spark.table("products"), spark.table("warehouse_inventory")),
                NOTES["restock_multi"])
    return (R.restock_cost_single_site(spark.table("products")),
            NOTES["restock_single"])


def transfer_report(spark: SparkSession) -> tuple[DataFrame | None, str]:
    """C1.3: needs per-warehouse stock."""
    if not table_exists(spark, "warehouse_inventory"):
        return None, NOTES["transfer_missing"]
    return (R.warehouse_transfers(spark.table("products"), spark.table("warehouse_inventory")),
            NOTES["transfer"])


def tier_report(spark: SparkSession, days: int = 90, threshold: float = 0.8, as_of=None,
                nearest_only: bool = False) -> tuple[DataFrame, str]:
    """C2.3: tier thresholds when a tier table with minimums exists, else top decile."""
    if table_exists(spark, "loyalty_tiers") and column_exists(spark, "loyalty_tiers", "min_spend"):
        return (R.tier_upgrade(spark.table("customers"), spark.table("orders"),
                               spark.table("loyalty_tiers"), days, threshold, as_of,
                               nearest_only=nearest_only),
                NOTES["tier_table"])
    return (R.tier_top_decile(spark.table("customers"), spark.table("orders"), days, as_of),
            NOTES["tier_fallback"])


def discount_report(spark: SparkSession) -> tuple[DataFrame | None, str]:
    """C3.2: discount_pct, else discount_amount, else list price, else nothing."""
    if column_exists(spark, "order_items", "discount_pct"):
        return R.discount_buckets(spark.table("order_items")), NOTES["discount_pct"]
    if column_exists(spark, "order_items", "discount_amount"):
        return (R.discount_buckets_amount(spark.table("order_items")),
                NOTES["discount_amount"])
    if column_exists(spark, "products", "list_price"):
        return (R.discount_buckets_list_price(spark.table("order_items"), spark.table("products")),
                NOTES["discount_list"])
    return None, NOTES["discount_none"]


def warehouse_revenue_report(spark: SparkSession) -> tuple[DataFrame | None, str]:
    """C3.3: through order_items.warehouse_id, orders.warehouse_id or shipments."""
    if column_exists(spark, "order_items", "warehouse_id"):
        return (R.warehouse_revenue_item(spark.table("order_items"), spark.table("orders"),
                                         spark.table("warehouses")), NOTES["wh_item"])
    if column_exists(spark, "orders", "warehouse_id"):
        return (R.warehouse_revenue_order(spark.table("orders"), spark.table("warehouses")),
                NOTES["wh_order"])
    if column_exists(spark, "shipments", "warehouse_id") and column_exists(spark, "shipments", "order_item_id"):
        return (R.warehouse_revenue_shipment(spark.table("shipments"), spark.table("order_items"),
                                             spark.table("orders"), spark.table("warehouses")),
                NOTES["wh_shipment"])
    return None, NOTES["wh_none"]


def run_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """S3: parameterised SQL over registered views (``:name`` markers bound from ``params``).

    Lists are not accepted as a single parameter; give one marker per item (``:s0, :s1``)
    or filter with ``Column.isin`` in the DataFrame API.
    """
    return spark.sql(sql, args=params or None)


def exec_sql(spark: SparkSession, sql: str, params: dict | None = None) -> None:
    """A statement without a result (DDL / DML), run for its effect."""
    spark.sql(sql, args=params or None).collect()


def register_views(frames: dict[str, DataFrame]) -> None:
    """S3 / S4 helper: expose DataFrames to SQL and to the probes as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
