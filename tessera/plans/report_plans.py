"""Keys for the schema-driven reports and for SQL with parameters and effects.

A report looks at the tables and columns that are there and picks its variant; each key
shows one set of tables, so its rows are those of the variant that must be picked.  Further
keys: statements run for their effect, table and column probes, files in path order.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ..functions.vectors import sigmoid
from ..session import scratch_path
from ..sources import catalog as C
from ..sources import files as IO
from ..sources.retail_model import RetailModel
from ..sources.tables import Tables
from .registry import REGISTRY, r2_sql, register, rounded
from .retail_plans import AS_OF, C23_DAYS, C23_THRESHOLD

G = "reports"
PROBED = ("products", "suppliers", "warehouse_inventory", "customers", "orders", "loyalty_tiers", "order_items", "warehouses", "shipments")


def _shown(spark, d, names, sources=None, **without):
    """Registers the named retail tables (less some columns; ``sources`` names another stand-in) as the
    only ones a probe finds."""
    m = RetailModel(spark, d)
    for name in PROBED:
        spark.catalog.dropTempView(name)
    C.register_views({n: getattr(m, (sources or {}).get(n, n)).drop(*without.get(n, ())) for n in names})


def _report(key, variant, report, names, sources=None, **without):
    """Registers ``key``: the report on these tables has the rows of the key ``variant``."""
    def build(spark, d):
        _shown(spark, d, names, sources, **without)
        return report(spark)[0]

    build.__name__ = f"q_{key}"
    build.__doc__ = f"The rows of {variant}, picked by probing the catalog."
    register(key, G, REGISTRY[variant].oracle)(build)


def _tiers(spark):
    return C.tier_report(spark, C23_DAYS, C23_THRESHOLD, AS_OF)


SITES = ("order_items", "orders", "warehouses", "shipments")
_report("reorder_report_single", "low_stock", C.reorder_report, ("products", "suppliers"))
_report("restock_report_auto", "restock_cost", C.restock_report, ("products", "warehouse_inventory"))
_report("restock_report_single", "restock_cost_single_site", C.restock_report, ("products",))
_report("transfer_report_auto", "warehouse_transfers", C.transfer_report, ("products", "warehouse_inventory"))
_report("tier_report_auto", "tier_upgrade", _tiers, ("customers", "orders", "loyalty_tiers"))
_report("tier_report_fallback", "tier_top_decile", _tiers, ("customers", "orders"))
_report("discount_report_auto", "discount_buckets", C.discount_report, ("order_items", "products"))
_report("discount_report_amount", "discount_buckets_amount", C.discount_report, ("order_items", "products"),
        order_items=("discount_pct",))
_report("discount_report_list", "discount_buckets_list_price", C.discount_report, ("order_items", "products"),
        sources={"order_items": "order_items_list"}, order_items=("discount_pct", "discount_amount"))
_report("warehouse_report_auto", "warehouse_revenue_item", C.warehouse_revenue_report, SITES)
_report("warehouse_report_order", "warehouse_revenue_order", C.warehouse_revenue_report, SITES, order_items=("warehouse_id",))
_report("warehouse_report_shipment", "warehouse_revenue_shipment", C.warehouse_revenue_report, SITES,
        order_items=("warehouse_id",), orders=("warehouse_id",))


@register("query_with_parameters", G, """
SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_totalprice >= 1000.0 AND o_totalprice < 150000.0 AND o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus""")
def q_query_with_parameters(spark, d):
    """SQL with bound values: a half-open price range and two states, one marker each."""
    C.register_views({"param_orders": Tables(spark, d).orders})
    return C.run_query(spark, """
        SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM param_orders WHERE o_totalprice >= :lo AND o_totalprice < :hi AND o_orderstatus IN (:s0, :s1)
        GROUP BY o_orderstatus""", {"lo": 1000.0, "hi": 150000.0, "s0": "F", "s1": "O"})


@register("statements", G, """
SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1
UNION ALL SELECT n_nationkey, upper(n_name) FROM nation WHERE n_regionkey = 2""")
def q_statements(spark, d):
    """Statements without a result: a table is made, filled by two inserts and dropped; its
    files stay."""
    C.register_views({"stmt_nation": Tables(spark, d).nation})
    name, path = f"stmt_{uuid4().hex[:12]}", scratch_path(spark, "statements")
    C.exec_sql(spark, f"CREATE TABLE {name} (n_nationkey INT, n_name STRING) USING parquet LOCATION '{path}'")
    try:
        C.exec_sql(spark, f"INSERT INTO {name} SELECT n_nationkey, n_name FROM stmt_nation WHERE n_regionkey = :r", {"r": 1})
        C.exec_sql(spark, f"INSERT INTO {name} SELECT n_nationkey, upper(n_name) FROM stmt_nation WHERE n_regionkey = :r", {"r": 2})
    finally:
        C.exec_sql(spark, f"DROP TABLE {name}")
    return spark.read.parquet(path)


@register("probes", G, """
SELECT t.name AS table_name, c.name AS column_name, COUNT(k.column_name) > 0 AS found
FROM (VALUES ('orders'), ('nation'), ('no_such_table')) t(name)
CROSS JOIN (VALUES ('o_orderkey'), ('n_name'), ('no_such_column')) c(name)
LEFT JOIN (SELECT DISTINCT table_name, column_name FROM information_schema.columns) k
  ON k.table_name = t.name AND k.column_name = c.name
GROUP BY 1, 2""")
def q_probes(spark, d):
    """Which columns which tables have."""
    t = Tables(spark, d)
    C.register_views({"probe_orders": t.orders, "probe_nation": t.nation})
    rows = [(n, c, C.column_exists(spark, f"probe_{n}", c))
            for n in ("orders", "nation", "no_such_table") for c in ("o_orderkey", "n_name", "no_such_column")]
    return spark.createDataFrame(rows, "table_name string, column_name string, found boolean")


@register("sorted_files", G, """
SELECT 'item_id=' || item_id AS folder FROM benchmark ORDER BY 'item_id=' || item_id || '/' LIMIT 16""")
def q_sorted_files(spark, d):
    """The first 16 files in path order of a folder with one file per benchmark item."""
    root = scratch_path(spark, "items")
    Tables(spark, d).benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").repartition("item_id").write.partitionBy("item_id").text(root)
    files = IO.sorted_files(IO.scan_class_dirs(spark, root), 16)
    return files.select(F.regexp_extract("path", "/(item_id=[^/]*)/", 1).alias("folder"))


@register("sigmoid", G, f"SELECT event_id, {r2_sql('1.0 / (1.0 + exp(-(value - 50) / 10))', 9)} AS p FROM events")
def q_sigmoid(spark, d):
    return rounded(Tables(spark, d).events.select("event_id", sigmoid((F.col("value") - 50) / 10).alias("p")), "p", places=9)
