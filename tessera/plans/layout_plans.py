"""Keys for table layout jobs and file sources/sinks.

Each write goes to a fresh folder below the session's shared checkpoint directory and the
key returns the table read back (or a one-row report), so the check compares the stored
rows with the source rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import layout as L
from ..operators import prep as P
from ..session import scratch_path
from ..sources import files as IO
from ..sources.catalog import register_views, reorder_report
from ..sources.retail_model import RetailModel
from ..sources.tables import Tables
from .registry import SHORT_PRODUCTS_SQL, register, with_views

G = "layout"
DAY = "2024-01-15"
TS_LO, TS_HI = "2024-01-15 06:00:00", "2024-01-16 18:00:00"
ORDERS_ALL = "SELECT * FROM orders"


@register("cluster_write", G, ORDERS_ALL)
def q_cluster_write(spark, d):
    path = L.cluster_write(Tables(spark, d).orders, scratch_path(spark, "cluster"),
                           keys=["o_custkey", "o_orderdate"], num_files=8)
    return spark.read.parquet(path)


@register("recluster_write", G, ORDERS_ALL)
def q_recluster_write(spark, d):
    """First generation without clustering keys, the next one clustered by new keys."""
    orders = Tables(spark, d).orders
    first = L.cluster_write(orders, scratch_path(spark, "gen1"), keys=None)
    second = L.cluster_write(spark.read.parquet(first), scratch_path(spark, "gen2"),
                             keys=["o_orderkey", "o_custkey"], num_files=8)
    return spark.read.parquet(second)


# Logged filters: each event is a query on orders filtering the column its type names.
_FILTER_COLUMN = {"click": "o_custkey", "view": "o_orderdate", "purchase": "o_orderstatus",
                  "signup": "o_orderpriority", "error": "o_totalprice"}


def _filter_log_expr():
    e = F.col("event_type")
    out = None
    for k, v in _FILTER_COLUMN.items():
        out = (F.when(e == k, v) if out is None else out.when(e == k, v))
    return out


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@register("suggest_cluster_keys", G, """
WITH log AS (SELECT CASE event_type """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _FILTER_COLUMN.items())
    + """ END AS column_name FROM events),
freq AS (SELECT column_name, COUNT(*) AS filter_count FROM log GROUP BY column_name),
ndv AS (""" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT CAST({c} AS VARCHAR)) AS distinct_values FROM orders"
        for c in _ORDER_COLS) + """),
s AS (SELECT f.column_name, f.filter_count, n.distinct_values, f.filter_count * n.distinct_values AS score
      FROM freq f JOIN ndv n ON n.column_name = f.column_name)
SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, column_name) AS INTEGER) AS rank FROM s) r
WHERE rank <= 3""")
def q_suggest_cluster_keys(spark, d):
    t = Tables(spark, d)
    log = t.events.select(_filter_log_expr().alias("column_name"))
    return L.suggest_cluster_keys(log, t.orders, top_k=3, exact=True)


def _small_files(spark, d):
    """Events in one folder per type, each of many small files."""
    path = scratch_path(spark, "small")
    Tables(spark, d).events.repartition(16).write.partitionBy("event_type").parquet(path)
    return path


@register("compact_files", G, "SELECT * FROM events")
def q_compact_files(spark, d):
    """The rows after compaction inside the partition folders, partition values included."""
    path = _small_files(spark, d)
    L.compact_files(spark, path)
    out = spark.read.parquet(path)
    return out.select(*Tables(spark, d).events.columns)


@register("compact_report", G, """
SELECT CAST(COUNT(DISTINCT event_type) AS BIGINT) AS files_after, CAST(COUNT(DISTINCT event_type) AS BIGINT) AS bins
FROM events""")
def q_compact_report(spark, d):
    """Files left (one a folder, all below the target size) and bins merged."""
    return L.compact_files(spark, _small_files(spark, d)).select("files_after", "bins")


@register("zorder_write", G, ORDERS_ALL)
def q_zorder_write(spark, d):
    path = L.zorder_write(Tables(spark, d).orders, scratch_path(spark, "zorder"),
                          ["o_custkey", "o_totalprice"], num_files=16)
    return spark.read.parquet(path)


@register("zorder_skipping", G)
def q_zorder_skipping(spark, d):
    """Files that a point lookup on each key must read, for three layouts of orders."""
    orders = Tables(spark, d).orders
    probe = orders.orderBy("o_orderkey").select("o_custkey", "o_totalprice").first()
    preds = {"o_custkey": probe[0], "o_totalprice": probe[1]}
    layouts = {
        "zorder": L.zorder_write(orders, scratch_path(spark, "z"), ["o_custkey", "o_totalprice"], 16),
        "linear": L.cluster_write(orders, scratch_path(spark, "lin"), ["o_custkey"], num_files=16),
        "none": L.cluster_write(orders.repartition(16), scratch_path(spark, "none"), None),
    }
    out = None
    for name, path in layouts.items():
        r = L.file_skipping(spark, path, preds).withColumn("layout", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out


@register("point_lookup", G, "SELECT * FROM orders WHERE o_orderkey = 4 OR o_custkey = 100")
def q_point_lookup(spark, d):
    """Equality / OR point filter on the Z-ordered copy of orders (min/max file skipping)."""
    path = L.zorder_write(Tables(spark, d).orders, scratch_path(spark, "zlookup"),
                          ["o_orderkey", "o_custkey"], num_files=16)
    return spark.read.parquet(path).filter((F.col("o_orderkey") == 4) | (F.col("o_custkey") == 100))


_EVENTS_DAY = "SELECT *, CAST(ts AS DATE) AS creation_day FROM events"


def _partitioned(spark, d):
    return spark.read.parquet(L.partitioned_write(Tables(spark, d).events,
                                                  scratch_path(spark, "byday"), "ts"))


@register("partitioned_write", G, _EVENTS_DAY)
def q_partitioned_write(spark, d):
    return _partitioned(spark, d)


@register("partition_pruned_read", G, f"{_EVENTS_DAY} WHERE CAST(ts AS DATE) = DATE '{DAY}'")
def q_partition_pruned_read(spark, d):
    """Filter on the partition column: only that day's folder is listed and read."""
    return _partitioned(spark, d).filter(F.col("creation_day") == F.lit(DAY).cast("date"))


@register("pruned_by_source", G,
          f"{_EVENTS_DAY} WHERE ts >= TIMESTAMP '{TS_LO}' AND ts <= TIMESTAMP '{TS_HI}'")
def q_pruned_by_source(spark, d):
    """A range on the source timestamp, with the derived day range added for pruning."""
    t = _partitioned(spark, d)
    return t.filter(L.partition_predicate_from_source("ts", "creation_day", TS_LO, TS_HI))


@register("assign_identity", G, """
SELECT *, CAST(row_number() OVER (ORDER BY event_id) + 9999 AS BIGINT) AS id FROM events""")
def q_assign_identity(spark, d):
    return L.assign_identity(Tables(spark, d).events, "event_id", start=10000)


_BATCH1 = ("click", "view")


@register("insert_select", G, """
SELECT id, event_id, user_id, event_type, value, ts, creation_day FROM (
  SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS creation_day,
         CAST(row_number() OVER (ORDER BY CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE 1 END, event_id)
              + 9999 AS BIGINT) AS id
  FROM events) x""")
def q_insert_select(spark, d):
    """Two INSERT ... SELECT batches into one partitioned table with an identity column."""
    ev = Tables(spark, d).events
    path = scratch_path(spark, "insert")
    cols = ["event_id", "user_id", "event_type", "value", "ts"]
    L.insert_select(spark, ev.filter(F.col("event_type").isin(*_BATCH1)), path, cols, "event_id", "ts")
    L.insert_select(spark, ev.filter(~F.col("event_type").isin(*_BATCH1)), path, cols, "event_id", "ts")
    return spark.read.parquet(path)


@register("rebalance_write", G)
def q_rebalance_write(spark, d):
    """Write with AQE-sized partitions and a per-file record cap; report files and rows."""
    path = L.rebalance_write(Tables(spark, d).lineitem, scratch_path(spark, "rebal"),
                             max_records_per_file=10000)
    files = L.file_sizes(spark, path).agg(F.count(F.lit(1)).alias("files"))
    return files.crossJoin(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")))


# ---- file sources and sinks ----

ORDERS_CSV_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                     "o_orderdate date, o_orderpriority string")


@register("csv_roundtrip", G, """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""")
def q_csv_roundtrip(spark, d):
    o = Tables(spark, d).orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = IO.write_csv(o, scratch_path(spark, "csv"))
    return IO.read_csv(spark, path, ORDERS_CSV_SCHEMA, date_format="yyyy-MM-dd")


EVENTS_JSON_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string, day date"


@register("json_roundtrip", G, """
SELECT event_id, user_id, event_type, value, props, CAST(ts AS DATE) AS day FROM events""")
def q_json_roundtrip(spark, d):
    ev = Tables(spark, d).events.select("event_id", "user_id", "event_type", "value", "props",
                                        F.to_date("ts").alias("day"))
    path = IO.write_json(ev, scratch_path(spark, "json"))
    return IO.read_json(spark, path, EVENTS_JSON_SCHEMA)


@register("scan_class_dirs", G)
def q_scan_class_dirs(spark, d):
    """Documents stored one folder per language; the scan recovers the class from the path
    and splits each class's files 80/20."""
    root = scratch_path(spark, "classes")
    (Tables(spark, d).documents.select("lang", "text").write.option("maxRecordsPerFile", 25)
     .partitionBy("lang").text(root))  # many files per class folder
    files = IO.scan_class_dirs(spark, root, exts=("*.txt",))
    split = P.per_class_split(files, "class", "path", 0.8, seed=42)
    return split.groupBy("class").agg(F.count(F.lit(1)).alias("files"),
                                      F.sum(F.col("is_train").cast("long")).alias("train_files"),
                                      F.sum("length").alias("bytes"))


@register("top_n", G, """
SELECT * FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20""")
def q_top_n(spark, d):
    return IO.top_n(Tables(spark, d).lineitem, 20, F.desc("l_extendedprice"), "l_orderkey",
                    "l_linenumber", "l_partkey", "l_suppkey")


@register("reorder_report_auto", G, with_views(["products", "warehouse_inventory"], SHORT_PRODUCTS_SQL))
def q_reorder_report_auto(spark, d):
    """The reorder report picked by probing the catalog (per-warehouse stock is present)."""
    m = RetailModel(spark, d)
    register_views({"products": m.products, "suppliers": m.suppliers,
                    "warehouse_inventory": m.warehouse_inventory})
    df, _note = reorder_report(spark)
    return df
