"""Layout jobs (row multisets, pruning, skipping, identity), catalog dispatch, models."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import SF_ORACLE, SF_SMALL
from tessera.operators import layout as L
from tessera.operators import models as MD
from tessera.operators import prep as P
from tessera.session import scratch_path
from tessera.sources import catalog as C
from tessera.sources.retail_model import RetailModel


def multiset(df):
    return sorted(tuple(r) for r in df.collect())


def test_layout_writes_keep_rows(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for path in (L.cluster_write(orders, scratch_path(spark, "t1"), ["o_custkey"], num_files=4),
                 L.zorder_write(orders, scratch_path(spark, "t2"), ["o_custkey", "o_orderstatus"], 4),
                 L.rebalance_write(orders, scratch_path(spark, "t3"), max_records_per_file=100)):
        assert multiset(spark.read.parquet(path).select(*orders.columns)) == multiset(orders)


def test_partition_filter_reaches_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = L.partitioned_write(ev, scratch_path(spark, "days"), "ts")
    q = spark.read.parquet(path).filter(F.col("creation_day") == F.lit("2024-01-15").cast("date"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(creation_day" in plan
    q2 = spark.read.parquet(path).filter(L.partition_predicate_from_source(
        "ts", "creation_day", "2024-01-15 06:00:00", "2024-01-15 18:00:00"))
    assert "PartitionFilters: [isnotnull(creation_day" in q2._jdf.queryExecution().executedPlan().toString()
    assert q2.count() == ev.filter(F.col("ts").between("2024-01-15 06:00:00", "2024-01-15 18:00:00")).count()


def test_identity_is_dense_and_follows_order(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ids = L.assign_identity(ev.repartition(7), "event_id", start=10000).select("event_id", "id")
    rows = sorted(ids.collect())
    assert [r.id for r in rows] == list(range(10000, 10000 + len(rows)))


def test_compaction_stays_inside_the_folders(spark):
    """Small files of each folder become one; folders, values (leading zeros too) and a large
    file stay; files with a column of their own keep it."""
    from pathlib import Path

    path = scratch_path(spark, "smallfiles")
    rows = spark.range(3000).select("id", F.format_string("%03d", F.col("id") % 3).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    rows.repartition(6).write.partitionBy("code").parquet(path)
    rows.where("code = '000'").coalesce(1).write.mode("append").partitionBy("code").parquet(path)  # one larger file
    rows.limit(4).withColumn("late", F.lit(1)).repartition(2).write.mode("append").partitionBy("code").parquet(path)
    local = Path(path.removeprefix("file:"))
    sizes = {f: f.stat().st_size for f in local.rglob("*.parquet")}
    large = max(sizes, key=sizes.get)
    folders = sorted(f.name for f in local.iterdir() if "=" in f.name)

    def read():
        text = spark.read.option("mergeSchema", True).schema("id long, pad string, late int, code string").parquet(path)
        return sorted((tuple(x) for x in text.select("id", "code", "pad", "late").collect()), key=repr)

    before = read()
    r = L.compact_files(spark, path, target_file_bytes=int(sizes[large] / 0.8), bins_per_job=2).first()
    left = [f for f in local.rglob("*.parquet")]
    assert large in left
    assert (r.files_before, r.files_after) == (len(sizes), len(left)) and len(left) < len(sizes) / 2
    assert sorted(f.name for f in local.iterdir() if "=" in f.name) == folders and read() == before
    assert not [f for f in local.iterdir() if f.name.startswith("_compact")]
    again = L.compact_files(spark, path, target_file_bytes=int(min(f.stat().st_size for f in left))).first()
    assert again.files_replaced == 0 and read() == before


def test_zorder_of_strings_uses_whole_values(spark):
    rows = spark.range(200).select(F.format_string("Customer#%09d", "id").alias("name"), (F.col("id") * 37 % 200).alias("v"))
    z = L.zorder_key(rows.unionByName(spark.createDataFrame([(None, 5)], "name string, v long")), ["name", "v"])
    assert z.select("_z").distinct().count() > 150
    buckets = rows.select("name", L.bucket_of(F.col("name"), L.typed_edges(rows, ["name"], 64)[0]).alias("b")).orderBy("name").collect()
    assert [r.b for r in buckets] == sorted(r.b for r in buckets) and len({r.b for r in buckets}) == 64
    path = L.zorder_write(rows, scratch_path(spark, "zs"), ["name", "v"], num_files=16)
    some = L.file_skipping(spark, path, {"name": "Customer#000000042", "v": 42}).first()
    assert some.files_admitting_name <= 8 and some.files_admitting_v <= 8


def test_any_number_of_levels(spark):
    df = spark.range(50_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("c"))
    df = df.unionByName(spark.createDataFrame([(-1, None)], "id long, c string"))
    codes = {r.c: r.c_index for r in P.label_encode(df, "c").collect()}
    names = sorted(c for c in codes if c is not None)
    assert [codes[c] for c in names] == list(range(50_000)) and codes[None] == 50_000
    v = P.one_hot_vector(df.where("id < 1000"), "c").orderBy("c").select("c_onehot").collect()
    assert [(int(r.c_onehot.indices[0]), r.c_onehot.size) for r in v if len(r.c_onehot.indices)] == [(i, 1000) for i in range(1000)]


def test_zorder_skips_files(spark):
    orders = spark.read.parquet(f"{SF_ORACLE}/orders.parquet")
    p = orders.orderBy("o_orderkey").first()
    preds = {"o_custkey": p.o_custkey, "o_totalprice": p.o_totalprice}
    z = L.file_skipping(spark, L.zorder_write(orders, scratch_path(spark, "zz"), ["o_custkey", "o_totalprice"], 16),
                        preds).first()
    none = L.file_skipping(spark, L.cluster_write(orders.repartition(16), scratch_path(spark, "nn"), None),
                           preds).first()
    assert z.files_admitting_o_custkey < none.files_admitting_o_custkey
    assert z.files_admitting_o_totalprice < none.files_admitting_o_totalprice


def test_catalog_variants(spark):
    m = RetailModel(spark, SF_SMALL)
    for name in ("warehouse_inventory", "loyalty_tiers", "shipments"):
        spark.catalog.dropTempView(name)
    C.register_views({"products": m.products, "suppliers": m.suppliers, "orders": m.orders,
                      "customers": m.customers, "warehouses": m.warehouses,
                      "order_items": m.order_items.drop("discount_pct", "warehouse_id")})
    df, note = C.reorder_report(spark)
    assert "falling back" in note and "units_to_order" in df.columns
    assert C.transfer_report(spark)[0] is None
    df, note = C.discount_report(spark)
    assert "discount_amount" in note
    df, note = C.warehouse_revenue_report(spark)
    assert note == "Using orders.warehouse_id."
    df, note = C.tier_report(spark, as_of="2001-08-02")
    assert note.startswith("Fallback") and "pr" in df.columns
    C.register_views({"warehouse_inventory": m.warehouse_inventory})
    assert "Using warehouse_inventory" in C.reorder_report(spark)[1]
    assert C.column_exists(spark, "products", "list_price") and not C.table_exists(spark, "no_such_table")
    for name in ("products", "suppliers", "orders", "customers", "warehouses", "order_items",
                 "warehouse_inventory"):
        spark.catalog.dropTempView(name)


@pytest.fixture(scope="module")
def separable(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    y = ((x[:, 0] + 0.5 * x[:, 1]) > 0).astype(float)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], float(y[i])) for i in range(400)],
                               "id long, x array<double>, label double")
    s = P.stratified_split(df, "label", "id", 0.7, seed=1)
    s = MD.with_features(s, array_col="x").checkpoint(eager=True)
    return s.filter("is_train"), s.filter(~F.col("is_train"))


def _acc(model, test):
    return test.transform(model.transform if hasattr(model, "transform") else model) \
        .agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_forest_beats_majority_and_importances_sum_to_one(separable):
    train, test = separable
    m = MD.random_forest(train, num_trees=30, max_depth=5, min_leaf=2)
    assert _acc(m, test) > 0.8
    assert sum(m.featureImportances.toArray()) == pytest.approx(1.0)


def test_score_batch_skips_unreadable_rows(spark, separable):
    train, _ = separable
    m = MD.linear_head(train.withColumn("label", F.col("label")))
    df = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4]), (2, None), (3, [1.0])], "id long, x array<double>")
    out = MD.score_batch(m, df, "id", "x", 4, class_names=["no", "yes"]).collect()
    assert [r.id for r in out] == [1] and out[0].pred in ("no", "yes") and 0.5 <= out[0].conf <= 1.0


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(i, 0 if i < 30 else 1) for i in range(40)], "id long, y int")
    w = {r.y: r.weight for r in P.class_weights(df, "y").collect()}
    assert w[0] == pytest.approx(40 / (2 * 30)) and w[1] == pytest.approx(40 / (2 * 10))


def test_stratified_split_sizes(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(101)], "id long, y int")
    s = P.stratified_split(df, "y", "id", 0.7, seed=5)
    got = {(r.y, r.is_train): r["count"] for r in s.groupBy("y", "is_train").count().collect()}
    for y, n in ((0, 34), (1, 34), (2, 33)):
        assert got[(y, True)] == int(n * 0.7 + 0.5)


def test_vector_functions(spark):
    import math

    from tessera.functions import vectors as V

    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0, 3.0])], "a array<double>, b array<double>")
    r = df.select(V.l2_norm("a").alias("n"), V.dot("a", "a").alias("d"), V.l2_normalize("a").alias("u"),
                  V.softmax("b").alias("s"), V.argmax("b").alias("i"), V.sigmoid(F.lit(0.0)).alias("g"),
                  V.sigmoid_derivative(F.lit(0.5)).alias("gd")).first()
    assert r.n == 5.0 and r.d == 25.0 and r.u == pytest.approx([0.6, 0.8])
    e = [math.exp(x - 3) for x in (1, 2, 3)]
    assert r.s == pytest.approx([x / sum(e) for x in e]) and r.i == 2
    assert r.g == 0.5 and r.gd == 0.25


def test_date_parts(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2015, 7, 31),)], "Date date")
    r = P.add_date_parts(df, "Date").first()
    assert (r.Year, r.Month, r.Day) == (2015, 7, 31)


def test_parameterised_sql(spark):
    C.register_views({"nums": spark.range(10)})
    got = C.run_query(spark, "SELECT count(*) AS n FROM nums WHERE id >= :lo AND id < :hi",
                      {"lo": 3, "hi": 7}).first().n
    assert got == 4
    C.exec_sql(spark, "CREATE OR REPLACE TEMP VIEW evens AS SELECT id FROM nums WHERE id % 2 = 0")
    assert spark.table("evens").count() == 5
    spark.catalog.dropTempView("nums")
    spark.catalog.dropTempView("evens")
