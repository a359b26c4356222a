"""The forest balanced per tree against a plain recursion on the same samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting as B
from tessera.operators import forest as R


def frame(spark, n=160, seed=2, missing=True):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 1)
    y = ((x[:, 0] + 0.7 * x[:, 3] > 1.2)).astype(float)
    rows = [(i, [None if missing and rng.random() < 0.05 else float(v) for v in x[i]], float(y[i])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, x array<double>, label double").repartition(5)


def plain_tree(bins, y, times, number, width, m, missing, min_leaf, max_depth, seed):
    """Node list of one tree: (feature, bin, missing left, left, right, shares)."""
    drawn = np.array([times[y == c].sum() for c in (0, 1)], float)
    weight = drawn.sum() / drawn / 2

    def counts(rows):
        return np.array([times[rows][y[rows] == c].sum() for c in (0, 1)], float)

    def purity(c):
        w = c * weight
        return (w ** 2).sum() / w.sum() if w.sum() else 0.0

    nodes, level = [None], [(0, np.arange(len(y)))]
    for depth in range(max_depth + 1):
        later = []
        for node, rows in level:
            c = counts(rows)
            share = c * weight / (c * weight).sum()
            best = None
            if depth < max_depth and (node == 0 or (c > 0).all() and c.sum() >= 2 * min_leaf):
                for side in (False, True):
                    for f in R.chosen_features(seed, number, node, width, m):
                        for b in range(missing - 1):
                            left = (bins[rows, f] <= b) | (side & (bins[rows, f] == missing)) if side else bins[rows, f] <= b
                            a, z = counts(rows[left]), counts(rows[~left])
                            if min(a.sum(), z.sum()) >= min_leaf:
                                gain = purity(a) + purity(z) - purity(c)
                                if best is None or gain > best[0] + 1e-9:
                                    best = (gain, f, b, side, rows[left], rows[~left])
            if best is None or best[0] <= B.MIN_GAIN:
                nodes[node] = (-1, 0, False, 0, 0, share)
                continue
            nodes[node] = (best[1], best[2], best[3], len(nodes), len(nodes) + 1, share)
            later += [(len(nodes), best[4]), (len(nodes) + 1, best[5])]
            nodes += [None, None]
        level = later
    return nodes


@pytest.mark.parametrize("table_bytes", [16 << 20, 4000])  # in one pass a level, and in many
def test_trees_equal_a_plain_recursion(spark, monkeypatch, table_bytes):
    monkeypatch.setattr(R, "TABLE_BYTES", table_bytes)
    rows, df = frame(spark)
    model = R.balanced_forest(df, "x", "label", "id", 5, trees=3, max_depth=4, min_leaf=2, seed=9, max_bins=12)
    missing = B._missing(model.edges)
    key = {r.id: r.k for r in df.select("id", F.xxhash64("id", F.lit(9)).alias("k")).collect()}
    bins = np.array([[missing if v is None else np.searchsorted(e, v, "left") for v, e in zip(x, model.edges)] for _, x, _ in rows])
    y = np.array([label for _, _, label in rows])
    for number, tree in enumerate(model.trees):
        times = R.draws(np.array([key[i] for i, _, _ in rows]), number)
        want = plain_tree(bins, y, times, number, 5, 2, missing, 2, 4, 9)
        assert len(tree.feature) == len(want)
        for i, (f, b, side, left, right, share) in enumerate(want):
            assert (tree.feature[i], tree.bin[i], bool(tree.missing_left[i]), tree.left[i], tree.right[i]) == (f, b, side, left, right)
            assert tree.value[i] == pytest.approx(share)


def test_classes_weigh_the_same_in_every_tree(spark):
    _, df = frame(spark, 300)
    model = R.balanced_forest(df, "x", "label", "id", 5, trees=20, max_depth=3)
    assert len(model.trees) == 20
    for t in model.trees:
        assert t.value[0] == pytest.approx([0.5, 0.5])
    drawn = [R.draws(np.arange(4000) * 7919, t) for t in range(20)]
    assert abs(np.mean(drawn) - 1) < 0.02 and abs(np.var(drawn) - 1) < 0.05
    assert abs(np.corrcoef(drawn)[0, 1]) < 0.06


def test_rare_class_is_found(spark):
    rows, df = frame(spark, 600, 5, missing=False)
    model = R.balanced_forest(df, "x", "label", "id", 5, trees=30, max_depth=6)
    got = R.predict(model, df, "x").agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.avg(F.when(F.col("label") == 1, (F.col("prediction") == 1).cast("double"))).alias("recall")).first()
    assert got.accuracy > 0.93 and got.recall > 0.95


def test_odd_rows_and_empty_tables(spark):
    schema = "id long, x array<double>, label string, prediction_ string"
    df = spark.createDataFrame([(1, [0.0, 1.0], "a", "k"), (1, [0.0, 1.0], "a", "k"), (2, None, "b", None), (3, [1.0], None, None),
                                (None, [float("nan"), None], "b", None), (4, [5.0, 1.0], "b", "k"), (5, [float("inf"), -1.0], "a", "k")], schema)
    model = R.balanced_forest(df, "x", "label", "id", 2, trees=5, max_depth=3, min_leaf=1)
    out = R.predict(model, df, "x")
    assert model.classes == ["a", "b"] and out.count() == 7 and out.columns == [*df.columns, "probability", "prediction"]
    assert out.where("prediction NOT IN ('a', 'b') OR prediction IS NULL").count() == 0
    none = R.balanced_forest(df.limit(0), "x", "label", "id", 2, trees=2)
    assert none.classes == [] and [r.prediction for r in R.predict(none, df, "x").collect()] == [None] * 7


def shares(spark, df, **kw):
    out = R.forest_shares(df, df.select("id", "label", "x"), "x", "label", "id", 5, **kw)
    return {r.id: (r.probability, r.prediction) for r in out.collect()}


@pytest.mark.parametrize("small, task_bytes, round_bytes", [(4096, 64 << 20, 2 << 30), (40, 4000, 30000), (0, 64 << 20, 2 << 30)])
def test_deep_trees_equal_a_plain_recursion(spark, monkeypatch, small, task_bytes, round_bytes):
    """The same trees whether nodes are split in passes over all rows or in the task that holds them."""
    for name, v in (("SMALL", small), ("TASK_BYTES", task_bytes), ("ROUND_BYTES", round_bytes)):
        monkeypatch.setattr(R, name, v)
    rows, df = frame(spark)
    df = df.withColumn("w", F.when(F.col("label") == 1, 3.0).otherwise(0.5))
    got = shares(spark, df, trees=4, max_depth=30, min_leaf=2, weight="w", seed=9, max_bins=12)
    edges = B.bin_edges(df, "x", 5, 11)
    missing = B._missing(edges)
    key = {r.id: r.k for r in df.select("id", F.xxhash64("id", F.lit(9)).alias("k")).collect()}
    bins = np.array([[missing if v is None else np.searchsorted(e, v, "left") for v, e in zip(x, edges)] for _, x, _ in rows])
    y, scale = np.array([int(label) for _, _, label in rows]), np.array([0.5, 3.0])
    want, depths = np.zeros((len(rows), 2)), []

    def grow(at, times, asked, number, place):
        c = np.bincount(y[at], times[at], 2)
        best = (B.MIN_GAIN, None)
        if place.bit_length() <= 30 and (place == 1 or (c > 0).all() and c.sum() >= 4):
            def purity(c):
                return ((c * scale) ** 2).sum() / (c * scale).sum()

            for side in (False, True):
                for f in R.chosen_features(9, number, place, 5, 2):
                    for b in range(missing - 1):
                        left = np.where(bins[:, f] == missing, side, bins[:, f] <= b)
                        a, z = (np.bincount(y[s], times[s], 2) for s in (at[left[at]], at[~left[at]]))
                        if min(a.sum(), z.sum()) >= 2 and purity(a) + purity(z) - purity(c) > best[0] + 1e-9:
                            best = (purity(a) + purity(z) - purity(c), left)
        if best[1] is None:
            want[asked] += c * scale / (c * scale).sum() / 4
            depths.append(place.bit_length() - 1)
            return
        for i, left in enumerate((best[1], ~best[1])):
            grow(at[left[at]], times, asked[left[asked]], number, 2 * place + i)

    for t in range(4):
        times = R.draws(np.array([key[i] for i, _, _ in rows]), t)
        grow(np.flatnonzero(times), times, np.arange(len(rows)), t, 1)
    assert max(depths) > 4
    for (i, _, _), p in zip(rows, want):
        assert got[i][0] == pytest.approx(p, abs=1e-9)
        assert abs(p[0] - p[1]) < 1e-9 or got[i][1] == float(p.argmax())


def test_deep_forest_predicts_like_the_one_of_pyspark(spark):
    from tessera.operators import models as MD

    _, df = frame(spark, 600, 5, missing=False)
    learn, check = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    out = R.forest_shares(learn, check, "x", "label", "id", 5, trees=60)
    m = MD.random_forest(MD.with_features(learn, array_col="x"), num_trees=60, max_depth=30, feature_subset="sqrt")
    right = F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("r")
    mine, theirs = out.agg(right).first().r, m.transform(MD.with_features(check, array_col="x")).agg(right).first().r
    assert mine > 0.9 and abs(mine - theirs) < 0.04


def test_deep_forest_on_odd_rows(spark):
    schema = "id long, x array<double>, label string"
    df = spark.createDataFrame([(1, [0.0, 1.0], "a"), (1, [0.0, 1.0], "a"), (2, None, "b"), (3, [1.0], None),
                                (None, [float("nan"), None], "b"), (4, [5.0, 1.0], "b"), (5, [float("inf"), -1.0], "a")], schema)
    out = R.forest_shares(df, df, "x", "label", "id", 2, trees=5, min_leaf=1).collect()
    assert len(out) == 7 and out[0].__fields__ == [*df.columns, "probability", "prediction"]
    assert all(r.prediction in ("a", "b") for r in out)
    none = R.forest_shares(df.limit(0), df, "x", "label", "id", 2, trees=2).collect()
    assert [r.prediction for r in none] == [None] * 7
    assert R.forest_shares(df, df.limit(0), "x", "label", "id", 2, trees=2).count() == 0


def test_rf_loan_fits_trees_in_tasks(spark, registry, tmp_path, monkeypatch):
    """No fit by ``pyspark.ml``, whose driver holds and sends every node of 800 deep trees."""
    from tessera.operators import models as MD

    monkeypatch.setattr(MD, "random_forest", lambda *a, **k: pytest.fail("fitted on the driver"))
    rng = np.random.default_rng(1)
    spark.createDataFrame([(i, [float(v) for v in rng.normal(size=64)], i % 10) for i in range(60)],
                          "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = registry["rf_loan"].build(spark, str(tmp_path)).collect()
    assert {r.label: r.support for r in rows}["accuracy"] == 18


def test_the_driver_gets_splits_not_tables(spark, monkeypatch):
    """A level sends a row of numbers per node, whatever the tables of counts (features x bins x classes) hold."""
    got, chosen = [], B._chosen

    def spied(*args):
        got.append(chosen(*args))
        return got[-1]

    monkeypatch.setattr(R, "_chosen", spied)
    _, df = frame(spark)
    model = R.balanced_forest(df.repartition(20), "x", "label", "id", 5, trees=6, max_depth=3)
    assert got and all(len(t.feature) > 1 for t in model.trees)
    assert sum(sum(len(a) for a in sums) for sums in got) <= sum(len(t.feature) for t in model.trees) * (4 + 2 * 2)


@pytest.mark.parametrize("seed, tree, width, m", [(42, 0, 64, 8), (9, 3, 5, 2), (7, 799, 3, 3), (0, 0, 1, 1), (42, 1, 300, 17)])
def test_features_of_many_nodes_are_those_of_each(seed, tree, width, m):
    nodes = np.r_[np.arange(200), np.random.default_rng(1).integers(1, 1 << 31, 300), [(1 << 32) - 1, 1 << 32, 1 << 40]]
    got = R.features_of_nodes(seed, tree, nodes, width, m)
    assert got.tolist() == [R.chosen_features(seed, tree, int(n), width, m).tolist() for n in nodes]


def test_tables_that_fit_a_task_need_no_pass_over_the_rows(spark, monkeypatch):
    """Each task gets the rows once for all its trees; passes and one copy of the rows a tree are for larger
    tables, with the same shares."""
    _, df = frame(spark, 5000)
    monkeypatch.setattr(R, "SMALL", 1500)
    want = shares(spark, df, trees=5, seed=9, max_bins=12)
    monkeypatch.undo()
    monkeypatch.setattr(R, "_by_levels", lambda *a, **k: pytest.fail("a pass over all rows"))
    assert shares(spark, df, trees=5, seed=9, max_bins=12) == want
