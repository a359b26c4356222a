"""Histogram boosting and AdaBoost against plain NumPy loops over the rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.operators import boosting as B
from tessera.operators import series as S

SCHEMA = "id long, x array<double>, y double"


def sample(n=300, seed=0, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)  # few distinct values: ties and equal bins
    y = ((x[:, 0] + x[:, 1] ** 2 + 0.3 * rng.normal(size=n)) > 0.5).astype(float)
    x[rng.random(x.shape) < missing] = np.nan
    return x, y


def frame(spark, x, y):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def sigmoid(m):
    return 1 / (1 + np.exp(-m))


def plain_boost(x, y, edges, rounds, rate, depth, lam=1.0, min_child=1.0):
    """Margins after every round; every split is tried by summing over the rows."""
    margin, out = np.zeros(len(y)), []
    for _ in range(rounds):
        p = sigmoid(margin)
        g, h = p - y, p * (1 - p)
        step = np.zeros(len(y))

        def grow(rows, level):
            step[rows] = -rate * g[rows].sum() / (h[rows].sum() + lam)
            if level == depth:
                return
            best = (1e-6, None)
            score = lambda r: g[r].sum() ** 2 / (h[r].sum() + lam)
            for miss_left in (False, True):
                for f, edge in enumerate(edges):
                    for e in edge:
                        v = x[rows, f]
                        left = np.where(np.isnan(v), miss_left, v <= e).astype(bool)
                        a, b = rows[left], rows[~left]
                        if min(h[a].sum(), h[b].sum()) < min_child:
                            continue
                        gain = 0.5 * (score(a) + score(b) - score(rows))
                        if gain > best[0] + 1e-10:
                            best = (gain, (a, b))
            if best[1]:
                grow(best[1][0], level + 1)
                grow(best[1][1], level + 1)

        grow(np.arange(len(y)), 0)
        margin = margin + step
        out.append(margin.copy())
    return out


def scores(model, df, trees=None):
    rows = B.predict(model, df, "x", trees).orderBy("id").collect()
    return np.array([r.score for r in rows]), np.array([r.prediction for r in rows])


def test_boost_equals_plain_loops(spark):
    x, y = sample()
    df = frame(spark, x, y)
    model = B.boost(df, "x", "y", 3, rounds=4, rate=0.6, max_depth=3, keep_every=3)
    want = plain_boost(x, y, model.edges, 4, 0.6, 3)
    for n in (1, 4):
        got, classes = scores(model, df, n)
        assert got == pytest.approx(want[n - 1], abs=1e-9)
        assert (classes == (want[n - 1] > 0)).all()
    for epoch, loss, val_loss, acc, val_acc in model.history:
        q = sigmoid(want[epoch - 1])
        assert loss == pytest.approx(-np.mean(y * np.log(q) + (1 - y) * np.log(1 - q)))
        assert acc == pytest.approx(np.mean((q > 0.5) == (y > 0))) and val_loss is None and val_acc is None


def test_edges_hold_all_distinct_values_of_small_columns(spark):
    x, y = sample(missing=0.0)
    for f, e in enumerate(B.bin_edges(frame(spark, x, y), "x", 3)):
        values = np.unique(x[:, f])
        assert set(e) <= set(values[:-1]) and len(e) >= 0.5 * len(values)


def test_validation_history_and_patience(spark):
    x, y = sample(400, 3)
    df = frame(spark, x, y)
    learn, check = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    model = B.boost(learn, "x", "y", 3, rounds=12, rate=0.9, max_depth=3, validation=check, patience=2)
    assert all(None not in h for h in model.history)
    assert [h[0] for h in model.history] == list(range(1, len(model.trees) + 1))
    for n in (1, len(model.trees)):
        _, classes = scores(model, check, n)
        assert model.history[n - 1][4] == pytest.approx(np.mean(classes == y[::4]))
    history = spark.createDataFrame([(1, *h) for h in model.history], "s int, epoch int, tl double, vl double, ta double, va double")
    stop = [r.epoch for r in S.early_stop(history, ["s"], "epoch", "va", patience=2).where("stop_here").collect()]
    assert stop == ([len(model.trees)] if len(model.trees) < 12 else stop)


def plain_adaboost(x, y, edges, rounds, rate):
    x = np.where(np.isnan(x), np.inf, x)
    w, out = np.ones(len(y)) / len(y), []
    for _ in range(rounds):
        best = (np.inf,)
        for f, edge in enumerate(edges):
            for e in [*edge, x[np.isfinite(x[:, f]), f].max()]:
                left = x[:, f] <= e
                sides = [np.array([w[s & (y == c)].sum() for c in (0, 1)]) for s in (left, ~left)]
                if min(s.sum() for s in sides) < 1e-12:
                    continue
                impurity = sum(s.sum() - (s ** 2).sum() / s.sum() for s in sides)
                if impurity < best[0] - 1e-12:
                    best = (impurity, left, *(int(s[1] > s[0]) for s in sides))
        _, left, cl, cr = best
        wrong = np.where(left, cl, cr) != y
        error = min(max(w[wrong].sum() / w.sum(), 1e-10), 1 - 1e-10)
        alpha = rate * math.log((1 - error) / error)
        w = w * np.exp(alpha * wrong)
        w /= w.sum()
        out.append((error, alpha))
    return out


def test_adaboost_equals_plain_loops(spark):
    x, y = sample(200, 5)
    model = B.adaboost(frame(spark, x, y), "x", "y", 3, rounds=15, learning_rate=0.8, keep_every=4)
    want = plain_adaboost(x, y, model.edges, 15, 0.8)
    assert [h[0] for h in model.history] == list(range(1, 16))
    for (_, error, alpha), (e, a) in zip(model.history, want):
        assert (error, alpha) == (pytest.approx(e, abs=1e-9), pytest.approx(a, abs=1e-7))


def test_adaboost_fits_better_than_one_stump(spark):
    x, y = sample(300, 7)
    df = frame(spark, x, y)
    model = B.adaboost(df, "x", "y", 3, rounds=30)
    assert np.mean(scores(model, df)[1] == y) > np.mean(scores(model, df, 1)[1] == y)


def test_importances_name_the_useful_features(spark):
    x, y = sample(300, 9)
    model = B.boost(frame(spark, x, y), "x", "y", 3, rounds=3, max_depth=2)
    ranked = B.importances(model, ["a", "b", "noise"])
    assert sum(v for _, v in ranked) == pytest.approx(1.0) and ranked[-1][0] == "noise"


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0], 0.0), (2, None, 1.0), (3, [1.0], 1.0), (4, [1.0, None, float("nan")], 0.0),
            (5, [2.0, 2.0, 2.0], None), (6, [2.0, 2.0, 2.0], 7.0), (7, [9.0, 2.0, 3.0], 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for model in (B.boost(df, "x", "y", 3, rounds=2), B.adaboost(df, "x", "y", 3, rounds=2)):
        assert len(scores(model, df)[0]) == 7


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert [t.value.tolist() for t in B.boost(df, "x", "y", 3, rounds=1).trees] == [[0.0]]
    assert B.adaboost(df, "x", "y", 3, rounds=2).trees == []


def test_table_sums_do_not_depend_on_partitions(spark):
    rows = spark.range(1000).repartition(40)

    def part(batches):
        return np.array([float(sum(b.column(0).to_numpy().sum() for b in batches)), 1.0])

    assert list(B._summed(rows, part, 2)) == [499500.0, 40.0]


def test_splits_are_chosen_before_the_driver(spark, monkeypatch):
    """Only the best split of a span leaves the tasks, not the tables of sums."""
    got, chosen = [], B._chosen

    def spied(*args):
        got.append(chosen(*args))
        return got[-1]

    monkeypatch.setattr(B, "_chosen", spied)
    x, y = sample(400, 11, missing=0.0)
    x = np.random.default_rng(3).normal(size=x.shape)  # many bins
    df = frame(spark, x, y).repartition(20)
    B.boost(df, "x", "y", 3, rounds=1, max_depth=2)
    B.adaboost(df, "x", "y", 3, rounds=1)
    assert got and all(sum(len(a) for a in sums) <= 6 + 3 * 2 * len(B.SPLIT) for sums in got)


def test_small_tables_are_added_in_one_task(spark, tmp_path, monkeypatch):
    """A round sends the driver one task's result beside those of the tasks that hold rows, not
    one for every few features; large tables are still dealt over several tasks."""
    spans, chosen, stored = [], B._chosen, B._stored

    def spied(rows, n, part, choose, parts):
        spans.append((n, parts))
        return chosen(rows, n, part, choose, parts)

    def scattered(df, name):
        return stored(df.repartition(6), name).repartition(6)

    monkeypatch.setattr(B, "_chosen", spied)
    monkeypatch.setattr(B, "_stored", scattered)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 20))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], float(x[i, 0] > 0)) for i in range(300)], "id long, x array<double>, y double")
    model = B.adaboost(df, "x", "y", 20, rounds=2)
    assert len(model.trees) == 2 and model.trees[0].feature[0] == 0
    assert spans == [(6, 1)] * 2
    assert len(B._spans(64, 6, B.SPAN_BYTES)) == B.SPANS and len(B._spans(64, 1, B.SPAN_BYTES)) == 1
    for n, each in ((64, 8192), (3, 1), (5, B.SPAN_BYTES // 2)):
        cuts = B._spans(n, 6, each)
        assert [a for a, _ in cuts] + [n] == [0] + [b for _, b in cuts] and all(a < b for a, b in cuts)
