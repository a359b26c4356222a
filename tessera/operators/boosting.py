"""Boosting on binned features (M13, M15, M27): histogram trees and stumps.

Features are cut into bins once; a row then holds one byte per feature.  A pass over the rows
sums what the rows of each (node, feature, bin) carry; each task adds its rows up in NumPy,
the tasks' tables are added by spans of features in a tree of bounded fan-in, and the best split
of each span is chosen where its sums are.  Only these reach the driver, not the tables.

``boost`` grows second-order trees level by level: gradients and Hessians of the logistic
loss, regularised gain, Newton leaves, and for missing values (null or NaN) the better side.
``adaboost`` needs one pass a round: weighted counts per (feature, bin, class) give both the
best stump and its error.  A row's margin or weight is stored every ``keep_every`` rounds and
brought up to date in between from the trees since then, so a round costs the same early and
late, and a lost executor repeats one pass over the last stored table.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have the package

FAN = 16
SPANS = 16
SPAN_BYTES = 1 << 20
COLUMNS = 64
ACCURACY = 10_000
CLIP = 1e-10
MIN_GAIN = 1e-6


@dataclass(frozen=True)
class Tree:
    """Nodes of a tree: rows whose bin of ``feature`` is at most ``bin`` (or missing, if
    ``missing_left``) go left; a leaf has feature -1."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def place(self, bins: np.ndarray, missing: int) -> np.ndarray:
        """The leaf (or node without children) of each row."""
        node = np.zeros(len(bins), np.int64)
        while True:
            f = self.feature[node]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return node
            at = node[inner]
            b = bins[inner, f[inner]]
            left = np.where(b == missing, self.missing_left[at], b <= self.bin[at])
            node[inner] = np.where(left, self.left[at], self.right[at])


@dataclass(frozen=True)
class Model:
    """Bin edges per feature, trees, and the score of a row without any."""

    edges: list[np.ndarray]
    trees: list[Tree]
    base: float = 0.0
    history: list[tuple] = field(default_factory=list)

    @property
    def missing(self) -> int:
        return _missing(self.edges)


def bin_edges(df: DataFrame, features: str, width: int, max_bins: int = 255) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: distinct approximate quantiles, one pass for
    ``COLUMNS`` features.  The top value is no edge, so n edges make n + 1 bins."""
    probs = [i / max_bins for i in range(1, max_bins)]
    edges = []
    for start in range(0, width, COLUMNS):
        some = range(start, min(start + COLUMNS, width))
        value = {i: F.nanvl(F.get(features, F.lit(i)).cast("double"), F.lit(None)) for i in some}
        row = df.where(F.size(features) == width).agg(*[F.percentile_approx(v, probs, ACCURACY).alias(f"q{i}") for i, v in value.items()],
                     *[F.max(v).alias(f"m{i}") for i, v in value.items()]).first()
        edges += [np.array(sorted({q for q in row[f"q{i}"] or () if q < row[f"m{i}"]})) for i in some]
    return edges


def _to_bins(column: pa.Array, edges, missing: int) -> np.ndarray:
    """Bins (rows x features) of an array column; short or null arrays have missing values."""
    out = np.full((len(column), len(edges)), missing, np.uint8)
    lengths = column.value_lengths().fill_null(0).to_numpy()
    whole = np.flatnonzero(lengths == len(edges))
    values = column.take(pa.array(whole)).flatten().cast(pa.float64())
    values = values.to_numpy(zero_copy_only=False).reshape(len(whole), len(edges))
    for i, e in enumerate(edges):
        v = values[:, i]
        out[whole, i] = np.where(np.isnan(v), missing, np.searchsorted(e, v, "left"))
    return out


def _missing(edges) -> int:
    """The bin of missing values, the last of all."""
    return max(2, 1 + max(map(len, edges), default=0))


def _binned(df: DataFrame, features: str, edges, columns) -> DataFrame:
    """``bins`` (one byte a feature) and the given columns (name -> Column)."""
    missing = _missing(edges)
    names = list(columns)

    def run(batches):
        for b in batches:
            bins = _to_bins(b.column(0), edges, missing)
            rows = pa.array([r.tobytes() for r in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([rows, *b.columns[1:]], ["bins", *names])

    x = df.select(F.col(features).cast("array<double>").alias("x"), *[c.alias(n) for n, c in columns.items()])
    schema = T.StructType([T.StructField("bins", T.BinaryType()), *x.schema.fields[1:]])
    return x.mapInArrow(run, schema).hint("rebalance")  # files of even size, few for few rows


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _spans(n: int, parts: int, each: int) -> list[tuple[int, int]]:
    """``n`` things with ``each`` bytes of sums in consecutive spans: one for a single task, else at
    most ``SPANS``, as many as have ``SPAN_BYTES``, since every span is a task in every pass."""
    cuts = np.linspace(0, n, (1 if parts <= 1 else max(1, min(SPANS, n, n * each // SPAN_BYTES))) + 1).astype(int).tolist()
    return list(zip(cuts, cuts[1:]))


def _chosen(rows: DataFrame, n: int, part, choose, spans: int) -> list[np.ndarray]:
    """``choose(i, sums)`` per span: ``part`` (batches -> an array per span) runs in each of the
    ``n`` tasks, their arrays are added per span in groups of ``FAN`` until few are left, and the
    last adding is dealt by span and chooses there.  Only what is chosen reaches the driver."""
    def packed(arrays):
        return pa.RecordBatch.from_arrays([pa.array(list(arrays), pa.int32()), pa.array([x.tobytes() for x in arrays.values()], pa.binary())], ["span", "sums"])

    def partial(batches):
        yield packed(dict(enumerate(map(np.ravel, part(batches)))))

    def total(batches):
        out = {}
        for b in batches:
            for span, sums in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(sums.as_buffer())
                if span in out:
                    out[span] += x
                else:
                    out[span] = x.copy()
        return out

    def added(batches):
        yield packed(total(batches))

    def last(batches):
        yield packed({i: np.ravel(choose(i, x)).astype(float) for i, x in total(batches).items()})

    def alone(batches):
        yield packed({i: np.ravel(choose(i, np.ravel(x))).astype(float) for i, x in enumerate(part(batches))})

    schema = "span int, sums binary"
    if not n:
        return [choose(i, np.ravel(x)) for i, x in enumerate(part([]))]
    if n == 1:
        out = rows.mapInArrow(alone, schema)
    else:
        sums = rows.mapInArrow(partial, schema)
        while n > FAN:
            n = -(-n // FAN)
            sums = sums.repartition(n).mapInArrow(added, schema)
        out = sums.repartition(spans, "span").mapInArrow(last, schema)
    found = {r[0]: np.frombuffer(r[1]) for r in out.collect()}
    return [found[i] for i in range(spans)]


def _summed(rows: DataFrame, part, size: int) -> np.ndarray:
    """The sum over all tasks of the arrays of ``size`` that ``part`` (batches -> array) gives,
    for sums small enough for the driver."""
    return _chosen(rows, rows.rdd.getNumPartitions(), lambda batches: [part(batches)], lambda _, sums: sums, 1)[0].reshape(size)


def _table(node: np.ndarray, nodes: int, bins: np.ndarray, n_bins: int, carried) -> np.ndarray:
    """Sums of each carried array per (node, feature, bin)."""
    out = np.zeros((len(carried), nodes, bins.shape[1], n_bins))
    for f in range(bins.shape[1]):
        key = node * n_bins + bins[:, f]
        for c, values in enumerate(carried):
            out[c, :, f] = np.bincount(key, values, nodes * n_bins).reshape(nodes, n_bins)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def best_splits(table: np.ndarray, lam: float, gamma: float, min_child: float):
    """(gain, feature, bin, missing left) per node of gradient and Hessian sums (2 x nodes x
    features x bins, the last bin for missing values); ties go to the first feature and bin."""
    g, h = table
    g_all, h_all = g.sum(axis=2)[..., None], h.sum(axis=2)[..., None]
    out = None
    for missing_left in (False, True):
        gl, hl = np.cumsum(g[..., :-2], axis=2), np.cumsum(h[..., :-2], axis=2)
        if missing_left:
            gl, hl = gl + g[..., -1:], hl + h[..., -1:]
        gr, hr = g_all - gl, h_all - hl
        gain = 0.5 * (gl ** 2 / (hl + lam) + gr ** 2 / (hr + lam) - g_all ** 2 / (h_all + lam)) - gamma
        gain = np.where((hl >= min_child) & (hr >= min_child), gain, -np.inf)
        flat = gain.reshape(len(gain), -1)
        at = flat.argmax(axis=1)
        top = flat[np.arange(len(flat)), at]
        f, b = np.divmod(at, gain.shape[2])
        here = [top, f, b, np.full(len(top), missing_left)]
        out = here if out is None else [np.where(top > out[0], x, y) for x, y in zip(here, out)]
    return out


# What is known of a node's best split: gradient and Hessian sums of the node and both sides.
SPLIT = ("gain", "missing_left", "feature", "bin", "g", "h", "g_left", "h_left", "g_right", "h_right")


def _split_rows(table: np.ndarray, first: int, lam: float, gamma: float, min_child: float) -> np.ndarray:
    """The best split per node (nodes x SPLIT) of the sums of the features from ``first`` on."""
    gain, f, b, missing_left = best_splits(table, lam, gamma, min_child)
    whole = table[:, :, 0].sum(axis=2)
    return np.array([(gain[i], missing_left[i], first + f[i], b[i], *whole[:, i],
                      *(x for side in _sides(table[:, i, int(f[i])], int(b[i]), bool(missing_left[i])) for x in side))
                     for i in range(table.shape[1])])


def _best_of(found: np.ndarray) -> np.ndarray:
    """The best split per node of all spans (spans x nodes x SPLIT), ties as in ``best_splits``; the
    node's own sums are those of the first feature."""
    order = np.lexsort((found[:, :, 1], -found[:, :, 0]), axis=0)[0]
    best = found[order, np.arange(found.shape[1])]
    best[:, 4:6] = found[0, :, 4:6]
    return best


class _Growing:
    """A tree under construction."""

    def __init__(self):
        self.columns = {"feature": [-1], "bin": [0], "missing_left": [False], "left": [0], "right": [0],
                        "value": [0.0], "gain": [0.0]}

    def split(self, node: int, **chosen) -> tuple[int, int]:
        left = len(self.columns["feature"])
        for name, v in chosen.items():
            self.columns[name][node] = v
        self.columns["left"][node], self.columns["right"][node] = left, left + 1
        for name, v in _Growing().columns.items():
            self.columns[name] += 2 * v
        return left, left + 1

    def tree(self) -> Tree:
        return Tree(**{k: np.array(v) for k, v in self.columns.items()})


def boost(train: DataFrame, features: str, label: str, width: int, rounds: int = 100, rate: float = 0.6,
          max_depth: int = 6, lam: float = 1.0, gamma: float = 0.0, min_child: float = 1.0, max_bins: int = 255,
          validation: DataFrame | None = None, patience: int | None = None, keep_every: int = 10) -> Model:
    """Gradient boosting with the second-order, regularised objective of the logistic loss.

    Labels are 0 and 1; rows with another or a null label are left out.  ``history`` holds
    (epoch, train_loss, val_loss, train_acc, val_acc) of the model's first ``epoch`` trees;
    with ``patience`` the rounds end when the validation accuracy has not improved for so
    many epochs.  One pass a level; the first level's pass also measures the epoch before.
    """
    edges = bin_edges(train, features, width, max_bins)
    missing = _missing(edges)
    n_bins = missing + 1
    rows = train.select(features, label, F.lit(True).alias("learn"))
    if validation is not None:
        rows = rows.unionByName(validation.select(features, label, F.lit(False).alias("learn")))
    rows = rows.where(F.col(label).isin(0, 1))
    rows = _stored(_binned(rows, features, edges, {"y": F.col(label).cast("double"), "learn": F.col("learn"), "margin": F.lit(0.0)}), "boost")

    def margins(b, recent):
        bins = _unpacked(b.column(0), width)
        m = b.column(3).to_numpy().copy()
        for t in recent:
            m += t.value[t.place(bins, missing)]
        return bins, m

    def level(recent, growing, slot, nodes):
        """One level: metrics of the rows, and the best split per node (a row of ``SPLIT``)."""
        n = rows.rdd.getNumPartitions()
        spans = _spans(width, n, 2 * nodes * n_bins * 8)

        def part(batches):
            metrics, table = np.zeros(6), np.zeros((2, nodes, width, n_bins))
            for b in batches:
                bins, m = margins(b, recent)
                y, learn = b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
                p = _sigmoid(m)
                q = np.clip(p, 1e-15, 1 - 1e-15)
                loss = -(y * np.log(q) + (1 - y) * np.log(1 - q))
                for at, rows_ in ((0, learn), (3, ~learn)):
                    metrics[at:at + 3] += rows_.sum(), loss[rows_].sum(), ((m > 0) == (y > 0))[rows_].sum()
                node = slot[growing.place(bins, missing)]
                use = learn & (node >= 0)
                table += _table(node[use], nodes, bins[use], n_bins, ((p - y)[use], (p * (1 - p))[use]))
            return [*(table[:, :, lo:hi] for lo, hi in spans), metrics]

        def choose(i, sums):
            if i == len(spans):
                return sums
            lo, hi = spans[i]
            return _split_rows(sums.reshape(2, nodes, hi - lo, n_bins), lo, lam, gamma, min_child)

        *found, metrics = _chosen(rows, n, part, choose, len(spans) + 1)
        return metrics, _best_of(np.array(found).reshape(len(spans), nodes, len(SPLIT)))

    def measured(epoch, sums):
        means = [float(sums[i + j] / sums[i]) if sums[i] else None for i in (0, 3) for j in (1, 2)]
        return epoch, means[0], means[2], means[1], means[3]

    trees, recent, history, best, since, stop = [], [], [], 0.0, 0, rounds == 0
    for epoch in range(rounds + 1):
        growing, open_nodes, total = _Growing(), [0], None
        for depth in range(max_depth + 1):
            tree = growing.tree()
            slot = np.full(len(tree.feature), -1)
            slot[open_nodes] = np.arange(len(open_nodes))
            if depth == 0 or depth < max_depth and open_nodes:
                metrics, splits = level(recent, tree, slot, max(1, len(open_nodes)))
            if depth == 0 and epoch:
                history.append(measured(epoch, metrics))
                accuracy = history[-1][4] or 0.0
                best, since = (accuracy, 0) if accuracy > best else (best, since + 1)
                stop = epoch == rounds or (patience is not None and since >= patience)
            if depth == max_depth or not open_nodes or stop:
                break
            later = []
            for node, (gain, missing_left, f, b, g, h, *sides) in zip(open_nodes, splits.tolist()):
                growing.columns["value"][node] = -rate * g / (h + lam) if h + lam else 0.0
                if gain > MIN_GAIN:
                    children = growing.split(node, feature=int(f), bin=int(b), missing_left=bool(missing_left), gain=gain)
                    for child, cg, ch in zip(children, sides[::2], sides[1::2]):
                        growing.columns["value"][child] = -rate * cg / (ch + lam)
                    later += children
            open_nodes = later
        if stop:
            break
        trees.append(growing.tree())
        recent.append(trees[-1])
        if len(recent) == keep_every:
            rows, recent = _stored(_updated(rows, recent, width, missing), "boost"), []
    return Model(edges, trees, 0.0, history)


def _sides(table: np.ndarray, b: int, missing_left: bool):
    """(gradient, Hessian) sums left and right of a split of one feature's (2 x bins) table."""
    left = table[:, :b + 1].sum(axis=1) + (table[:, -1] if missing_left else 0.0)
    return tuple(left), tuple(table.sum(axis=1) - left)


def _updated(rows: DataFrame, recent, width: int, missing: int) -> DataFrame:
    """The rows with the margins of the recent trees added."""
    def run(batches):
        for b in batches:
            bins, m = _unpacked(b.column(0), width), b.column(3).to_numpy().copy()
            for t in recent:
                m += t.value[t.place(bins, missing)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(m)], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def predict(model: Model, df: DataFrame, features: str, trees: int | None = None, out_col: str = "prediction",
            score_col: str = "score") -> DataFrame:
    """``df`` with the score (sum of the first ``trees`` trees' values) and the class, 1 where
    the score is positive.  A row without a readable feature array has missing values."""
    edges, missing, chosen, base = model.edges, model.missing, model.trees[:trees], model.base
    at = df.columns.index(features)

    def run(batches):
        for b in batches:
            bins = _to_bins(b.column(at), edges, missing)
            score = np.full(b.num_rows, base)
            for t in chosen:
                score += t.value[t.place(bins, missing)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), pa.array((score > 0).astype(float))],
                                             [*b.schema.names, score_col, out_col])

    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType()), T.StructField(out_col, T.DoubleType())])
    return df.mapInArrow(run, schema)


def importances(model: Model, names) -> list[tuple[str, float]]:
    """Mean gain of the splits on each feature as a share of all, largest first."""
    total, splits = np.zeros(len(names)), np.zeros(len(names))
    for t in model.trees:
        inner = t.feature >= 0
        np.add.at(total, t.feature[inner], t.gain[inner])
        np.add.at(splits, t.feature[inner], 1)
    mean = total / np.maximum(splits, 1)
    share = mean / mean.sum() if mean.sum() else mean
    return sorted(zip(names, map(float, share)), key=lambda x: (-x[1], x[0]))


def best_stump(table: np.ndarray):
    """(feature, bin, class left, class right, weighted error) of the split with the least Gini
    impurity of class weights (2 x features x bins); None if no split parts the rows."""
    found = _stump(table)
    return found and found[1:]


def _stump(table: np.ndarray):
    """The impurity and what ``best_stump`` returns."""
    left = np.cumsum(table, axis=2)[..., :-1]
    right = table.sum(axis=2)[..., None] - left
    n_left, n_right = left.sum(axis=0), right.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        impurity = n_left - (left ** 2).sum(axis=0) / n_left + n_right - (right ** 2).sum(axis=0) / n_right
    # A side of rounding dust only is empty.
    dust = 1e-12 * table.sum(axis=(0, 2))[:, None]
    impurity = np.where((n_left > dust) & (n_right > dust), impurity, np.inf)
    if not np.isfinite(impurity).any():
        return None
    f, b = divmod(int(impurity.argmin()), impurity.shape[1])
    sides = left[:, f, b], right[:, f, b]
    error = sum(s.min() for s in sides) / table[:, f].sum()
    return float(impurity[f, b]), f, b, *(int(s[1] > s[0]) for s in sides), float(error)


def adaboost(train: DataFrame, features: str, label: str, width: int, rounds: int = 200,
             learning_rate: float = 0.8, max_bins: int = 255, keep_every: int = 10) -> Model:
    """AdaBoost (SAMME, two classes) with depth-1 trees.

    Each round: the stump of least weighted Gini impurity, its weighted error e (clipped to
    [1e-10, 1 - 1e-10]), alpha = rate x ln((1 - e) / e), wrong rows' weights x exp(alpha).
    ``history`` holds (round, error, alpha).  A missing value counts as above every bin.  A
    tree's values are -alpha and alpha, so the class is the sign of their sum.  A round whose
    classes cannot be parted ends the rounds.  Rows with another label than 0 or 1 are left out.
    """
    edges = bin_edges(train, features, width, max_bins)
    missing = _missing(edges)
    n_bins = missing + 1
    rows = train.where(F.col(label).isin(0, 1))
    rows = _stored(_binned(rows, features, edges, {
        "y": F.col(label).cast("double"), "learn": F.lit(True), "margin": F.lit(0.0)}), "adaboost")

    def stump_of(recent):
        """The best stump, None if no split parts the rows, and the sum of the weights."""
        n = rows.rdd.getNumPartitions()
        spans = _spans(width, n, 2 * n_bins * 8)

        def part(batches):
            # ``margin`` is the logarithm of a row's weight, up to a constant for all rows.
            table = np.zeros((2, 1, width, n_bins))
            for b in batches:
                bins, y = _unpacked(b.column(0), width), b.column(1).to_numpy()
                w = np.exp(_log_weights(b.column(3).to_numpy(), bins, y, recent, missing))
                table += _table(np.zeros(len(y), np.int64), 1, bins, n_bins, (w * (y == 0), w * (y == 1)))
            return [table[:, 0, lo:hi] for lo, hi in spans]

        def choose(i, sums):
            lo, hi = spans[i]
            table = sums.reshape(2, hi - lo, n_bins)
            impurity, f, *rest = _stump(table) or (np.inf, 0, 0, 0, 0, 0.0)
            return np.array([impurity, lo + f, *rest, table[:, 0].sum()])

        found = _chosen(rows, n, part, choose, len(spans))
        impurity, f, b, left, right, error, _ = min(found, key=lambda x: x[0])  # ties: the first feature
        return (int(f), int(b), int(left), int(right), float(error)) if np.isfinite(impurity) else None, float(found[0][-1])

    trees, recent, history, scale = [], [], [], 0.0
    for r in range(rounds):
        stump, weights = stump_of([*recent, scale])
        if stump is None:
            break
        f, b, left, right, error = stump
        error = min(max(error, CLIP), 1 - CLIP)
        alpha = learning_rate * math.log((1 - error) / error)
        history.append((r + 1, error, alpha))
        value = [0.0, alpha if left else -alpha, alpha if right else -alpha]
        trees.append(Tree(*map(np.array, ([f, -1, -1], [b, 0, 0], [False] * 3, [1, 0, 0], [2, 0, 0], value, [0.0] * 3))))
        recent.append(trees[-1])
        scale -= math.log(weights)  # keeps the weights near a sum of 1
        if len(recent) == keep_every:
            rows, recent = _stored(_reweighted(rows, recent + [scale], width, missing), "adaboost"), []
            scale = 0.0
    return Model(edges, trees, 0.0, history)


def _log_weights(start: np.ndarray, bins: np.ndarray, y: np.ndarray, recent, missing: int) -> np.ndarray:
    """Log weights after the recent stumps; the last entry is the scale."""
    *stumps, scale = recent
    out = start + scale
    for t in stumps:
        value = t.value[t.place(bins, missing)]
        out = out + np.where((value > 0) != (y > 0), np.abs(value), 0.0)
    return out


def _reweighted(rows: DataFrame, recent, width: int, missing: int) -> DataFrame:
    def run(batches):
        for b in batches:
            w = _log_weights(b.column(3).to_numpy(), _unpacked(b.column(0), width), b.column(1).to_numpy(), recent, missing)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(w)], b.schema.names)

    return rows.mapInArrow(run, rows.schema)
