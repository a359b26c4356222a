"""Random forests: class weights balanced inside each tree's own sample (M9), or given.

Each tree draws every row Poisson(1) times, by a hash of the row's id and the tree, so a
repeated pass or a lost executor sees the same sample.  A class weighs n / (k x n_c) in the
tree's sample (n rows, k classes present), so all classes weigh the same in every tree; fixed
weights balance the whole frame only.

Trees grow together, level by level.  A pass counts the drawn rows per (node, chosen feature,
bin, class); weights are applied to the counts afterwards, so the first level's counts give
them without a pass of their own.  Tasks add up in NumPy, the tables are added by spans of nodes
in a tree of bounded fan-in and splits are chosen where the sums are (``boosting``).  A pass takes
as many nodes as fit ``TABLE_BYTES``; the driver gets a node's split and holds the model.

``forest_shares`` (M10) is for trees as deep as the rows allow, whose nodes grow with the table.  While
both tables fit a task (``WHOLE_BYTES``) each goes once to every group of trees, whose task grows its trees
one after the other and adds up the shares of the rows to be predicted.  Larger tables: only nodes
of more rows than fit a task are split in passes as above; the rows of the others are shuffled by (tree, node), the
rest of the tree is grown there, and the rows to be predicted, shuffled alike, are placed in it at once.  No
place holds the whole model.  In a task all open nodes of a level are split together, on arrays.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import MIN_GAIN, Tree, _binned, _chosen, _missing, _spans, _stored, _to_bins, _unpacked, bin_edges

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have the package

TABLE_BYTES = 16 << 20
SMALL = 1 << 20
SLICE = 256
CHUNK = 1 << 14
WHOLE_BYTES = 64 << 20
TASK_BYTES = 64 << 20
ROUND_BYTES = 2 << 30
UNIT = 1 << 40
GROUPS = pa.schema([("part", pa.int32()), ("asked", pa.bool_()), ("bins", pa.binary()), ("numbers", pa.binary()), ("keys", pa.binary())])
GROUPS_SQL = "part int, asked boolean, bins binary, numbers binary, keys binary"
DEALT = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("asked", pa.bool_()), ("bins", pa.binary()), ("numbers", pa.binary()), ("times", pa.binary())])
DEALT_SQL = "tree int, node int, asked boolean, bins binary, numbers binary, times binary"
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


@dataclass(frozen=True)
class Forest:
    """Bin edges per feature, class labels in order, and trees whose values are class shares."""

    edges: list[np.ndarray]
    classes: list
    trees: list[Tree]


def draws(key: np.ndarray, tree: int) -> np.ndarray:
    """How often each row (by the hash of its id) is in the sample of a tree."""
    with np.errstate(over="ignore"):
        x = key.astype(np.int64).view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return np.searchsorted(POISSON, (x >> np.uint64(11)).astype(np.float64) / (1 << 53), "right")


def chosen_features(seed: int, tree: int, node: int, width: int, m: int) -> np.ndarray:
    """The features a node may split on, in order."""
    return np.sort(np.random.default_rng([seed, tree, node]).choice(width, m, replace=False))


def _step(high: np.ndarray, low: np.ndarray, add: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The next 128-bit states of PCG64, as halves."""
    a, b, half, mask = np.uint64(0x2360ED051FC65DA4), np.uint64(0x4385DF649FCCF645), np.uint64(32), np.uint64(0xFFFFFFFF)
    p, q, r, t = low & mask, low >> half, b & mask, b >> half
    x, y = p * r, q * r
    z = p * t + (x >> half)
    upper = q * t + (z >> half) + (((z & mask) + y) >> half) + low * a + high * b
    lower = low * b + add[1]
    return upper + add[0] + (lower < add[1]).astype(np.uint64), lower


def features_of_nodes(seed: int, tree: int, nodes: np.ndarray, width: int, m: int) -> np.ndarray:
    """``chosen_features`` of many nodes: the same steps of NumPy's generator on arrays.  The few that
    it draws again, and numbers or widths beyond its short form, are asked one by one."""
    nodes = np.asarray(nodes, np.int64)
    out = np.zeros((len(nodes), m), np.int64)
    alone = (nodes < 0) | (nodes >> 32 > 0)
    if width > 10_000 or not (0 <= seed < 1 << 32 and 0 <= tree < 1 << 32):
        alone[:] = True
    else:
        shift, mix_l, mix_r = np.uint32(16), np.uint32(0xCA01F9DD), np.uint32(0x4973F715)

        def constants(first, factor):
            while True:
                after = first * factor & 0xFFFFFFFF
                yield np.uint32(first), np.uint32(after)
                first = after

        def hashed(value, pair):
            value = (value ^ pair[0]) * pair[1]
            return value ^ (value >> shift)

        with np.errstate(over="ignore"):
            pairs = constants(0x43B0D7E5, 0x931E8875)
            words = [np.full(len(nodes), seed, np.uint32), np.full(len(nodes), tree, np.uint32), nodes.astype(np.uint32), np.zeros(len(nodes), np.uint32)]
            pool = [hashed(w, next(pairs)) for w in words]
            for i in range(4):
                for j in range(4):
                    if i != j:
                        mixed = mix_l * pool[j] - mix_r * hashed(pool[i], next(pairs))
                        pool[j] = mixed ^ (mixed >> shift)
            pairs = constants(0x8B51F9DD, 0x58F38DED)
            state = [hashed(pool[i % 4], next(pairs)).astype(np.uint64) for i in range(8)]
            start = [state[i] | state[i + 1] << np.uint64(32) for i in range(0, 8, 2)]
            one = np.uint64(1)
            add = start[2] << one | start[3] >> np.uint64(63), start[3] << one | one
            low = start[1] + add[1]
            high, low = _step(start[0] + add[0] + (low < add[1]).astype(np.uint64), low, add)
            held = []
            for place, top in enumerate(range(width - m, width)):
                value = np.zeros(len(nodes), np.uint64)
                if top:
                    if not held:
                        high, low = _step(high, low, add)
                        turn, word = high >> np.uint64(58), high ^ low
                        word = word >> turn | word << (np.uint64(64) - turn & np.uint64(63))
                        held = [word >> np.uint64(32), word & np.uint64(0xFFFFFFFF)]
                    scaled = held.pop() * np.uint64(top + 1)
                    alone |= (scaled & np.uint64(0xFFFFFFFF)) < np.uint64(((1 << 32) - top - 1) % (top + 1))
                    value = scaled >> np.uint64(32)
                value = value.astype(np.int64)
                taken = (out[:, :place] == value[:, None]).any(axis=1)
                out[:, place] = np.where(taken, top, value)
    for i in np.flatnonzero(alone):
        out[i] = chosen_features(seed, tree, int(nodes[i]), width, m)
    return np.sort(out, axis=1)


def _purity(counts: np.ndarray) -> np.ndarray:
    """Sum of squared class weights over their sum, 0 without rows: weight minus Gini impurity."""
    total = counts.sum(axis=-1)
    return (counts ** 2).sum(axis=-1) / np.where(total > 0, total, 1)


def gini_splits(table: np.ndarray, scale: np.ndarray, min_leaf: float):
    """(gain, place in the chosen features, bin, missing left) per node of class counts (nodes x
    features x bins x classes, the last bin for missing values) with the classes' weights (of all
    nodes or per node); ties go to missing right, then the first feature and bin."""
    sides = (False, True) if table[:, :, -1].any() else (False,)
    every = table.sum(axis=2)
    scale = np.broadcast_to(scale, (len(table), table.shape[3]))[:, None]
    before = _purity(every * scale)[..., None]
    scale = scale[:, None]
    out = None
    for missing_left in sides:
        left = np.cumsum(table[:, :, :-2], axis=2)
        if missing_left:
            left = left + table[:, :, -1:]
        right = every[:, :, None] - left
        gain = _purity(left * scale) + _purity(right * scale) - before
        gain = np.where((left.sum(axis=3) >= min_leaf) & (right.sum(axis=3) >= min_leaf), gain, -np.inf)
        flat = gain.reshape(len(gain), -1)
        at = flat.argmax(axis=1)
        f, b = np.divmod(at, gain.shape[2])
        here = [flat[np.arange(len(flat)), at], f, b, np.full(len(at), missing_left)]
        out = here if out is None else [np.where(here[0] > out[0], x, y) for x, y in zip(here, out)]
    return out


def _node_splits(table: np.ndarray, scale: np.ndarray, min_leaf: float) -> np.ndarray:
    """The best split per node (gain, place in the chosen features, bin, missing left, class counts of
    the node and of its left side) of counts as in ``gini_splits``."""
    gain, f, b, missing_left = gini_splits(table, scale, min_leaf)
    below = np.arange(table.shape[2]) <= b[:, None]
    below[:, -1] = missing_left
    left = (table[np.arange(len(table)), f] * below[..., None]).sum(axis=1)
    return np.column_stack([gain, f, b, missing_left, table[:, 0].sum(axis=1), left])


class _Grown:
    """A tree under construction: node columns as lists, and each node's place in the full binary
    tree (root 1, children of p: 2p and 2p + 1)."""

    def __init__(self, classes: int, root: int = 1):
        self.places = [root]
        self.leaf = {"feature": -1, "bin": 0, "missing_left": False, "left": 0, "right": 0,
                     "value": np.zeros(classes), "gain": 0.0}
        self.columns = {k: [v] for k, v in self.leaf.items()}

    def split(self, node: int, **chosen) -> tuple[int, int]:
        left = len(self.columns["feature"])
        for name, v in (chosen | {"left": left, "right": left + 1}).items():
            self.columns[name][node] = v
        for name, v in self.leaf.items():
            self.columns[name] += [v, v]
        self.places += [2 * self.places[node], 2 * self.places[node] + 1]
        return left, left + 1

    def divide(self, node: int, chosen: np.ndarray, split: np.ndarray, scale: np.ndarray, min_leaf: float):
        """Splits a node as a row of ``_node_splits`` says, unless it gains nothing; the children that
        may be split again and their drawn rows."""
        gain, f, b, missing_left, *counts = split
        if gain <= MIN_GAIN:
            return []
        k, open_nodes = len(scale), []
        left = np.array(counts[k:])
        sides = (left, counts[:k] - left)
        children = self.split(node, feature=int(chosen[int(f)]), bin=int(b), missing_left=bool(missing_left), gain=float(gain))
        for child, side in zip(children, sides):
            self.columns["value"][child] = _shares(side * scale)
            if np.count_nonzero(side) > 1 and side.sum() >= 2 * min_leaf:
                open_nodes.append((child, side.sum()))
        return open_nodes

    def tree(self) -> Tree:
        return Tree(**{k: np.array(v) for k, v in self.columns.items()})


def _splits(rows: DataFrame, asked, width: int, m: int, n_bins: int, classes: int, missing: int, min_leaf: int) -> np.ndarray:
    """The best split of each asked node (a row of ``_node_splits``).  Nodes are given per tree as
    (number, tree so far, slot of each of its nodes or -1, chosen features of its slots, class
    weights); weights of None are taken from the first node's counts."""
    sizes = [len(chosen) for _, _, _, chosen, _ in asked]
    owner = np.repeat(np.arange(len(asked)), sizes)
    n = rows.rdd.getNumPartitions()
    spans = _spans(sum(sizes), n, m * n_bins * classes * 8)

    def part(batches):
        tables = [np.zeros(s * m * n_bins * classes) for s in sizes]
        for b in batches:
            bins = _unpacked(b.column(0), width)
            y, key = b.column(1).to_numpy(), b.column(2).to_numpy()
            for (number, tree, slot, chosen, _), table in zip(asked, tables):
                times = draws(key, number)
                at = slot[tree.place(bins, missing)]
                use = np.flatnonzero((times > 0) & (at >= 0))
                here, weight, label = at[use], times[use].astype(float), y[use]
                for j in range(m):
                    cell = ((here * m + j) * n_bins + bins[use, chosen[here, j]]) * classes + label
                    table += np.bincount(cell, weight, len(table))
        table = np.concatenate(tables).reshape(-1, m, n_bins, classes)
        return [table[lo:hi] for lo, hi in spans]

    def choose(i, sums):
        table = sums.reshape(-1, m, n_bins, classes)
        drawn = table[:, 0].sum(axis=1)
        scale = np.array([class_scale(d) if asked[t][4] is None else asked[t][4] for d, t in zip(drawn, owner[slice(*spans[i])])])
        return _node_splits(table, scale, min_leaf)

    return np.concatenate([x.reshape(-1, 4 + 2 * classes) for x in _chosen(rows, n, part, choose, len(spans))])


def class_scale(drawn: np.ndarray) -> np.ndarray:
    """Class weights that balance the drawn rows per class."""
    return drawn.sum() / np.maximum(drawn, 1) / max(1, np.count_nonzero(drawn))


def balanced_forest(train: DataFrame, features: str, label: str, id_col: str, width: int, trees: int = 200,
                    max_depth: int = 10, min_leaf: int = 2, subset: int | None = None, seed: int = 42,
                    max_bins: int = 32) -> Forest:
    """M9: ``trees`` Gini trees on Poisson samples with classes balanced per tree.

    ``subset`` features are tried at each node (none: the square root of ``width``, at least
    1); a node none of whose features can be split is a leaf.  ``min_leaf`` counts drawn rows.
    Rows with a null label are left out; null, NaN or unreadable features are missing values,
    which go to the better side.  Rows of one id are drawn alike.  No labelled row gives a
    forest without classes, which predicts null.
    """
    rows = train.where(F.col(label).isNotNull())
    classes = sorted(r[0] for r in rows.select(label).distinct().collect())  # a row per class
    edges = bin_edges(rows, features, width, max_bins - 1)
    if not classes:
        return Forest(edges, [], [])
    missing = _missing(edges)
    n_bins, k, m = missing + 1, len(classes), min(width, subset or max(1, math.isqrt(width)))
    code = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, i)])[F.col(label)]
    rows = _stored(_binned(rows, features, edges, {"y": code.cast("long"), "key": F.xxhash64(F.col(id_col), F.lit(int(seed)))}), "forest")

    grown = [_Grown(k) for _ in range(trees)]
    _by_levels(rows, grown, [None] * trees, max_depth, width, m, n_bins, missing, min_leaf, lambda t, node: chosen_features(seed, t, node, width, m))
    return Forest(edges, classes, [g.tree() for g in grown])


def _by_levels(rows: DataFrame, grown: list[_Grown], scale: list, max_depth: int, width: int, m: int, n_bins: int,
               missing: int, min_leaf: float, pick, small: int = 0) -> list[tuple[int, int]]:
    """Grows the trees in passes over the rows, a level at a time.  Children of at most ``small``
    drawn rows are left as they are; returns those that may be split as (tree, node).  ``pick``
    chooses the features of (tree, node); class weights of None are set from the root's counts."""
    open_nodes, left_small = [(t, 0) for t in range(len(grown))], []
    k = len(grown[0].leaf["value"]) if grown else 0
    at_once = max(1, TABLE_BYTES // (m * n_bins * max(1, k) * 8))
    for depth in range(max_depth):
        later = []
        for start in range(0, len(open_nodes), at_once):
            nodes: dict = {}
            for t, node in open_nodes[start:start + at_once]:
                nodes.setdefault(t, []).append(node)
            asked = []
            for t, mine in nodes.items():
                tree = grown[t].tree()
                slot = np.full(len(tree.feature), -1)
                slot[mine] = np.arange(len(mine))
                asked.append((t, tree, slot, np.array([pick(t, n) for n in mine]), scale[t]))
            found, first = _splits(rows, asked, width, m, n_bins, k, missing, min_leaf), 0
            for (t, _, _, chosen, _), mine in zip(asked, nodes.values()):
                splits, first = found[first:first + len(mine)], first + len(mine)
                if depth == 0:
                    drawn = splits[0, 4:4 + k]
                    scale[t] = class_scale(drawn) if scale[t] is None else scale[t]
                    grown[t].columns["value"][0] = _shares(drawn * scale[t])
                for node, features, split in zip(mine, chosen, splits):
                    for child, drawn in grown[t].divide(node, features, split, scale[t], min_leaf):
                        (left_small if drawn <= small else later).append((t, child))
        open_nodes = later
    return left_small


def _class_splits(table: np.ndarray, scale: np.ndarray, min_leaf: float):
    """``_node_splits`` of counts with the classes first (classes x nodes x features x bins): gain, place,
    bin, missing left, counts of the nodes and of their left sides (classes x nodes)."""
    k, n, m, n_bins = table.shape

    def purity(counts):
        weights = [c * w for c, w in zip(counts, scale)]
        total, squares = weights[0], weights[0] ** 2
        for w in weights[1:]:
            total, squares = total + w, squares + w ** 2
        return squares / np.where(total > 0, total, 1)

    every = table.sum(axis=3)
    before, lefts, best = purity(every)[..., None], np.cumsum(table[..., :-2], axis=3), None
    for missing_left in (False, True) if table[..., -1].any() else (False,):
        left = lefts + table[..., -1:] if missing_left else lefts
        right = every[..., None] - left
        gain = purity(left) + purity(right) - before
        gain[(left.sum(axis=0) < min_leaf) | (right.sum(axis=0) < min_leaf)] = -np.inf
        flat = gain.reshape(n, -1)
        at = flat.argmax(axis=1)
        f, b = np.divmod(at, n_bins - 2)
        here = [flat[np.arange(n), at], f, b, np.full(n, missing_left), left[:, np.arange(n), f, b]]
        best = here if best is None else [np.where(here[0] > best[0], x, y) for x, y in zip(here, best)]
    return *best[:4], every[:, :, 0], best[4]


def _level_splits(bins, y, times, order, sizes, chosen, scale, n_bins: int, min_leaf: float):
    """The best splits of nodes whose rows follow each other in ``order``, some nodes at a time."""
    k, m = len(scale), chosen.shape[1]
    ends, flat, width = np.cumsum(sizes), bins.ravel(), bins.shape[1]
    column = np.arange(m) * n_bins
    for first in range(0, len(sizes), SLICE):
        last = min(first + SLICE, len(sizes))
        n, begin = last - first, ends[first] - sizes[first]
        table = np.zeros(k * n * m * n_bins)
        of = np.repeat(np.arange(n), sizes[first:last])
        for start in range(0, len(of), CHUNK):
            at = of[start:start + CHUNK]
            rows = order[begin + start:begin + start + len(at)]
            spot = chosen[first:last].take(at, axis=0)
            spot += (rows * width)[:, None]
            cell = ((y.take(rows) * n + at) * (m * n_bins))[:, None] + column
            cell += flat.take(spot)
            table += np.bincount(cell.ravel(), np.repeat(times.take(rows), m), len(table))
        yield _class_splits(table.reshape(k, n, m, n_bins), scale, min_leaf)


def _subtree(bins: np.ndarray, y: np.ndarray, times: np.ndarray, place: int, scale: np.ndarray, max_depth: int,
             n_bins: int, min_leaf: float, pick) -> Tree:
    """The tree below a place of the full binary tree on the rows drawn there, down to the level
    ``max_depth`` of the whole tree; ``pick`` chooses the features of places.  Every step is on arrays
    of all open nodes of a level, whose rows are kept together."""
    k, depth, missing = len(scale), place.bit_length() - 1, n_bins - 1

    def shares(counts):
        weights = (counts * scale[:, None]).T
        return weights / np.maximum(weights.sum(axis=1), 1e-300)[:, None]

    def leaves(n):
        return {"feature": np.full(n, -1), "bin": np.zeros(n, np.int64), "missing_left": np.zeros(n, bool), "left": np.zeros(n, np.int64),
                "right": np.zeros(n, np.int64), "gain": np.zeros(n)}

    levels, total = [leaves(1) | {"value": shares(np.bincount(y, times, k)[:, None])}], 1
    # Of the open nodes: their row in the last level, place and number of rows.
    at, places, sizes, order = np.array([0]), np.array([place], np.int64), np.array([len(y)]), np.arange(len(y))
    while len(at) and depth < max_depth:
        chosen = pick(places)
        gain, f, b, missing_left, every, left = (np.concatenate(x, axis=-1) for x in zip(
            *_level_splits(bins, y, times, order, sizes, chosen, scale, n_bins, min_leaf)))
        split = np.flatnonzero(gain > MIN_GAIN)
        if not len(split):
            break
        feature = chosen[split, f[split]]
        new = total + np.arange(2 * len(split))
        for name, v in (("feature", feature), ("bin", b[split]), ("missing_left", missing_left[split]), ("gain", gain[split]),
                        ("left", new[::2]), ("right", new[1::2])):
            levels[-1][name][at[split]] = v
        counts = np.stack([left[:, split], every[:, split] - left[:, split]], axis=2).reshape(k, -1)
        levels.append(leaves(2 * len(split)) | {"value": shares(counts)})
        total += 2 * len(split)
        open_ = (np.count_nonzero(counts, axis=0) > 1) & (counts.sum(axis=0) >= 2 * min_leaf)
        # Rows of split nodes, each node's left ones first.
        kept = np.repeat(gain > MIN_GAIN, sizes)
        order, of = order[kept], np.repeat(np.arange(len(split)), sizes[split])
        value = bins.ravel().take(order * bins.shape[1] + feature[of])
        goes = np.where(value == missing, missing_left[split][of], value <= b[split][of])
        n_left = np.bincount(of, goes, len(split)).astype(np.int64)
        child = np.stack([n_left, sizes[split] - n_left], axis=1).ravel()
        begin = np.cumsum(child) - child
        ranks = np.cumsum(goes)
        before = np.append(0, np.cumsum(n_left))[:-1]
        here = np.arange(len(of))
        to = np.where(goes, begin[::2][of] + ranks - 1 - before[of], begin[1::2][of] + (here - begin[::2][of]) - (ranks - before[of]))
        moved = np.empty_like(order)
        moved[to] = order
        order = moved[np.repeat(open_, child)]
        at, sizes = np.flatnonzero(open_), child[open_]
        places = np.stack([2 * places[split], 2 * places[split] + 1], axis=1).ravel()[open_]
        depth += 1
    return Tree(**{name: np.concatenate([x[name] for x in levels]) for name in levels[0]})


def _in_groups(rows: DataFrame, asked: DataFrame, features: str, edges, trees: int, groups: int, width: int, scale: np.ndarray, max_depth: int,
               n_bins: int, min_leaf: float, pick) -> DataFrame:
    """(_row, sums of shares) per group of trees: both tables, packed, go to each of ``groups`` tasks, which
    grow their trees one after the other and add up the shares of every row to be predicted."""
    missing, k = n_bins - 1, len(scale)

    def dealt(bins, numbers, keys):
        for g in range(groups):
            yield pa.RecordBatch.from_pylist([dict(zip(GROUPS.names, (g, keys is None, bins.tobytes(), numbers.tobytes(), b"" if keys is None else keys.tobytes())))], GROUPS)

    def learned(batches):
        for b in batches:
            yield from dealt(_unpacked(b.column(0), width), b.column(1).to_numpy(), b.column(2).to_numpy())

    def to_place(batches):
        for b in batches:
            yield from dealt(_to_bins(b.column(0), edges, missing), b.column(1).to_numpy(), None)

    def together(held):
        bins, numbers, keys = (b"".join(x) for x in zip(*held)) if held else (b"", b"", b"")
        held.clear()
        return np.frombuffer(bins, np.uint8).reshape(-1, width), np.frombuffer(numbers, np.int64), np.frombuffer(keys, np.int64)

    def shares_of(group, learn, check):
        bins, y, keys = together(learn)
        asked_bins, row, _ = together(check)
        if not len(row):
            return
        sums = np.zeros((len(row), k), np.int64)
        for t in range(group, trees, groups):
            times = draws(keys, t)
            use = np.flatnonzero(times)
            tree = _subtree(bins[use], y[use], times[use].astype(float), 1, scale, max_depth, n_bins, min_leaf, lambda places: pick(t, places))
            sums += np.round(tree.value * UNIT).astype(np.int64)[tree.place(asked_bins, missing)]
        for start in range(0, len(row), CHUNK):
            part = slice(start, start + CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array(row[part]), *(pa.array(sums[part, i]) for i in range(k))], ["_row", *(f"share_{i}" for i in range(k))])

    def grown(batches):
        at, held = None, ([], [])
        for b in batches:
            for r in b.to_pylist():
                if r["part"] != at:
                    if at is not None:
                        yield from shares_of(at, *held)
                    at, held = r["part"], ([], [])
                held[r["asked"]].append((r["bins"], r["numbers"], r["keys"]))
        if at is not None:
            yield from shares_of(at, *held)

    both = rows.mapInArrow(learned, GROUPS_SQL).unionByName(
        asked.select(F.col(features).cast("array<double>"), "_row").mapInArrow(to_place, GROUPS_SQL))
    # By range, so that each group has a task of its own.
    return both.repartitionByRange(groups, "part").sortWithinPartitions("part").mapInArrow(grown, f"_row long, {', '.join(f'share_{i} long' for i in range(k))}")


def forest_shares(train: DataFrame, test: DataFrame, features: str, label: str, id_col: str, width: int, trees: int = 800,
                  max_depth: int = 30, min_leaf: int = 2, weight: str | None = None, subset: int | None = None, seed: int = 42,
                  max_bins: int = 32, out_col: str = "prediction", prob_col: str = "probability") -> DataFrame:
    """``test`` with the mean class shares (in the order of the labels) and the class of the
    largest, ties to the first, of ``trees`` Gini trees grown on Poisson samples of ``train``.

    ``weight`` is a column with one weight per class (none: 1).  Features, missing values and
    samples are as in ``balanced_forest``; ``subset`` and ``min_leaf`` too.  A place in a tree has the same
    features whether it is split in a pass or in a task.  Shares are added as whole numbers of
    1/``UNIT``, so that the order of the trees does not matter.  Null without a labelled row.
    """
    train = train.where(F.col(label).isNotNull())
    known = train.groupBy(label).agg(F.max(weight).cast("double") if weight else F.lit(1.0), F.count("*")).collect()  # a row per class
    known = sorted((tuple(r) for r in known), key=lambda r: r[0])
    classes, k, n_train = [c for c, *_ in known], len(known), sum(n for *_, n in known)
    if not classes:
        return test.withColumn(prob_col, F.lit(None).cast("array<double>")).withColumn(out_col, F.lit(None).cast("double"))
    scale = np.array([w for _, w, _ in known])
    edges = bin_edges(train, features, width, max_bins - 1)
    missing = _missing(edges)
    n_bins, m = missing + 1, min(width, subset or max(1, math.isqrt(width)))
    code = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, i)])[F.col(label)]
    rows = _stored(_binned(train, features, edges, {"y": code.cast("long"), "key": F.xxhash64(F.col(id_col), F.lit(int(seed)))}), "forest")
    asked = _stored(test.withColumn("_row", F.monotonically_increasing_id()), "forest")

    def pick(t, places):
        return features_of_nodes(seed, t, places, width, m)

    small_rows = min(SMALL, max(4096, WHOLE_BYTES // (width + 16)))  # a task holds them
    of_a_tree = max(1, (n_train + asked.count()) * (width + 16))
    cores = train.sparkSession.sparkContext.defaultParallelism
    if n_train <= small_rows and of_a_tree <= WHOLE_BYTES:
        groups = max(1, min(trees, 3 * cores, max(cores, ROUND_BYTES // of_a_tree)))
        found = _in_groups(rows, asked, features, edges, trees, groups, width, scale, max_depth, n_bins, min_leaf, pick)
        total = _stored(found, "forest")
        return _averaged(asked, total, classes, trees, out_col, prob_col)
    grown = [_Grown(k) for _ in range(trees)]
    if n_train <= small_rows:
        small = [(t, 0) for t in range(trees)]
    else:
        small = _by_levels(rows, grown, [scale] * trees, max_depth, width, m, n_bins, missing, min_leaf,
                           lambda t, node: pick(t, [grown[t].places[node]])[0], small_rows)
    tops = [g.tree() for g in grown]
    unfinished = [np.zeros(len(t.feature), bool) for t in tops]
    for t, node in small:
        unfinished[t][node] = True
    places = [np.array(g.places) for g in grown]
    at_once = max(1, ROUND_BYTES // of_a_tree)
    shares = ", ".join(f"share_{i} long" for i in range(k))
    sums = []
    for start in range(0, trees, at_once):
        some = range(start, min(start + at_once, trees))
        n = max(cores, of_a_tree * len(some) // TASK_BYTES)

        def dealt(bins, numbers, of_tree):
            """A batch of packed rows per tree, with those of one node in one row."""
            for t in some:
                use, times = of_tree(t)
                node = tops[t].place(bins[use], missing)
                if times is not None:
                    kept = unfinished[t][node]
                    use, times, node = use[kept], times[kept], node[kept]
                order = np.argsort(node, kind="stable")
                cuts = np.flatnonzero(np.diff(node[order])) + 1
                groups = [g for g in np.split(order, cuts) if len(g)]
                packed = [(t, int(node[g[0]]), times is None, bins[use[g]].tobytes(), numbers[use[g]].tobytes(),
                           b"" if times is None else times[g].astype(np.uint8).tobytes()) for g in groups]
                yield pa.RecordBatch.from_pylist([dict(zip(DEALT.names, p)) for p in packed], DEALT)

        def drawn(batches):
            for b in batches:
                key = b.column(2).to_numpy()

                def of_tree(t):
                    times = draws(key, t)
                    use = np.flatnonzero(times)
                    return use, times[use]

                yield from dealt(_unpacked(b.column(0), width), b.column(1).to_numpy(), of_tree)

        def to_place(batches):
            for b in batches:
                bins = _to_bins(b.column(0), edges, missing)
                every = np.arange(len(bins))
                yield from dealt(bins, b.column(1).to_numpy(), lambda t: (every, None))

        def unpacked(numbers, bins, times):
            return (np.frombuffer(b"".join(bins), np.uint8).reshape(-1, width), np.frombuffer(b"".join(numbers), np.int64),
                    np.frombuffer(b"".join(times), np.uint8).astype(float))

        def shares_of(batches):
            """Rows come sorted by tree and node, those drawn first."""
            at, held, tree = None, [], None
            for b in batches:
                for r in b.to_pylist():
                    t, node = r["tree"], r["node"]
                    if (t, node) != at:
                        at, held, tree = (t, node), [], None
                    if not r["asked"]:
                        held.append((r["numbers"], r["bins"], r["times"]))
                        continue
                    if tree is None and held:
                        bins, y, times = unpacked(*zip(*held))
                        tree, held = _subtree(bins, y, times, int(places[t][node]), scale, max_depth, n_bins, min_leaf, lambda p: pick(t, p)), []
                    bins, row, _ = unpacked([r["numbers"]], [r["bins"]], [])
                    value = tree.value[tree.place(bins, missing)] if tree else np.broadcast_to(tops[t].value[node], (len(row), k))
                    whole = np.round(value * UNIT).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(row), *(pa.array(whole[:, i]) for i in range(k))],
                                                     ["_row", *(f"share_{i}" for i in range(k))])

        learned = rows.repartition(n).mapInArrow(drawn, DEALT_SQL)
        placed = asked.select(F.col(features).cast("array<double>"), "_row").repartition(n).mapInArrow(to_place, DEALT_SQL)
        both = learned.unionByName(placed).repartition(n, "tree", "node").sortWithinPartitions("tree", "node", "asked")
        found = both.mapInArrow(shares_of, f"_row long, {shares}")
        sums.append(_stored(found.groupBy("_row").agg(*[F.sum(f"share_{i}").alias(f"share_{i}") for i in range(k)]), "forest"))
    return _averaged(asked, reduce(DataFrame.unionByName, sums), classes, trees, out_col, prob_col)


def _averaged(asked: DataFrame, sums: DataFrame, classes: list, trees: int, out_col: str, prob_col: str) -> DataFrame:
    """``asked`` with the mean of its rows' sums of shares and the class of the largest."""
    k = len(classes)
    total = sums.groupBy("_row").agg(
        F.array(*[F.sum(f"share_{i}") / F.lit(float(UNIT) * trees) for i in range(k)]).alias(prob_col))
    best = F.array_position(prob_col, F.array_max(prob_col)).cast("int")
    return asked.join(total, "_row", "left").drop("_row").withColumn(out_col, F.element_at(F.array(*[F.lit(c) for c in classes]), best))


def _shares(weights: np.ndarray) -> np.ndarray:
    return weights / max(weights.sum(), 1e-300)


def predict(model: Forest, df: DataFrame, features: str, out_col: str = "prediction",
            prob_col: str = "probability") -> DataFrame:
    """``df`` with the mean class shares of the trees' leaves (in the order of the model's
    classes) and the class of the largest, ties to the first."""
    edges, trees, missing, k = model.edges, model.trees, _missing(model.edges), len(model.classes)
    at = df.columns.index(features)

    def run(batches):
        for b in batches:
            bins = _to_bins(b.column(at).cast(pa.list_(pa.float64())), edges, missing)
            total = np.zeros((len(bins), k))
            for t in trees:
                total += t.value[t.place(bins, missing)]
            flat = pa.array((total / max(1, len(trees))).ravel())
            shares = pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1, dtype=np.int32) * k), flat)
            yield pa.RecordBatch.from_arrays([*b.columns, shares], [*b.schema.names, prob_col])

    schema = T.StructType([*df.schema.fields, T.StructField(prob_col, T.ArrayType(T.DoubleType()))])
    out = df.mapInArrow(run, schema)
    if not k:
        return out.withColumn(out_col, F.lit(None).cast("double"))
    best = F.array_position(prob_col, F.array_max(prob_col)).cast("int")
    return out.withColumn(out_col, F.element_at(F.array(*[F.lit(c) for c in model.classes]), best))
