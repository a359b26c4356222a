"""Hard negatives (Strassen tiles) and exact top-k (norm buckets) against plain loops."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tessera.llm import normbuckets, strassen, tiles

VECTORS = "vec_id long, embedding array<double>, label int"


def usable(rows, scale):
    """(id or infinity, label, integers) of the rows that take part."""
    out = []
    for vec_id, e, label in rows:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            out.append((math.inf if vec_id is None else vec_id, label, [math.floor(scale * x) for x in e]))
    return out


def shown(i):
    return None if i == math.inf else i


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_negatives(rows, scale=256, every=100):
    use = [r for r in usable(rows, scale) if r[1] is not None]
    out = []
    for n, (aid, label, a) in enumerate(use):
        if aid == math.inf or aid % every:
            continue
        scored = [(-dot(a, v), i, m, lab) for m, (i, lab, v) in enumerate(use) if m != n and len(v) == len(a)]
        for p, pid, _, _ in sorted(x for x in scored if x[3] == label)[:5]:
            window = sorted(x for x in scored if x[3] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)[:5]
            out += [(aid, shown(pid), rank, shown(i), -p, -s) for rank, (s, i, _, _) in enumerate(window, 1)]
    return sorted(out, key=repr)


def brute_top(rows, k=10, scale=1024, every=100):
    use = usable(rows, scale)
    out = []
    for n, (qid, _, q) in enumerate(use):
        if qid == math.inf or qid % every:
            continue
        scored = sorted((-dot(q, v), i, m) for m, (i, _, v) in enumerate(use) if m != n and len(v) == len(q))
        out += [(qid, rank, shown(i), -s) for rank, (s, i, _) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, schema=VECTORS, **more):
    df = strassen.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0, **more)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def searched(spark, rows, schema=VECTORS, **more):
    df = normbuckets.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0, **more)
    return sorted((tuple(r[c] for c in ["query_id", "rank", "vec_id", "score"]) for r in df.collect()), key=repr)


def cloud(n, width, seed, spread=0.0):
    """Vectors around few directions, lengths spread by a log-normal factor."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, width))
    v = base[rng.integers(0, 6, n)] + 0.4 * rng.normal(size=(n, width))
    v *= (np.exp(spread * rng.normal(size=n)) / np.linalg.norm(v, axis=1))[:, None]
    return [(i * 5, [float(x) for x in v[i]], int(rng.integers(0, 4))) for i in range(n)]


ODD = [
    (100, [0.5, 0.25], 1), (100, [0.5, 0.25], 1), (1, [0.5, 0.25], 1), (2, [0.5, 0.25], 2), (3, [0.5, 0.2], 2), (4, [0.5, 0.25], 2),
    (5, None, 1), (6, [0.1, None], 1), (7, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2), (9, [0.0, 0.0], 2), (10, [-1.0, 3.0], 1),
    (None, [0.5, 0.25], 2), (None, [0.5, 0.25], 1), (200, [], 1), (11, [], 1), (12, [], 2), (300, [1.0, 2.0, 3.0], 1), (13, [1.0, 2.0, 3.0], 2),
    (400, [0.0, 0.0], 1), (14, [0.4, 0.4], None), (500, [0.4, 0.4], None), (600, [-0.5, -0.25], 7), (601, [-0.5, 0.5], 7), (-100, [0.5, 0.25], 3),
]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 70), st.integers(0, 70), st.integers(0, 70), st.integers(1, 40), st.integers(0, 2 ** 32))
def test_strassen_equals_the_plain_product(n, m, p, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-2 ** 28, 2 ** 28, (n, m)), rng.integers(-2 ** 28, 2 ** 28, (m, p))
    assert (strassen.product(a, b, leaf) == a @ b).all()


def test_odd_rows(spark):
    assert mined(spark, ODD) == brute_negatives(ODD)
    assert searched(spark, ODD) == brute_top(ODD)


def test_empty_tables(spark):
    assert mined(spark, []) == [] and searched(spark, []) == []


def test_other_columns_may_clash(spark):
    names = ["row", "width", "side", "score", "part", "block", "length", "class", "rank", "id"]
    schema = VECTORS + "".join(f", {c} string" for c in names)
    rows = [(*r, *["x"] * len(names)) for r in ODD]
    assert mined(spark, rows, schema) == brute_negatives(ODD)
    assert searched(spark, rows, schema) == brute_top(ODD)


def test_huge_components_do_not_crash(spark):
    rows = [(100, [1e300, -1e300], 1), (1, [1e300, 1.0], 1), (2, [1e200, 1e200], 2)]
    assert len(searched(spark, rows)) == 2
    mined(spark, rows)


@pytest.mark.parametrize("width,spread", [(4, 0.0), (4, 1.0), (33, 0.3)])
def test_equal_to_loops(spark, monkeypatch, width, spread):
    rows = cloud(700, width, 3, spread) + cloud(300, width, 4)  # ids repeat
    # Small tiles: every block meets every part, and lists of several tiles are merged.
    for module in (strassen, normbuckets):
        monkeypatch.setattr(module, "TILE_ROWS", 90)
        monkeypatch.setattr(module, "QUERY_BYTES", 8 * width * 20)
    monkeypatch.setattr(normbuckets, "BUCKET", 32)
    assert mined(spark, rows) == brute_negatives(rows)
    assert searched(spark, rows) == brute_top(rows)


def test_a_label_with_most_rows_and_many_copies(spark, monkeypatch):
    rows = cloud(200, 8, 5) + [(10_000 + i, [0.3] * 8, 0) for i in range(400)]
    monkeypatch.setattr(strassen, "TILE_ROWS", 64)
    monkeypatch.setattr(normbuckets, "TILE_ROWS", 64)
    assert mined(spark, rows) == brute_negatives(rows)
    assert searched(spark, rows) == brute_top(rows)


def test_every_kind_of_pruning_is_used_and_loses_nothing():
    rng = np.random.default_rng(8)
    width, k = 6, 3
    base = rng.normal(size=(40, width))  # tight directions: high local thresholds
    vectors = base[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, width))
    vectors *= (np.where(rng.random(4000) < 0.2, 0.3, 1.0) / np.linalg.norm(vectors, axis=1))[:, None]
    vectors = np.floor(1024 * vectors).astype(np.int64)
    length = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    asked = np.arange(0, 4000, 100)
    batch = pa.RecordBatch.from_pydict({
        "row": asked, "vec_id": asked, "width": np.full(len(asked), width, np.int32), "length": length[asked],
        "vector": pa.array(list(vectors[asked]), pa.list_(pa.int64())), "threshold": np.full(len(asked), tiles.LOWEST)})
    q = normbuckets.Queries(batch, k)
    order = np.argsort(-length, kind="stable")
    used = np.zeros(3, int)
    for start in range(0, 4000, 250):
        at = order[start:start + 250]
        used += normbuckets._search(q, normbuckets.Bucket(vectors[at], length[at], at, at))
    assert (used > 0).all(), used
    for slot, i in enumerate(asked):
        scores = vectors @ vectors[i]
        others = np.delete(np.arange(4000), i)
        best = others[np.lexsort((others, -scores[others]))[:k]]
        assert list(q.best.id[q.best.slot == slot]) == list(best)


def test_best_lists_merge():
    rng = np.random.default_rng(2)
    slot, score, ids = rng.integers(0, 5, 300), rng.integers(-3, 4, 300), rng.integers(0, 50, 300)
    whole, parts = tiles.Best(5, 4), tiles.Best(5, 4)
    whole.add(slot, score, ids, np.arange(300))
    for start in range(0, 300, 37):
        s = slice(start, start + 37)
        parts.add(slot[s], score[s], ids[s], np.arange(300)[s])
    for name in ("slot", "score", "id", "row"):
        assert (getattr(whole, name) == getattr(parts, name)).all()
