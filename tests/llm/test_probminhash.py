"""Near duplicates against brute force over all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tessera.llm import probminhash as P
from tessera.llm.common import utf8_parts
from tessera.llm.components import components
from util import frame, odd_documents, prose, words


def similarity(x, y):
    """Probability Jaccard similarity of two weighted sets, from its definition."""
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in set(x) & set(y))


def brute(rows):
    """Class of each row: smallest id over chains of texts with a similarity >= 0.8 of 5-word
    shingles, n occurrences weighing 1 + ln n."""
    sets = []
    for i, text in rows:
        w = words(text)
        counts = Counter(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else None
        sets.append({k: 1 + math.log(n) for k, n in counts.items()} if w else None)
    to = list(range(len(rows)))

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and set(sets[a]) & set(sets[b]) and similarity(sets[a], sets[b]) >= 0.8 - 1e-9:
                to[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) if sets[k] else rows[k][0] for k in range(len(rows))]


def near_copies(seed=3):
    rng = random.Random(seed)
    rows, i = [], 0
    for base in range(12):
        text = prose(base, 120).split()
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.randrange(0, 9)):
                copy[rng.randrange(len(copy))] = prose(rng.randrange(10**6), 1)
            rows.append((i, " ".join(copy)))
            i += 1
        rows.append((i, " ".join(text)))
        rows.append((i + 1, " ".join(text).upper() + "!"))
        i += 2
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_copies()
    got = {r.doc_id: r for r in P.near_duplicates(frame(spark, rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert [got[i].class_id for i, _ in rows] == want
    assert all(got[i].kept == (w == i) for (i, _), w in zip(rows, want))


def test_repeated_lines_equal_brute_force(spark):
    """Pairs that differ in how often a passage repeats: few repeats are near, many are not."""
    rows, repeats = [], [2, 2, 3, 40, 400]
    for base in range(50):
        text = prose(base, 104).split()
        rows.append((2 * base, " ".join(text)))
        rows.append((2 * base + 1, " ".join(text[:52] + text[52:] * repeats[base % 5])))
    got = {r.doc_id: r.class_id for r in P.near_duplicates(frame(spark, rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert [got[i] for i, _ in rows] == want and 0 < sum(w % 2 for w in want) < 50


def test_probability_jaccard_equals_its_definition():
    rng = np.random.default_rng(8)
    pairs, sides = [], ([], [])
    for pair in range(60):
        both = []
        for side in sides:
            names = rng.choice(30, rng.integers(0, 25), replace=False)
            x = {int(k): 1 + math.log(n) for k, n in zip(names, rng.integers(1, 5, len(names)))}
            side += [(k, pair, w) for k, w in x.items()]
            both.append(x)
        pairs.append(both)
    arrays = [(np.array([r[0] for r in s], np.uint64), np.array([r[1] for r in s]), np.array([r[2] for r in s])) for s in sides]
    assert np.allclose(P.probability_jaccard(*arrays, 60), [similarity(x, y) for x, y in pairs])
    some = np.arange(10, dtype=np.uint64)  # of sets it is their Jaccard similarity
    a, b = (some[:9], np.zeros(9, int), np.ones(9)), (some[1:], np.zeros(9, int), np.ones(9))
    assert P.probability_jaccard(a, b, 1) >= 0.8 - 1e-9 and abs(P.probability_jaccard(a, b, 1)[0] - 0.8) < 1e-12


def test_links_inside_a_tile_join_what_brute_force_joins(monkeypatch):
    texts = [t for _, t in near_copies(11)]
    values, owner, _, _ = P.shingles(*utf8_parts(pa.array(texts)))
    values, owner, weight = P.weighted(values, owner)
    agree = np.full((len(texts), len(texts)), P.AGREE, np.uint8)
    np.fill_diagonal(agree, 0)
    want = brute(list(enumerate(texts)))
    for cells in (1 << 20, 500):
        monkeypatch.setattr(P, "PAIR_CELLS", cells)
        links = P._links(values, owner, weight, agree, np.arange(len(texts)))
        to = list(range(len(texts)))
        for i, j in links:
            to = [min(to[i], to[j]) if t in (to[i], to[j]) else t for t in to]
        assert to == want and len(links) == len(texts) - len(set(want))


def test_tiles_of_long_texts_hold_fewer_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "TILE_BYTES", 2000)
    rows = near_copies(7)
    got = {r.doc_id: r.class_id for r in P.near_duplicates(frame(spark, rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_tiles_of_one_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(P, "TILE", 8)
    rows = near_copies(5)
    got = {r.doc_id: r.class_id for r in P.near_duplicates(frame(spark, rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(4)
    x, y = rng.integers(1, 6, (2, 40)).astype(float)
    x[:8], y[-8:] = 0, 0
    names = rng.integers(0, 1 << 62, 40).astype(np.uint64)
    terms = [1 / np.maximum(x / x[k], y / y[k]).sum() for k in range(40) if x[k] and y[k]]
    agree = []
    for trial in range(40):
        v = names + np.uint64(trial * 1000003)
        values = np.concatenate([v[x > 0], v[y > 0]])
        owner = np.repeat([0, 1], [(x > 0).sum(), (y > 0).sum()])
        s = P.signatures(values, owner, np.concatenate([x[x > 0], y[y > 0]]), 2)
        assert s.all()
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - sum(terms)) < 0.03


def test_early_end_fills_every_component():
    v = np.array([7], np.uint64)
    assert P.signatures(v, np.zeros(1, int), np.ones(1), 1, time=-4.0).all()


def test_shingles_of_short_and_empty_texts():
    values, owner, classes, counts = P.shingles(*utf8_parts(pa.array(["a b", None, "A, b!", "a b c d e f", ""])))
    assert counts.tolist() == [2, 0, 2, 6, 0] and sorted(owner.tolist()) == [0, 2, 3, 3]
    assert classes[0, 0] == classes[0, 2] and not classes[:, 1].any()


def test_odd_documents(spark, odd, none):
    rows = P.near_duplicates(odd).collect()
    assert len(rows) == len(odd_documents())
    for i in (1, 2, 3, 4):  # no words: similar to nothing
        assert [r.class_id for r in rows if r.doc_id == i] == [i]
    assert {r.class_id for r in rows if r.doc_id in (7, 8)} == {7}
    assert sum(r.kept for r in rows if r.doc_id == 9) == 2  # one id on two texts
    kept = P.deduplicate(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, 4, 5, 6, 7, 9, 9, 10, 11, None, None], key=repr)
    assert P.near_duplicates(none).count() == 0 and P.deduplicate(none).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", "k"), (2, "a b c", "l")], "doc_id long, text string, text_key string")
    out = P.deduplicate(df)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (201, 200)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
