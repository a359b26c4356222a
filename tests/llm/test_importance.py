"""Importance resampling against plain counts, and its odd cases."""

import numpy as np
import pyarrow as pa

from tessera.llm import importance as I
from util import frame, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark):
    good = [(i, prose(i, 80), "en", "s", None) for i in range(60)]
    bad = [(100 + i, " ".join(w + "***" for w in prose(i, 80).split()), "en", "s", None) for i in range(20)]
    labels = [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(5)]
    return frame(spark, good + bad), frame(spark, labels, LABELS)


def test_junk_goes_and_prose_stays(spark):
    docs, labels = corpus(spark)
    kept = {r.doc_id for r in I.select(docs, labels).collect()}
    assert kept == set(range(60))


def test_toxic_prose_goes(spark):
    """Good prose with a few insults in a long harmless rest, labelled and not."""
    insults = ("idiot", "scum", "trash")
    rows, marks = [], []
    for i in range(900):
        toxic = i % 9 == 0
        text = prose(i, 150).split()
        for n in range(3 * toxic):
            text.insert(40 * n + 7, insults[(i // 9 + n) % 3])
        rows.append((i, " ".join(text), "en", "s", None))
        if i % 2:
            marks.append((i, 1, int(toxic)))
    docs, labels = frame(spark, rows), frame(spark, marks, LABELS)
    kept = {r.doc_id for r in I.select(docs, labels).collect()}
    good, bad = {i for i in range(900) if i % 9}, {i for i in range(900) if i % 9 == 0}
    assert len(good & kept) >= 0.97 * len(good) and len(bad & kept) <= 0.1 * len(bad)


def test_floor_keeps_good_and_rejects_bad():
    good, bad = np.arange(100.0) - 1, np.append(np.full(40, -6.0), 50.0)
    assert I.calibrate(good, bad) == -1 - I.MARGIN
    assert I.calibrate(np.append(good, -500.0), bad) == -1 - I.MARGIN  # one odd good label
    assert I.calibrate(good[:0], bad) == I.calibrate(good[:0], bad[:0]) == -I.MARGIN


def test_exactly_k_are_sampled_and_weights_equal_plain_sums(spark):
    docs, labels = corpus(spark)
    rows = I.resample(docs, labels, k=17).collect()
    assert sum(r.kept for r in rows) == 17
    cut = min(r.score for r in rows if r.kept)
    assert all(r.kept == (r.score >= cut) for r in rows)
    ratios = I.fit(docs, labels)
    for r in rows[:10]:
        text = docs.where(f"doc_id = {r.doc_id}").first().text
        bucket, _ = I.features(pa.array([text]))
        assert len(bucket) == r.n_grams and np.isclose(ratios[bucket].sum(), r.log_weight)


def test_kth_largest_with_ties(spark):
    values = [5, 5, 5, -3, -(1 << 40), 1 << 50, 0, 7]
    df = frame(spark, [(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        assert I.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_order_of_doubles():
    x = np.array([-1e300, -2.5, -0.0, 0.0, 1e-300, 3.0, 1e300])
    assert (np.diff(I._order(x)) >= 0).all()


def test_odd_documents(spark, odd, none):
    labels = frame(spark, [(7, 1, None), (None, 1, 0), (6, None, 1)], LABELS)
    out = I.resample(odd, labels).collect()
    assert len(out) == odd.count()
    assert all(r.log_weight == 0 and r.kept for r in out if r.doc_id in (1, 2, 3))
    assert len({r.score for r in out if r.doc_id == 7}) == 1  # repeated rows share their noise
    empty = frame(spark, [], LABELS)
    assert all(r.log_weight == 0 for r in I.resample(odd, empty).collect())
    assert I.select(none, labels).count() == 0 and I.select(none, empty).columns == none.columns


def test_clashing_columns(spark):
    docs, labels = corpus(spark)
    clash = docs.withColumnRenamed("source", "score").withColumnRenamed("lang", "score_order")
    assert I.select(clash, labels).columns == clash.columns
