"""Decontamination against a plain search, with blocks, short items and odd cases."""

import hashlib
import time

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tessera.llm import suffixes as S
from util import frame, odd_documents, prose, words

ITEMS = "item_id long, text string"


def brute(docs, items, window=10):
    out = {}
    for k, (i, text) in enumerate(docs):
        w, hit, found = words(text), set(), set()
        for item, t in items:
            b = words(t)
            m = min(window, len(b))
            if item is None or not m:
                continue
            wins = {tuple(b[j:j + m]) for j in range(len(b) - m + 1)}
            for j in range(len(w) - m + 1):
                if tuple(w[j:j + m]) in wins:
                    hit |= set(range(j, j + m))
                    found.add(str(item))
        out[k] = (i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return sorted(out.values(), key=repr)


def case():
    items = [(i, prose(i, 25)) for i in range(8)] + [(20, "tiny item"), (21, prose(1, 25)), (22, None), (23, ""), (None, prose(3, 30)), (20, "Tiny, ITEM!")]
    docs = [(100 + i, prose(50 + i, 40) + " " + " ".join(prose(i % 8, 25).split()[i % 5:i % 5 + 8 + i % 9]) + ". " + prose(70 + i, 30)) for i in range(40)]
    docs += [(200, "a tiny item and a tiny item again"), (201, prose(1, 25) * 3), (202, "tiny"), (203, " ".join(prose(2, 25).split()[:9]))]
    return docs, items


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in df.collect()), key=repr)


def test_report_equals_plain_search(spark):
    docs, items = case()
    d, b = frame(spark, docs, "doc_id long, text string"), frame(spark, items, ITEMS)
    assert got(S.report(d, b)) == brute(docs, items)


def test_blocks_give_the_same(spark):
    docs, items = case()
    d, b = frame(spark, docs, "doc_id long, text string"), frame(spark, items, ITEMS)
    whole = {r.doc_id: r for r in S.find(d, b).collect()}
    for r in S.find(d, b, block_bytes=400).collect():
        w = whole[r.doc_id]
        assert (r.n_words, r.hits, sorted(set(r.items))) == (w.n_words, w.hits, sorted(set(w.items)))
        assert sorted(map(tuple, r.matches)) == sorted(map(tuple, w.matches))


def test_longest_matches_and_places(spark):
    item = prose(4, 40).split()
    text = " ".join(["x", "y"] + item[5:27] + ["z"])
    df = S.find(frame(spark, [(1, text)], "doc_id long, text string"), frame(spark, [(9, " ".join(item))], ITEMS))
    assert [tuple(m) for m in df.first().matches] == [("9", 5, 2, 22)]


def test_odd_documents(spark, odd, none):
    items = frame(spark, [(1, prose(2, 60)), (2, "one"), (3, "é漢字"), (4, None)], ITEMS)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(S.report(odd, items)) == brute(rows, [tuple(r) for r in items.collect()])
    clean = S.decontaminate(odd, items)
    assert clean.columns == odd.columns and not {7, 8, 10, 11} & {r.doc_id for r in clean.collect()}
    empty = frame(spark, [], ITEMS)
    assert S.decontaminate(odd, empty).count() == len(odd_documents())
    assert S.report(none, items).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, prose(1, 12), 5, "h")], "doc_id long, text string, N_Words int, hits string")
    items = frame(spark, [(1, prose(9, 12))], ITEMS)
    assert S.decontaminate(df, items).columns == df.columns and S.decontaminate(df, items).count() == 1


def test_repetitive_texts(spark):
    rows = [(1, "la " * 100_000), (2, "la li " * 300 + "x " + "la " * 11), (3, "li " * 9), (4, "x " + "la " * 12 + "li la la")]
    items = [(1, "la " * 2_000), (2, "la li " * 40), (3, "la li la"), (1, "la " * 2_000), (4, "la " * 12 + "li")] + [(5, "la " * 50)] * 300
    t = time.perf_counter()
    distinct = sorted(set(items))
    out = S.match_block(S.Suffixes([i for i, _ in distinct], pa.array([x for _, x in distinct]), 10), pa.array([x for _, x in rows]))
    assert time.perf_counter() - t < 30  # all pairs of places and suffixes would be 3 * 10^9
    assert out["n_words"].to_pylist() == [100_000, 612, 9, 16]
    small = [(1, "la " * 60), rows[1], rows[2], rows[3]]
    assert got(S.report(frame(spark, small, "doc_id long, text string"), frame(spark, items, ITEMS))) == brute(small, items)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abx"), max_size=14), min_size=1, max_size=4),
       st.lists(st.lists(st.sampled_from("ab"), max_size=8), min_size=1, max_size=4), st.integers(1, 4))
def test_matches_are_all_maximal_ones(docs, items, window):
    index = S.Suffixes(list(range(len(items))), pa.array([" ".join(i) for i in items]), window)
    found = S.match_block(index, pa.array([" ".join(d) for d in docs]))["matches"].to_pylist()
    for d, matches in zip(docs, found):
        want = set()
        for number, item in enumerate(items):
            for i in range(len(item)):
                for j in range(len(d)):
                    n = 0
                    while i + n < len(item) and j + n < len(d) and item[i + n] == d[j + n]:
                        n += 1
                    ahead = i and j and item[i - 1] == d[j - 1]
                    if n >= min(window, len(item)) and not ahead:
                        want.add((str(number), i, j, n))
        assert sorted(tuple(m.values()) for m in matches) == sorted(want)
