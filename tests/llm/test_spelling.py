"""Spelling variants against plain loops."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tessera.llm import spelling
from util import DOCS, LOWER, frame, odd_documents, prose


def counts(rows):
    n = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return n


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, letters=6, least=5):
    n = {w: c for w, c in counts(rows).items() if len(w) >= letters and c >= least}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    form, out = {}, []
    found = {w: [x for size in (len(w) - 1, len(w), len(w) + 1) for x in by_length[size] if near(w, x)] for w in n}
    for w, others in found.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), n.get(form[w])))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def corpus():
    """Texts with misspelt words of several kinds, at several frequencies."""
    rows, rng = odd_documents(), np.random.default_rng(4)
    words = sorted({w for w in prose(11, 120).split() if len(w) >= 5})
    for i in range(60):
        text = []
        for w in rng.choice(words, 200, p=np.arange(len(words), 0, -1) / (len(words) * (len(words) + 1) / 2)):
            x, at = rng.integers(0, 12), int(rng.integers(0, len(w)))
            c = "aeéÀzß"[rng.integers(0, 6)]
            text.append({0: w[:at] + w[at + 1:], 1: w[:at] + c + w[at:], 2: w[:at] + c + w[at + 1:], 3: w.upper()}.get(x, w))
        rows.append((1000 + i, " ".join(text), "en", "s", None))
    chain = [("planets", 700), ("planett", 130), ("planettt", 25), ("plunettt", 5), ("Planets", 3)]
    rows += [(2000 + i, " ".join([w] * n), "en", "s", None) for i, (w, n) in enumerate(chain)]
    rows += [(3000, " ".join(["x" * 5000] * 6 + ["x" * 4999] * 40), "en", "s", None)]
    return rows


def test_equal_to_loops(spark):
    rows = corpus()
    want = brute(rows)
    assert got(spelling.variants(frame(spark, rows))) == want
    roots = {w: root for w, _, root, *_ in want}
    assert roots["plunettt"] == "planets" and roots["x" * 5000] == "x" * 4999


def test_blocks_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 7)
    monkeypatch.setattr(spelling, "STATES", 11)
    monkeypatch.setattr(spelling, "LETTERS", 50)
    rows = corpus()
    assert got(spelling.variants(frame(spark, rows))) == brute(rows)


def test_no_words(spark, none):
    assert got(spelling.variants(none)) == []
    assert got(spelling.variants(frame(spark, [(1, "short words only 12345", "en", "s", None)]))) == []


def test_other_columns_may_clash(spark):
    rows = corpus()[-20:]
    names = ["word", "n", "form", "to", "block", "side", "counts", "run", "id"]
    schema = DOCS + "".join(f", {c} string" for c in names)
    df = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema)
    assert got(spelling.variants(df)) == brute(rows)


WORD = st.text("abéÀ", min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(WORD, WORD), min_size=1, max_size=8))
def test_one_edit(pairs):
    pairs = [tuple(sorted(p, key=len)) for p in pairs]
    a, b = (spelling.Words(pa.array([p[i] for p in pairs])) for i in (0, 1))
    at = np.arange(len(pairs))
    assert list(spelling.one_edit(a, at, b, at)) == [near(*p) for p in pairs]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=4, max_size=4), min_size=1, max_size=30),
       st.lists(st.lists(st.integers(0, 3), min_size=4, max_size=4), min_size=1, max_size=10))
def test_trie_search_spends_one_surplus_then_one_deficit(members, queries):
    members, queries = np.array(members), np.array(queries)
    trie = spelling.Trie(members)
    reached = set()
    for q, leaf in trie.search(queries):
        for i, f in zip(q, leaf):
            reached |= {(i, m) for m in trie.order[trie.starts[f]:trie.ends[f]]}
    want = set()
    for i, q in enumerate(queries):
        for m, v in enumerate(members):
            step = [x for x in v - q if x]
            if step in ([], [1], [1, -1]):
                want.add((i, m))
    assert reached == want
