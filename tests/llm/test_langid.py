"""Segmentation-marginalised scores against all segmentations, held-out accuracy, odd cases."""

import itertools
import zlib

import numpy as np

from tessera.llm import langid as L
from tessera.llm.queries import BPE_RANKS
from util import frame, odd_documents


def segmentations(word):
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        yield [word[a:b] for a, b in zip(at, at[1:])]


def number(v, piece):
    return v.numbers.get(piece)


def block_of(*words):
    widths = np.array([len(w) for w in words])
    block = np.zeros((len(words), widths.max()), np.uint8)
    for row, w in zip(block, words):
        row[:len(w)] = np.frombuffer(w, np.uint8)
    return block, widths


def log_sums(v, word, p):
    """Log forward sums (positions x languages) of one word by plain dynamic programming."""
    at = [np.zeros(p.shape[1])]
    for end in range(1, len(word) + 1):
        parts = [at[a] + np.log(p[number(v, word[a:end])]) for a in range(max(0, end - v.longest), end) if number(v, word[a:end]) is not None]
        at.append(np.logaddexp.reduce(parts))
    return np.array(at)


def test_forward_sums_all_segmentations():
    v = L.pieces(BPE_RANKS)
    p = np.random.default_rng(1).random((v.size, 3))
    p /= p.sum(axis=0)
    scaled = p * L.SCALE ** v.lengths[:, None]
    for word in (b" the", b" \xc3\xa9t\xc3\xa9", b" nation"):
        total = np.zeros(3)
        for parts in segmentations(word):
            ids = [number(v, x) for x in parts]
            if None not in ids:
                total += np.prod([p[i] for i in ids], axis=0)
        assert np.allclose(log_sums(v, word, p)[-1], np.log(total))
        assert np.allclose(L.forward(v, *block_of(word), scaled)[0], np.log(total))


def test_words_of_any_length_are_whole():
    """Long pieces count, long words are neither cut nor lost to underflow, padding changes nothing."""
    v = L.pieces(BPE_RANKS)
    assert v.longest > 30
    p = np.random.default_rng(3).random((v.size, 2)) ** 8 + 1e-9
    p /= p.sum(axis=0)
    scaled = p * L.SCALE ** v.lengths[:, None]
    longest = max(v.numbers, key=len)
    words = [b" " + longest * 40, b" " + "été国語的".encode() * 80, b" " + b"nation" * 205, b" x" * 650]
    got = L.forward(v, *block_of(*words), scaled)
    for row, word in zip(got, words):
        assert np.allclose(row, log_sums(v, word, p)[-1])
    out, total = np.zeros((v.size, 2)), np.zeros(v.size)
    L.expected(v, *block_of(*words), np.array([1.0, 2.0, 3.0, 0.5]), np.array([1, 1, 1, 1]), scaled, out)
    for weight, word in zip((1.0, 2.0, 3.0, 0.5), words):
        fore = log_sums(v, word, p)[:, 1]
        back = np.full(len(word) + 1, -np.inf)
        back[-1] = 0.0
        for a in range(len(word) - 1, -1, -1):
            ends = [b for b in range(a + 1, min(len(word), a + v.longest) + 1) if number(v, word[a:b]) is not None]
            steps = np.array([np.log(p[number(v, word[a:b]), 1]) + back[b] for b in ends])
            back[a] = np.logaddexp.reduce(steps)
            for b, step in zip(ends, steps):
                total[number(v, word[a:b])] += weight * np.exp(fore[a] + step - fore[-1])
    assert np.allclose(out[:, 1], total)


def test_blocks_hold_every_word_once():
    rng = np.random.default_rng(4)
    size = np.append(rng.integers(1, 60, 300), [400, 401, 449, 3000, 50_000])
    ends = np.cumsum(size)
    data = rng.integers(97, 122, ends[-1]).astype(np.uint8)
    seen = {}
    for which, block, widths in L.blocks(data, ends - size, ends, 1 << 20):
        assert len(which) <= 64
        for w, row, width in zip(which, block, widths):
            seen[int(w)] = row[:width].tobytes()
            assert not row[width:].any()
    assert seen == {i: b" " + data[b - n:b].tobytes() for i, (b, n) in enumerate(zip(ends, size))}


def test_many_languages(spark):
    """More languages than one matrix holds; each has words of its own."""
    def name(i):
        return "".join("bcdfghjklm"[int(d)] + "aeiou"[int(d) % 5] for d in f"{i:03d}")

    rows = [(i * 10 + j, f"{name(i)} {name(i)}x " * 20, f"l{i:03d}", None, None) for i in range(150) for j in range(4)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    tests = [(100_000 + i, f"{name(i)} {name(i)}x " * 3, None, None, None) for i in range(150)]
    got = {r.doc_id: r.lang_pred for r in L.identify(frame(spark, rows + tests), BPE_RANKS).collect()}
    known = {r[2] for r in rows}
    assert len(known) > 2 * L.LANGUAGES_AT_ONCE
    right = [got[100_000 + i] == f"l{i:03d}" for i in range(150) if f"l{i:03d}" in known]
    assert sum(right) / len(right) > 0.95


def test_expected_counts_are_posterior_sums():
    v = L.pieces(BPE_RANKS)
    p = np.random.default_rng(2).random((v.size, 2))
    scaled = p * L.SCALE ** v.lengths[:, None]
    word = b" there"
    want, total = np.zeros(v.size), 0.0
    for parts in segmentations(word):
        ids = [number(v, x) for x in parts]
        if None not in ids:
            w = np.prod(p[ids, 1])
            total += w
            np.add.at(want, ids, w)
    out = np.zeros((v.size, 2))
    L.expected(v, *block_of(word), np.array([5.0]), np.array([1]), scaled, out)
    assert np.allclose(out[:, 1], 5 * want / total) and not out[:, 0].any()


def test_held_out_accuracy_and_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in L.identify(docs, BPE_RANKS).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_odd_documents(spark, odd, none):
    rows = L.identify(odd, BPE_RANKS).collect()
    assert len(rows) == len(odd_documents())
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 4))
    assert by[10].lang_pred in ("en", "fr") and not by[None].held_out
    assert L.identify(none, BPE_RANKS).count() == 0
    unlabelled = frame(spark, [(1, "some text", None, None, None)])
    assert L.identify(unlabelled, BPE_RANKS).first().lang_pred == "und"
