"""Host reputation, jump hashing and embedding groups against brute force."""

import math
import os
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import hostrep as H
from tessera.llm import jumphash as J
from tessera.llm import skmeans as K
from util import frame, odd_documents

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def test_hosts_paths_and_rules(spark):
    urls = ["http://a.net", "HTTP://WWW.Example.NET/en/x?y#z", "https://b.example.com/de/1#t", "https://example.com/de", "x://q.org/fr/",
            "no scheme", None, "", "://", "http://É.net/a?b://c", "http://notnet/", "a://b://c/d", "http://u@h.org:80/fr/é"]
    rows = frame(spark, list(enumerate(urls)), "page_id long, url string")
    out = {r.page_id: r for r in H.judge(rows, frame(spark, [], "page_id long, bad int"), RULES).collect()}

    def plain(url):
        at = (url or "").find("://")
        rest = (url or "")[at + 3:] if at >= 0 else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        return host, path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]

    for i, url in enumerate(urls):
        host, path = plain(url)
        assert (out[i].host, out[i].path) == (host, path)
        fits = [r for r in RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0]))
                and path.startswith("/" + r.partition("/")[2])]
        assert out[i].rule == (max(fits, key=len) if fits else None)
        assert out[i].verdict == (RULES[out[i].rule] if out[i].rule else "allow")


def test_posterior_bound_blocks_bad_hosts_and_shrinks_small_ones(spark):
    pages, bad = [], []
    for h, n, b in (("bad.one.com", 60, 58), ("good.one.com", 60, 1), ("new.one.com", 1, 1), ("x.two.org", 40, 2), ("y.two.org", 40, 1)):
        for k in range(n):
            i = len(pages)
            pages.append((i, h))
            bad.append((i, int(k < b)))
    p = frame(spark, pages, "page_id long, host string")
    rep = {r.host: r for r in H.reputation(p, frame(spark, bad + [(None, 1), (9999, 1), (0, None)], "page_id long, bad int")).collect()}
    assert rep["bad.one.com"].blocked and not rep["good.one.com"].blocked and not rep["new.one.com"].blocked
    assert rep["new.one.com"].mean < 1 and rep["new.one.com"].n == 1
    assert H.reputation(frame(spark, [], "page_id long, host string"), frame(spark, [], "page_id long, bad int")).count() == 0


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_is_consistent_and_even():
    keys = np.random.default_rng(0).integers(0, 2**60, 4000)
    before, after = J.jump(keys, 40), J.jump(keys, 41)
    assert all(plain_jump(int(k), 40) == s for k, s in zip(keys, before))
    assert set(after[before != after]) == {40} and max(Counter(before).values()) < 160


def test_assignment(spark, odd, none):
    import hashlib

    rows = J.assign(odd, 4).collect()
    assert len(rows) == len(odd_documents())
    texts = {}
    for d in odd.collect():
        texts.setdefault(d.doc_id, []).append((d.text or "").encode())
    for r in rows:
        key = int(hashlib.md5(str(r.doc_id if r.doc_id is not None else "null").encode()).hexdigest()[:15], 16)
        assert (r.shard, r.grown_shard, r.law) == (plain_jump(key, 4), plain_jump(key, 5), "key")
        assert (r.size, r.text_crc32) in {(len(t) + 16, zlib.crc32(t)) for t in texts[r.doc_id]}
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert J.assign(none, 4).count() == 0


def test_slots_follow_ids_over_partitions(spark):
    df = frame(spark, [(i % 400, "t" * (i % 3)) for i in range(2000)], "doc_id long, text string").repartition(7)
    for s in range(3):
        part = sorted((r for r in J.assign(df, 3).collect() if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        assert [(r.doc_id, r["size"]) for r in part] == sorted((r.doc_id, r["size"]) for r in part)


def test_write_shards(spark):
    path = tempfile.mkdtemp(prefix="shards-") + "/s"
    df = frame(spark, [(i, "x", i % 5) for i in range(50)], "doc_id long, text string, Shard int")
    J.write_shards(df, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 50 and set(back.columns) == {"doc_id", "text", "Shard", "shard_"}


def brute_groups(vectors, similarity=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    n = len(vectors)
    near = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and len(vectors[a]) == len(vectors[b]):
                x, y = np.array(vectors[a]), np.array(vectors[b])
                near[a, b] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= similarity
    label = list(range(n))
    for _ in range(n):
        label = [min([label[a]] + [label[b] for b in np.flatnonzero(near[a])]) for a in range(n)]
    return near.sum(axis=1), label


@pytest.mark.parametrize("block", [512, 5])
def test_embedding_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(K, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(20):
        base = rng.normal(size=16)
        vectors += [base.tolist()] + [(base + rng.normal(size=16) * s).tolist() for s in (0.05, 0.2, 0.35, 0.5) for _ in range(2)]
    vectors += [vectors[0]] * 6 + [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15,
                [1.0, 2.0], [2.0, 4.0], [-1.0, 1.0], [2 * x for x in vectors[1]]]
    rows = frame(spark, list(enumerate(vectors)), "vec_id long, embedding array<double>")
    links, label = brute_groups(vectors)
    got = {r.vec_id: r for r in K.near_duplicates(rows, slack=None).collect()}
    assert [got[i].n_links for i in range(len(vectors))] == links.tolist()
    assert [got[i].component_id for i in range(len(vectors))] == label
    assert all(got[i].kept == (label[i] == i) for i in got)
    found = {r.vec_id: r.n_links for r in K.near_duplicates(rows).collect()}
    assert sum(found.values()) >= 0.9 * links.sum() and all(found[i] <= links[i] for i in found)


def test_embedding_odd_cases(spark):
    schema = "vec_id long, embedding array<float>, Node int"
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 2), (3, [0.0, 1.0], 3), (3, [0.0, 1.0], 4), (None, None, 5)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in K.near_duplicates(frame(spark, rows, schema)).collect()), key=repr)
    assert got == sorted([(None, 1, None, True)] * 2 + [(3, 1, 3, True)] * 2 + [(None, 0, None, True)], key=repr)
    assert K.near_duplicates(frame(spark, [], schema)).count() == 0
    assert K.deduplicate(frame(spark, rows, schema)).columns == ["vec_id", "embedding", "Node"]


def test_default_loses_no_link_of_vectors_of_low_intrinsic_dimension(spark):
    """64 wide, spread along 8 directions; the step between two vectors is not isotropic."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 8)) @ rng.normal(size=(8, 64)) + 0.02 * rng.normal(size=(3000, 64))
    unit = K.unit(x)
    linked = unit @ unit.T >= K.SIMILARITY
    np.fill_diagonal(linked, False)
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in K.near_duplicates(rows).collect()}
    assert [found[i] for i in range(len(x))] == linked.sum(axis=1).tolist()


def test_very_small_and_very_large_vectors(spark):
    rows = [(1, [1e-200, 0.0], 0), (2, [2e-200, 0.0], 0), (3, [0.0, 1e200], 0), (4, [1e199, 1.1e200], 0), (5, [5e-324, 0.0], 0), (6, [0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in K.near_duplicates(df).collect())
    assert got == [(1, 2, 1), (2, 2, 1), (3, 1, 3), (4, 1, 3), (5, 2, 1), (6, 0, 6)]


def test_disk_is_in_proportion_to_the_vectors(spark):
    """Vectors without near ones lie within reach of very many cells; none is written once for each."""
    def written():
        top = spark.sparkContext.getCheckpointDir().removeprefix("file:").rsplit("/", 1)[0]
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files)

    vectors = np.random.default_rng(4).normal(size=(4000, 64)).astype(np.float32)
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    before = written()
    assert K.near_duplicates(rows).agg({"n_links": "sum"}).first()[0] == 0
    assert written() - before < 6 * vectors.nbytes
