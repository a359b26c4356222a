"""WARC round trips, with magic inside payloads and archives read in many splits."""

import hashlib
import tempfile

import pytest

from tessera.llm import warc as W
from util import frame

PAGES = "page_id long, url string, html string, extra string"


def stored(html, n=300):
    return W.MAGIC + f"WARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: {len(html)}\r\n\r\n{html}\r\n\r\n"


def pages():
    inner = stored("fake payload") * 3
    rows = [(i, f"http://h{i}.org/", f"<html>{i}" + "x" * (i * 7 % 900) + "é" * (i % 5), None) for i in range(120)]
    rows += [(200, "u", "a" + inner + "b", None), (201, "u", inner + stored("z" * 5000), None), (202, "u", "<p>" + W.MAGIC * 4, None)]
    rows += [(300 + i, "http://same/", "same payload " * 20, None) for i in range(9)] + [(400, None, None, None), (401, "x\r\ny", "", None),
             (402, "u", "short", None), (403, "u", "short", None), (None, "u", "no id " * 40, None), (405, "u", "no id " * 40, None)]
    return rows


@pytest.mark.parametrize("compression,split", [("gzip", None), ("none", None), ("none", 700), ("none", 4000)])
def test_round_trip(spark, compression, split):
    rows = pages()
    path = tempfile.mkdtemp(prefix="warc-") + "/w"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        W.write(frame(spark, rows, PAGES).repartition(3), path, compression=compression)
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = W.read(spark, path, payloads=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    first = {}
    for i, _, html, _ in rows:
        key = html or ""
        first[key] = min((x for x in (first.get(key), i) if x is not None), default=None)
    want = []
    for i, url, html, _ in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and first[html or ""] != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                     first[html or ""] if revisit else None, None if revisit else data))
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (b"" if r.record_type == "response" else None)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_default_archives_are_read_in_many_splits(spark):
    """Files are larger than a split, and every entry but the first is reached by a jump."""
    path = tempfile.mkdtemp(prefix="warc-") + "/w"
    rows = [(i, "u", f"page {i} " + "abcdefg " * 30_000, None) for i in range(120)]
    W.write(frame(spark, rows, PAGES).coalesce(1), path)
    pieces = W._pieces(spark, path)
    files, splits = pieces.select("path").distinct().count(), pieces.select("path", "split").distinct().count()
    assert splits > files
    got = W.read(spark, path).collect()
    assert sorted(r.page_id for r in got) == list(range(120))
    nodes = frame(spark, [("f", 0, 100), ("f", 40, 90), ("f", 100, 250), ("f", 250, 400), ("f", 400, 777), ("g", 5, 100)],
                  "path string, start long, leaves long")
    assert sorted(tuple(r) for r in W._reached(nodes).collect()) == [("f", s) for s in (0, 100, 250, 400)]


def test_repeated_rows_and_no_rows(spark):
    path = tempfile.mkdtemp(prefix="warc-")
    W.write(frame(spark, [(1, "u", "p" * 200, None)] * 2 + [(2, "u", "p" * 200, None)], PAGES), path + "/a")
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in W.read(spark, path + "/a").collect())
    assert got == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    W.write(frame(spark, [], PAGES), path + "/b")
    assert W.read(spark, path + "/b").count() == 0


def test_chain_ends_at_a_broken_record(spark):
    path = tempfile.mkdtemp(prefix="warc-")
    good = stored("one")
    with open(path + "/x.warc", "w", newline="") as f:
        f.write(good + good.replace("Content-Length: 3", "Content-Length: nonsense") + good)
    assert W.read(spark, path).count() == 1
    with open(path + "/x.warc", "w", newline="") as f:
        f.write("junk before" + good)
    assert W.read(spark, path).count() == 0


def test_single_payloads_are_not_moved(spark):
    """Only pages whose payload may be repeated pass through a shuffle."""
    body = "x" * 200
    pages = spark.createDataFrame([(i, f"http://a/{i}", body if i % 10 == 3 else f"{i} {body}") for i in range(40)]
                                  + [(None, None, body), (50, None, None)], "page_id long, url string, html string")
    out = W._referred(pages)
    rows = {r.page_id: r.first_id for r in out.collect()}
    assert rows == {None: 3, 50: None} | {i: 3 if i % 10 == 3 else None for i in range(40)}
    assert out.count() == 42
    plan = out.select("page_id", "html")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
