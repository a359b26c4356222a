"""Base spans against Python's re, the label model, and redaction."""

import hashlib
import random
import re

import pytest

from tessera.llm import pii
from util import frame, odd_documents

# The patterns of the contract, as written there.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def fits(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(PLAIN[k], text or "") if fits(k, m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(df, texts):
    rows = {r.doc_id: r for r in pii.detect(df).collect()}
    for i, t in texts.items():
        spans, r = base(t), rows[i]
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest(), t[:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(filter(None, listed(spans).split(","))) <= set(r.spans.split(","))
    return rows


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(1)
    bits = ["a@b.c", "x.y@mail.example.com", "@", ".", "1.2.3.4", "256.1.1.1", "010.0.0.1", "4111 1111 1111 1111", "4111111111111112",
            "+1 (743) 555-3824", "+49-30-1234567", "+1 2", " ", "-", "é", "😀", "7", "_", "%", "..", "a@b", "(", ")", "+", "\n", "5500005555555559"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for i in range(400)}
    check(frame(spark, list(texts.items()), "doc_id long, text string"), texts)


def test_very_long_texts(spark):
    texts = {1: "a" * 300_000 + "@" + "b." * 60_000 + "c", 2: "1 " * 200_000, 3: "9" * 300_000, 4: "+1" + " 2" * 100_000,
             5: "1." * 150_000 + "1", 6: "x@y.z " * 20_000, 7: "a" * 400_000}
    check(frame(spark, list(texts.items()), "doc_id long, text string"), texts)


def test_labelers_add_supported_candidates(spark):
    texts = {i: f"please call +1 415 555 {1000 + i} or mail to joe{i}@example.com" for i in range(40)}
    texts |= {100 + i: f"my phone number: (415) 555-{1000 + i}, thanks" for i in range(40)}
    texts |= {200 + i: f"order 123-456-{7000 + i}x9 invoice 999-888-{1000 + i}" for i in range(10)}
    rows = check(frame(spark, list(texts.items()), "doc_id long, text string"), texts)
    assert all(r.spans == "phone:17:31" for i, r in rows.items() if 100 <= i < 200)
    assert all("x9" not in texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for i, r in rows.items() for s in r.spans.split(",") if s and i >= 200)


def test_estimate_prefers_agreement():
    post = pii.estimate([(0, (1, 1, 1, 1, 1), 50), (0, (0, -1, -1, 0, -1), 40), (0, (1, 1, 0, 0, 1), 30), (0, (0, -1, 0, 0, -1), 30)])
    assert post[0, (1, 1, 1, 1, 1)] > 0.95 and post[0, (0, -1, -1, 0, -1)] < 0.05


def test_redaction(spark):
    df = spark.createDataFrame([(1, "to a@b.co, 10.1.2.3 and 4111 1111 1111 1111; +1 (743) 555-3824.", "k"), (2, None, None), (3, "clean", "x")],
                               "doc_id long, text string, found_spans string")
    out = pii.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "to [EMAIL], [IP] and [CARD]; [PHONE].", 2: None, 3: "clean"}


def test_overlapping_spans_are_redacted_whole(spark):
    texts = {1: "é call +33.1.42.68.53.00 now", 2: "10.0.0.1 4111 1111 1111 1111", 3: "+49.30.12.34.567, or x+33.1.42.68.53.00@b.co!"}
    out = {r.doc_id: r.text for r in pii.redact(frame(spark, list(texts.items()), "doc_id long, text string")).collect()}
    assert out[1] == "é call [PHONE] now"
    assert not any(c.isdigit() for t in out.values() for c in t)


def test_odd_documents(spark, odd, none):
    rows = pii.detect(odd).collect()
    assert len(rows) == len(odd_documents()) and all(r.spans == "" for r in rows)
    assert pii.detect(none).count() == 0 and pii.redact(none).count() == 0
    same = sorted((repr(r) for r in pii.redact(odd).collect()))
    assert same == sorted(repr(r) for r in odd.collect())


def test_native_plan(spark, odd):
    plan = pii.redact(odd)._jdf.queryExecution().toString() + pii.candidates(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
