"""BPE ids against tiktoken, exact round trips and offsets."""

import hashlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe
from tessera.llm.queries import BPE_RANKS
from util import odd_documents


@pytest.fixture(scope="module")
def pair():
    c = bpe.codec(BPE_RANKS)
    return c, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=c.ranks, special_tokens={})


TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_equal_tiktoken(pair, texts):
    ours, theirs = pair
    ends, ids = ours.encode(texts)
    for t, a, b in zip(texts, ends, ends[1:]):
        assert ids[a:b].tolist() == theirs.encode_ordinary(t)
        assert ours.decode(ids[a:b])[1].tobytes() == t.encode()


@given(st.text("ab'strvemld12²é \n\x1c\x85\xa0!", max_size=40))
def test_latin_pattern_equals_the_fixed_one(pair, text):
    import regex

    assert bpe.LATIN.findall(text) == regex.findall(public_tokenizers.PATTERN, text) or bpe.BEYOND_LATIN.search(text)


def test_pattern_is_the_public_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_spans_of_split_characters(pair):
    ours, theirs = pair
    text = "a😀é漢b"
    ids = np.array(theirs.encode_ordinary(text), np.int32)
    starts, ends = ours.character_spans(ids)
    at, data = ours.decode(ids)
    for k, (s, e) in enumerate(zip(starts, ends)):
        assert data[at[k]:at[k + 1]].tobytes() in text[s:e].encode()


def test_table_round_trip_with_odd_rows(spark, odd, none, pair):
    out = bpe.decode(bpe.encode(odd, BPE_RANKS, spans=True), BPE_RANKS)
    assert out.columns == [*odd.columns, "token_ids", "token_starts", "token_ends", "decoded"]
    rows = out.collect()
    assert len(rows) == len(odd_documents()) and all(r.decoded == (r.text or "") for r in rows)
    assert bpe.encode(none, BPE_RANKS).count() == 0
    for r, d in zip(sorted(odd.collect(), key=repr), sorted(odd.collect(), key=repr)):
        assert r == d
    digests = {(r.doc_id, r.decoded_sha256): r for r in bpe.round_trip(odd, BPE_RANKS).collect()}
    for d in odd.collect():
        r = digests[d.doc_id, hashlib.sha256((d.text or "").encode()).hexdigest()]
        ids = pair[1].encode_ordinary(d.text or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_clashing_name_and_partial_ids(spark, pair):
    df = spark.createDataFrame([(1, "é", 5)], "doc_id long, text string, Token_Ids int")
    out = bpe.encode(df, BPE_RANKS)
    assert out.columns == ["doc_id", "text", "Token_Ids", "token_ids_"]
    ids = pair[1].encode_ordinary("漢")
    part = spark.createDataFrame([(ids[:1],), (None,), ([10**6],)], "token_ids array<int>")
    texts = [r.decoded for r in bpe.decode(part, BPE_RANKS).collect()]
    assert texts[1] is None and texts[2] == "" and (len(ids) == 1 or "�" in texts[0])
