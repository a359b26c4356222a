"""The pipeline against its stages' brute-force rules, and queries against their SQL."""

import pytest

import corpus_pipeline as C
from helpers import duck_table, spark_table
from tessera.llm import queries as Q
from test_pii import base
from test_probminhash import brute as classes
from test_suffixes import brute as contaminated
from util import words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(Q.ORACLE_SQL))
def test_query_equals_sql(spark, duck, key):
    assert spark_table(Q.QUERIES[key](spark, SF)) == duck_table(duck(SF), Q.ORACLE_SQL[key])


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))
    assert set(Q.ORACLE_SQL) <= set(Q.QUERIES)


def test_stages_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, frames = docs.columns, [docs]
    for name, stage in C.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    raw, good, unique, clean, private, tokens = frames
    assert all(f.columns == names for f in (good, unique, clean, private))

    rows = [(r.doc_id, r.text) for r in good.collect()]
    kept = {i for (i, _), c in zip(rows, classes(rows)) if c == i}
    assert {r.doc_id for r in unique.collect()} == kept

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    report = contaminated([(r.doc_id, r.text) for r in unique.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in report if not r[-1]}

    before = {r.doc_id: r for r in clean.collect()}
    for r in private.collect():
        spans = base(before[r.doc_id].text)
        assert not base(r.text) and r.n_chars == len(r.text) and (bool(spans) or r.text == before[r.doc_id].text)
    assert tokens.count() == private.count() and all(len(r.token_ids) == r.n_tokens for r in tokens.collect())
    assert {len(words(r.text)) > 0 for r in tokens.collect()}


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_token_columns_that_are_taken(spark):
    df = spark.createDataFrame([(1, "some words to count", [7], "x"), (2, None, None, None)],
                               "doc_id long, text string, token_ids array<int>, N_tokens string")
    rows = sorted(C.tokenize(spark, df, SF).collect(), key=lambda r: r.doc_id)
    assert [(r.token_ids, r.N_tokens) for r in rows] == [([7], "x"), (None, None)]
    assert [r.n_tokens_ for r in rows] == [len(rows[0].token_ids_), 0] and len(rows[0].token_ids_) >= 4
