"""The registered ``opN_<name>`` queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, hostrep, importance, jumphash, langid, normbuckets, oracles, pii, probminhash, skmeans, spelling,
               strassen, suffixes, warc)
from .common import read, scratch

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), BPE_RANKS)


#: Fixed by the task: host/path rules and their verdicts.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query
def op8_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page outcomes are stand-ins: the labels of the document with the page's number, bad when
    of low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return hostrep.judge(read(spark, sf_dir, "pages"), outcomes, URL_RULES).drop("bad_rate_bound")


ORACLE_SQL["op8_host_reputation"] = oracles.host_reputation(URL_RULES, 1.645, 0.5)


@query
def op9_jump_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jumphash.assign(read(spark, sf_dir, "documents"), 40)


@query
def op6_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE_SQL["op6_suffix_arrays"] = oracles.decontamination(suffixes.WINDOW)


@query
def op3_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op3_warc_chain"] = oracles.warc(warc.MIN_REVISIT)


@query
def op1_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op4_piece_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"), BPE_RANKS)


@query
def op5_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(read(spark, sf_dir, "documents")).drop("text_key")


@query
def op10_spherical_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skmeans.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op7_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read(spark, sf_dir, "documents"))


@query
def op11_strassen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row carries the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return strassen.mine(read(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE_SQL["op11_strassen"] = oracles.hard_negatives()


@query
def op12_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normbuckets.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE_SQL["op12_norm_buckets"] = oracles.top_products()


@query
def op13_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))
