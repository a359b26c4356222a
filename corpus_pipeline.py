"""Corpus preparation: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all
but the last return the columns of ``documents``.  ``run`` writes every stage's result as
Parquet in the shared checkpoint folder and rereads it, so a lost executor costs at most the
running stage.  Null texts and ids, empty tables and repeated rows are handled as the
operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, importance, pii, probminhash, suffixes
from tessera.llm.common import fresh, read, scratch
from tessera.llm.queries import BPE_RANKS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents kept by importance resampling towards the good labelled ones."""
    return importance.select(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return probminhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return suffixes.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars is that of the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text (``token_ids``), with their number (``n_tokens``); names
    that are taken get a trailing underscore."""
    ids, n = fresh(docs, "token_ids"), fresh(docs, "n_tokens")
    return bpe.encode(docs, BPE_RANKS).withColumn(n, F.size(ids).cast("long"))


STAGES = [("quality classifier", quality), ("near-dedup", near_dedup), ("decontamination", decontaminate),
          ("personal data", redact), ("byte-level BPE", tokenize)]

#: Signatures, soft labels and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  A stage's table is removed once the next is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            target = spark._jvm.org.apache.hadoop.fs.Path(before)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        docs, before = spark.read.parquet(path), path
    return docs
