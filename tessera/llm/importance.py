"""Quality selection by importance resampling over hashed n-grams.

Two bag models over ``BUCKETS`` hashed unigrams and bigrams are estimated: one of the target
(texts of labelled good documents), one of the raw corpus (all documents).  A document's log
importance weight is the sum over its n-grams of log target / raw probability.  Seeded Gumbel
noise is added and the ``k`` highest are kept, which samples k documents without replacement
in proportion to their weights (Gumbel top-k).  By default k is the number of documents whose
log weight is at least a floor that is calibrated on the labelled documents (``calibrate``): of
the weights that keep at least ``GOOD_KEPT`` of the good ones, the one with the largest share of
good documents kept less share of bad ones (of low quality or toxic) kept, at most 0 (the
weight of a text that says nothing), less ``MARGIN``, the reach of the noise downwards.

The target model is fitted on at most ``TARGET_SAMPLE`` labelled documents, those with the
smallest hash of their id, the floor on these and as many bad ones; raw counts, weights and the
selection cover all documents.  Both models get ``SMOOTHING`` pseudo-counts a bucket on the scale
of the target's counts.  A bucket whose target count is within ``DEVIATIONS`` standard deviations
of the expected one has ratio 0, so rare n-grams say nothing by chance, and words that are absent
from the target but frequent elsewhere (insults, for instance) count in full.  Buckets are many
so that such a word seldom shares one with a harmless n-gram.  How rare a word can be and still
count depends on the sample: with a few hundred labelled documents toxic words are not
significant and only junk goes.
Tokens are lower-cased words and runs of other non-blank ASCII; the models' size is fixed.

Null and empty texts have no n-gram and weight 0.  Repeated rows get the same noise and share
their fate; rows tied at the k-th score all stay.  Without labels the target model equals the
raw one and all weights are 0.  Null ids take part (their noise hashes null).  An empty table
gives an empty table; other columns are kept by ``select``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, extended, fresh, prepare, small_batches, utf8_parts
from .words import grams, mix, tokens

BUCKETS = 1 << 20
TARGET_SAMPLE = 20_000
SMOOTHING = 1.0
DEVIATIONS = 3.0
GOOD_KEPT = 0.98
MARGIN = 3.0
SEED = 20_240_601


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every unigram and bigram."""
    offsets, data = utf8_parts(texts)
    hashes, doc, _, _ = tokens(offsets, data, punctuation=True)
    pairs, pair_doc = grams(hashes, doc, 2)
    bucket = np.concatenate([hashes, pairs]) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate([doc, pair_doc])


def _column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def _sample(labelled: DataFrame, limit: int) -> DataFrame:
    ids = labelled.where("doc_id is not null").select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def target_ids(labels: DataFrame, limit: int = TARGET_SAMPLE) -> DataFrame:
    """Ids of at most ``limit`` good documents: quality 1 and not toxic."""
    return _sample(labels.where("quality = 1 and coalesce(toxic, 0) = 0"), limit)


def rejected_ids(labels: DataFrame, limit: int = TARGET_SAMPLE) -> DataFrame:
    """Ids of at most ``limit`` bad documents: quality 0 or toxic."""
    return _sample(labels.where("quality = 0 or toxic = 1"), limit)


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of target to raw probability for each bucket."""
    spark = docs.sparkSession
    prepare(spark)
    # At most TARGET_SAMPLE ids.
    sample = F.broadcast(target_ids(labels).withColumn("target", F.lit(True)))

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in small_batches(batches):
            bucket, doc = features(_column(batch, "text"))
            target = _column(batch, "target").to_numpy(zero_copy_only=False).astype(bool)
            counts[0] += np.bincount(bucket, minlength=BUCKETS)
            counts[1] += np.bincount(bucket[target[doc]], minlength=BUCKETS)
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])],
                                         ["bucket", "raw", "target"])

    flagged = docs.select("doc_id", "text").join(sample, "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = flagged.mapInArrow(run, "bucket long, raw long, target long")
    counts = cut(counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    expected = F.col("raw") * F.lit((target or 0) / (raw or 1))
    sure = F.abs(F.col("target") - expected) > DEVIATIONS * F.sqrt(F.greatest(expected, F.lit(1.0)))
    # At most BUCKETS rows, and only those whose ratio is not 0.
    rows = counts.where(sure).select("bucket", (F.log(F.col("target") + SMOOTHING) - F.log(expected + SMOOTHING)).alias("ratio")).toArrow()
    ratios = np.zeros(BUCKETS)
    ratios[rows["bucket"].to_numpy()] = rows["ratio"].to_numpy()
    return ratios


def _order(values: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` with n_grams, log_weight, score (with noise) and score_order (its rank key)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(ratios)
    seed = fresh(docs, "noise_seed")
    kinds = {"n_grams": "bigint", "log_weight": "double", "score": "double", "score_order": "bigint"}
    names = [fresh(docs, n) for n in kinds]

    def run(batches):
        ratios = shared.value
        for batch in small_batches(batches):
            bucket, doc = features(_column(batch, "text"))
            n = np.bincount(doc, minlength=batch.num_rows)
            weight = np.bincount(doc, ratios[bucket], batch.num_rows).astype(np.float64)
            hashed = mix(_column(batch, seed).to_numpy().astype(np.uint64))
            uniform = ((hashed >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)
            score = weight - np.log(-np.log(uniform))
            keep = [i for i, c in enumerate(batch.schema.names) if c != seed]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(n), pa.array(weight), pa.array(score), pa.array(_order(score))],
                [*(batch.schema.names[i] for i in keep), *names])

    seeded = docs.withColumn(seed, F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text")))
    return seeded.mapInArrow(run, extended(docs, **dict(zip(names, kinds.values()))))


def kth_largest(keys: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest of a LONG column by four counts of 16 bits each; None without rows.

    Every count returns at most 65,536 rows.
    """
    high = None
    for shift in (48, 32, 16, 0):
        within = keys if high is None else keys.where(F.shiftright(column, shift + 16) == high)
        rows = within.groupBy(F.shiftright(column, shift).alias("part")).count().collect()
        for part, n in sorted(rows, reverse=True):
            if n >= k:
                high = part
                break
            k -= n
        else:
            return None if not rows else min(r["part"] for r in rows) << shift
    return high


def calibrate(good: np.ndarray, bad: np.ndarray) -> float:
    """The floor for log weights, from those of labelled good and bad documents."""
    good, bad = np.sort(good), np.sort(bad)
    floors = np.unique(np.append(good[good < 0], 0.0))
    keeps = 1 - np.searchsorted(good, floors) / max(len(good), 1)
    wrong = 1 - np.searchsorted(bad, floors) / max(len(bad), 1)
    allowed = keeps >= GOOD_KEPT
    allowed[0] = True
    return float(floors[np.where(allowed, keeps - wrong, -np.inf).argmax()]) - MARGIN


def _calibrated(weighed: DataFrame, labels: DataFrame) -> float:
    """``calibrate`` on the labelled documents of ``weighed``, by id (its smallest weight)."""
    ids = target_ids(labels).withColumn("bad", F.lit(False)).unionByName(rejected_ids(labels).withColumn("bad", F.lit(True)))
    # At most 2 * TARGET_SAMPLE ids.
    found = weighed.select("doc_id", "log_weight").join(F.broadcast(ids), "doc_id")
    rows = found.groupBy("doc_id", "bad").agg(F.min("log_weight").alias("w")).select("bad", "w").toPandas()
    bad = rows["bad"].to_numpy(dtype=bool)
    weights = rows["w"].to_numpy(dtype=float)
    return calibrate(weights[~bad], weights[bad])


def threshold(weighed: DataFrame, labels: DataFrame, k: int | None = None, floor: float | None = None) -> int:
    """Score key from which documents are kept."""
    if k is None:
        floor = _calibrated(weighed, labels) if floor is None else floor
        k = weighed.where(F.col("log_weight") >= floor).count()
    found = kth_largest(weighed, "score_order", k) if k else None
    return found if found is not None else (1 << 63) - 1


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, floor: float | None = None) -> DataFrame:
    """Per document: doc_id, n_grams, log_weight, score, kept."""
    weighed = cut(weigh(docs.select("doc_id", "text"), fit(docs, labels)).drop("text"))
    kept = F.col("score_order") >= F.lit(threshold(weighed, labels, k, floor))
    return weighed.select("doc_id", "n_grams", "log_weight", "score", kept.alias("kept"))


def select(docs: DataFrame, labels: DataFrame, k: int | None = None, floor: float | None = None) -> DataFrame:
    """The kept rows of ``docs``, same columns.  Weights are computed again while filtering,
    which is cheaper than moving the texts to the decisions."""
    ratios = fit(docs, labels)
    weighed = cut(weigh(docs.select("doc_id", "text"), ratios).select("doc_id", "log_weight", "score_order"))
    least = threshold(weighed, labels, k, floor)
    order = fresh(docs, "score_order")
    return weigh(docs, ratios).where(F.col(order) >= F.lit(least)).select(docs.columns)
