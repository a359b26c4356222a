"""Hard negatives: Strassen products of integer tiles, then best lists.

1. Vectors become exact integers (``tiles.integers``).
2. Positives: anchors meet the candidates of their own label in tiles of one label (a hot
   label is many tiles).  A tile's scores are one integer product; each task keeps the best
   ``positives`` other rows of every anchor, and the tiles' lists are merged.
3. Windows: every anchor meets all candidates in tiles; scores of other labels that lie in
   [low * positive score, positive score] go to the best list of that (anchor, positive).

A product is Strassen's recursion on int64: matrices are padded with zeros to an even size
at each of the ``levels``, seven half-size products replace eight, and the leaves are plain
int64 products.  All sums are exact (intermediates may wrap around modulo 2^64, the results
are within 2^55), so results depend on no order of evaluation.

Rows with a null label (or one that is no integer), a null vector, or null or non-finite
components take no part.  Vectors of different length are not compared.  Repeated rows are rows of their
own: a copy of the anchor's row is one of the other rows.  A row of null id is a candidate (its id comes
last among ties) but no anchor.  Empty vectors score 0.  Negative positives have an empty window.  An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tiles import (QUERY_BYTES, TILE_ROWS, Best, best_of_tiles, block_rows, every, integers, matrix, parts,
                    real_id, spot, streams)

LEAF = 32
CHUNK = 1024


def product(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The exact integer product of two int64 matrices."""
    (n, m), p = a.shape, b.shape[1]
    if min(n, m, p) <= leaf:
        return a @ b
    h, w, v = (n + 1) // 2, (m + 1) // 2, (p + 1) // 2
    a, b = _padded(a, 2 * h, 2 * w), _padded(b, 2 * w, 2 * v)
    a11, a12, a21, a22 = a[:h, :w], a[:h, w:], a[h:, :w], a[h:, w:]
    b11, b12, b21, b22 = b[:w, :v], b[:w, v:], b[w:, :v], b[w:, v:]
    out = np.empty((2 * h, 2 * v), np.int64)
    c11, c12, c21, c22 = out[:h, :v], out[:h, v:], out[h:, :v], out[h:, v:]
    c11[:] = product(a11 + a22, b11 + b22, leaf)
    c22[:] = c11
    for left, right, plus, minus in (
            (a21 + a22, b11, c21, c22), (a11 + a12, b22, c12, c11)):
        part = product(left, right, leaf)
        plus[:] = part
        minus -= part
    for left, right, one, two in (
            (a11, b12 - b22, c12, c22), (a22, b21 - b11, c21, c11)):
        part = product(left, right, leaf)
        one += part
        two += part
    c22 += product(a21 - a11, b11 + b12, leaf)
    c11 += product(a12 - a22, b21 + b22, leaf)
    return out[:n, :p]


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), np.int64)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name).to_numpy(zero_copy_only=False)


def _tile_scores(queries: pa.RecordBatch, candidates):
    """(first anchor, scores, batch) of every product of a tile."""
    width = int(_numbers(queries, "width")[0])
    anchors = matrix(_column(queries, "vector"), width)
    for batch in candidates:
        for start in range(0, batch.num_rows, CHUNK):
            piece = batch.slice(start, CHUNK)
            other = matrix(_column(piece, "vector"), width).T
            for first in range(0, len(anchors), CHUNK):
                yield first, product(anchors[first:first + CHUNK], other), piece


def _positives(keys: int, k: int):
    def run(batches):
        for queries, candidates in streams(batches, keys, "side"):
            rows = _numbers(queries, "row")
            best = Best(len(rows), k)
            for first, scores, piece in _tile_scores(queries, candidates):
                slots = np.arange(first, first + len(scores))
                other = _numbers(piece, "row")
                best.offer(slots, scores, rows[slots][:, None] != other, _numbers(piece, "vec_id"), other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[best.slot]), pa.array(best.score), pa.array(best.id), pa.array(best.row)],
                ["anchor", "score", "id", "other"])

    return run


def _negatives(keys: int, k: int):
    def run(batches):
        for queries, candidates in streams(batches, keys, "side"):
            # One slot per (anchor, positive): its anchor, and the window of scores.
            windows = _column(queries, "windows")
            of = np.repeat(np.arange(queries.num_rows), windows.value_lengths().to_numpy())
            flat = windows.flatten()
            low, high, rank, positive = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            rows, ids, labels = _numbers(queries, "row"), _numbers(queries, "vec_id"), _numbers(queries, "label")
            best = Best(len(of), k)
            for first, scores, piece in _tile_scores(queries, candidates):
                differs = labels[first:first + len(scores)][:, None] != _numbers(piece, "label")
                mine = np.flatnonzero((of >= first) & (of < first + len(scores)))
                for n in np.unique(rank[mine]):
                    slots = mine[rank[mine] == n]
                    s = scores[of[slots] - first]
                    inside = (s >= low[slots][:, None]) & (s <= high[slots][:, None]) & differs[of[slots] - first]
                    best.offer(slots, s, inside, _numbers(piece, "vec_id"), _numbers(piece, "row"))
            at = of[best.slot]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (rows[at], rank[best.slot], ids[at], positive[best.slot], high[best.slot], best.score, best.id, best.row)],
                ["anchor", "positive_rank", "anchor_id", "positive_id", "positive_score", "score", "id", "other"])

    return run


def _dealt(queries: DataFrame, candidates: DataFrame, keys) -> DataFrame:
    names = list(dict.fromkeys([*keys, "part", "block", "side", "row", "vec_id", "label", "width", "vector"]))
    if "windows" in queries.columns:
        names.append("windows")
        candidates = candidates.withColumn("windows", F.lit(None).cast(queries.schema["windows"].dataType))
    both = queries.withColumn("side", F.lit(0)).select(names).unionByName(candidates.withColumn("side", F.lit(1)).select(names))
    tile = [*keys, "part", "block"]
    return both.repartition(*tile).sortWithinPartitions(*tile, "side")


def _met(queries: DataFrame, candidates: DataFrame, keys) -> DataFrame:
    """Queries and candidates of equal ``keys`` in tiles: each query in every block of
    candidates, each candidate in every part of the queries."""
    sizes = stored(parts(candidates, keys, F.lit(TILE_ROWS), "blocks").join(
        parts(queries, keys, block_rows(QUERY_BYTES), "parts"), keys), "tiles")
    queries = queries.join(sizes, keys).withColumn("part", spot("parts")).withColumn("block", every("blocks"))
    candidates = candidates.join(sizes, keys).withColumn("block", spot("blocks")).withColumn("part", every("parts"))
    return _dealt(queries, candidates, keys)


def mine(vectors: DataFrame, anchor: F.Column, scale: int = 256, positives: int = 5, negatives: int = 5,
         low: tuple[int, int] = (80, 100)) -> DataFrame:
    """Hard negatives of the anchors (rows of ``vectors`` for which ``anchor``, a condition on
    vec_id, holds): per anchor and each of its ``positives`` best other rows of the same
    label, the ``negatives`` best rows of other labels whose score lies between low[0] /
    low[1] of the positive's and the positive's own."""
    rows = integers(vectors, scale, F.expr("try_cast(label AS bigint)").alias("label")).where("label is not null")
    anchors = rows.where(real_id("vec_id").isNotNull() & anchor)
    near = _met(anchors, rows, ["width", "label"]).mapInArrow(
        _positives(4, positives), "anchor long, score long, id long, other long")
    near = best_of_tiles(near, ["anchor"], positives, "rank")
    above, below = low
    window = F.struct(F.expr(f"(score * {above} + {below - 1}) div {below}").alias("low"), F.col("score").alias("high"),
                      F.col("rank").cast("long").alias("rank"), F.col("id").alias("positive"))
    wanted = near.groupBy("anchor").agg(F.collect_list(window).alias("windows"))  # ``positives`` entries at most
    anchors = stored(anchors.join(wanted, anchors["row"] == wanted["anchor"]).drop("anchor"), "anchors")
    found = _met(anchors, rows, ["width"]).mapInArrow(
        _negatives(3, negatives),
        "anchor long, positive_rank long, anchor_id long, positive_id long, positive_score long, score long, id long, other long")
    found = best_of_tiles(found, ["anchor", "positive_rank"], negatives, "rank")
    return found.select("anchor_id", real_id("positive_id").alias("positive_id"), "rank", real_id("id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))
