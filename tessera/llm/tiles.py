"""Vectors as exact integers, and tiles of queries and candidates that stream through tasks.

A tile is one block of queries and one block of candidates of the same length (number of
components).  Its rows arrive together, sorted with the queries first, so a task holds the
queries of one tile (bounded in bytes) and their best entries, and takes candidates in
batches.  Best entries are mergeable: those of two tiles are the best of both lists.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

QUERY_BYTES = 8 << 20
TILE_ROWS = 16_384
LOWEST = np.iinfo(np.int64).min
NO_ID = (1 << 63) - 1


def integers(vectors: DataFrame, scale: int, *more: F.Column) -> DataFrame:
    """(row, vec_id, width, vector, more) of the usable rows of ``vectors``, written once.

    Components become floor(scale * x), x as double, held within the square root of
    2^55 / width, so that every inner product is an exact LONG (at scale 1024 and 64
    components that is |x| < 23,170).  Null vectors and those with null or non-finite components are left
    out.  ``row`` tells repeated ids apart; a null id is held as the largest LONG.
    """
    prepare(vectors.sparkSession)
    e = F.col("embedding").cast("array<double>")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = F.floor(F.sqrt(F.lit(float(1 << 55)) / F.greatest(F.col("width"), F.lit(1)))).cast("double")
    held = F.transform("embedding", lambda x: F.floor(F.greatest(-bound, F.least(bound, x * F.lit(float(scale))))).cast("long"))
    rows = vectors.select(F.coalesce(F.expr("try_cast(vec_id AS bigint)"), F.lit(NO_ID)).alias("vec_id"), e.alias("embedding"), *more)
    names = [c for c in rows.columns if c not in ("vec_id", "embedding")]
    rows = rows.where(usable).withColumn("width", F.size("embedding"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "width", held.alias("vector"), *names), "integers")


def real_id(c) -> F.Column:
    """The id that ``integers`` held, null again where it was null."""
    return F.nullif(F.col(c), F.lit(NO_ID))


def block_rows(nbytes: int) -> F.Column:
    """Rows of ``width`` components that fit ``nbytes``, one at least."""
    return F.greatest(F.lit(1), F.floor(F.lit(nbytes) / (8 * F.greatest(F.col("width"), F.lit(1))))).cast("int")


def parts(rows: DataFrame, keys, per: F.Column, name: str) -> DataFrame:
    """One row per key with the number of blocks of at most about ``per`` rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.ceil(F.col("_n") / per).cast("int").alias(name))


def spot(name: str) -> F.Column:
    """The block of a row, by a hash of its number."""
    return F.pmod(F.xxhash64("row"), F.col(name)).cast("int")


def every(name: str) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.col(name) - 1))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def streams(batches, keys: int, side: str):
    """(queries, candidate batches) of every tile of rows sorted by ``keys`` integer columns and
    ``side`` (0: queries).  Only the queries of one tile are held."""
    def slices():
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index(side)
            values = np.stack([batch.column(i).to_numpy() for i in (*range(keys), at)])
            starts = np.append(0, np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1)
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
                yield tuple(values[:keys, a]), values[keys, a], batch.slice(a, b - a)

    pending, rows = None, slices()
    held = next(rows, None)
    while held is not None:
        key, queries = held[0], []
        while held is not None and held[0] == key and held[1] == 0:
            queries.append(held[2])
            held = next(rows, None)

        def candidates():
            nonlocal held
            while held is not None and held[0] == key:
                yield held[2]
                held = next(rows, None)

        pending = candidates()
        if queries:
            yield pa.concat_batches(queries), pending
        for _ in pending:  # whatever the tile did not take
            pass


class Best:
    """The ``k`` best (score, id, row) entries of each slot: higher scores first, then smaller
    ids, then smaller rows."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, LOWEST)  # the k-th best score, once there are k
        self.slot, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def add(self, slot, score, ids, rows) -> None:
        if not len(slot):
            return
        slot, score = np.append(self.slot, slot), np.append(self.score, score)
        ids, rows = np.append(self.id, ids), np.append(self.row, rows)
        order = np.lexsort((rows, ids, ~score, slot))
        inside = np.arange(len(order)) - np.searchsorted(slot[order], slot[order], "left")
        order = order[inside < self.k]
        self.slot, self.score, self.id, self.row = slot[order], score[order], ids[order], rows[order]
        full = np.flatnonzero(inside[inside < self.k] == self.k - 1)
        self.floor[self.slot[full]] = self.score[full]

    def offer(self, slots, scores, wanted, ids, rows) -> None:
        """Adds from a (slots x candidates) matrix the ``wanted`` entries that can be among the best."""
        wanted = wanted & (scores >= self.floor[slots][:, None])
        if wanted.sum() > 4 * self.k * len(slots) and scores.shape[1] > self.k:
            held = np.where(wanted, scores, LOWEST)
            kth = np.partition(held, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            wanted &= scores >= kth[:, None]
        s, c = np.nonzero(wanted)
        self.add(slots[s], scores[s, c], ids[c], rows[c])


def best_of_tiles(found: DataFrame, slot, k: int, rank: str) -> DataFrame:
    """The ``k`` best of the tiles' entries per slot with their rank from 1.  Spark limits each
    group before the shuffle too."""
    order = Window.partitionBy(*slot).orderBy(F.desc("score"), "id", "other")
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)
