"""Exact top-k search by inner product: buckets of similar length, pruned by local thresholds.

1. Vectors become exact integers (``tiles.integers``) with their length; a class holds the
   lengths that differ by less than a factor 2^(1/8), and is cut into blocks.
2. The longest vectors (``SEEDS`` per number of components) are scored first: the k-th best
   there is a lower bound of each query's k-th score, its threshold.
3. A query needs only vectors at least as long as threshold / own length.  Queries are grouped
   by classes of this needed length, and a block is sent only to groups that can need it.
4. Inside a tile candidates come in buckets of ``BUCKET``, longest first.  For each query and
   bucket the local threshold is the cosine that a vector of the bucket's greatest length needs
   to reach the query's current k-th score.  Above 1 the bucket is skipped.  Otherwise the
   method is chosen per query: coordinate pruning takes the vectors whose unit coordinate, for one
   of the query's ``FOCUS`` largest, lies where the angle to the query can be small enough;
   length pruning takes the longest vectors down to threshold / own length; the one that
   leaves fewer is used.  What is left is verified by exact products.
5. The tiles' best lists are merged.

Pruning bounds carry a relative slack of 1e-9 against rounding, so no result is lost; scores
that equal the threshold are verified too, as ties go to the smaller id.  Thresholds of 0 or
less prune nothing.

Null vectors and those with null or non-finite components take no part; zero vectors score 0.
Vectors of different length (number of components) are not compared.  Repeated rows are rows
of their own: a copy of the query's row is a candidate.  A row of null id is a candidate (its id
comes last among ties) but no query.  An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tiles import (LOWEST, QUERY_BYTES, TILE_ROWS, Best, best_of_tiles, block_rows, every, integers, matrix, parts,
                    real_id, spot, streams)

SEEDS = 4096
BUCKET = 2048
FOCUS = 3
CHUNK = 512
SLACK = 1e-9
NO_LENGTH = -(1 << 20)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices; through doubles where these are exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Queries:
    """The queries of a tile with their thresholds and best lists."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        def numbers(name):
            return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)

        self.row, self.id, self.length = numbers("row"), numbers("vec_id"), numbers("length")
        self.width = int(numbers("width")[0])
        self.vector = matrix(batch.column(batch.schema.get_field_index("vector")), self.width)
        self.least = numbers("threshold").astype(np.int64)
        self.best = Best(len(self.row), k)
        unit = self.vector / np.where(self.length > 0, self.length, 1.0)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.at_focus = np.take_along_axis(unit, self.focus, axis=1)

    def threshold(self) -> np.ndarray:
        """The score that a candidate must reach."""
        return np.maximum(self.least, self.best.floor)


class Bucket:
    """Candidates of a bucket, longest first, with their coordinates in sorted lists."""

    def __init__(self, vector, length, ids, rows):
        order = np.argsort(-length, kind="stable")
        self.vector, self.length, self.id, self.row = vector[order], length[order], ids[order], rows[order]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int):
        """(positions, unit coordinates) of the candidates in ascending order of coordinate ``f``."""
        if f not in self.lists:
            unit = self.vector[:, f] / np.where(self.length > 0, self.length, 1.0)
            order = np.argsort(unit, kind="stable")
            self.lists[f] = order, unit[order]
        return self.lists[f]


def _search(q: Queries, b: Bucket) -> tuple[int, int, int]:
    """Offers the candidates of a bucket to the queries; (skipped, by coordinate, by length)
    counts of queries."""
    theta = q.threshold().astype(np.float64)
    reach = q.length * b.length[0]
    # Local threshold: the cosine needed against the longest vector of the bucket.
    local = np.where((theta > 0) & (reach > 0), theta / np.maximum(reach, 1e-300), np.where(theta > 0, 2.0, -1.0))
    alive = np.flatnonzero(local <= 1 + SLACK)
    needed = np.where(theta > 0, theta / np.maximum(q.length, 1e-300), -1.0) * (1 - SLACK)
    prefix = np.searchsorted(-b.length, -needed, "right")
    beyond = np.arccos(np.clip(local, -1.0, 1.0))
    by_coordinate, by_length = [], []
    for i in alive:
        chosen, fewest = None, prefix[i] // 2
        if local[i] > 0:
            for f, x in zip(q.focus[i], np.clip(q.at_focus[i], -1.0, 1.0)):
                axis = np.arccos(x)
                lowest = np.cos(min(np.pi, axis + beyond[i])) - SLACK
                highest = np.cos(max(0.0, axis - beyond[i])) + SLACK
                order, values = b.sorted_list(int(f))
                lo, hi = np.searchsorted(values, lowest, "left"), np.searchsorted(values, highest, "right")
                if hi - lo < fewest:
                    chosen, fewest = order[lo:hi], hi - lo
        if chosen is None:
            by_length.append(i)
        else:
            by_coordinate.append((i, chosen[chosen < prefix[i]]))
    for i, found in by_coordinate:
        _offer(q, b, np.array([i]), np.sort(found))
    by_length = np.array(by_length, np.int64)
    by_length = by_length[np.argsort(prefix[by_length], kind="stable")]
    for start in range(0, len(by_length), CHUNK):
        some = by_length[start:start + CHUNK]
        _offer(q, b, some, slice(0, int(prefix[some].max())))
    return len(q.row) - len(alive), len(by_coordinate), len(by_length)


def _offer(q: Queries, b: Bucket, some: np.ndarray, found) -> None:
    vectors, ids, rows = b.vector[found], b.id[found], b.row[found]
    if not len(rows):
        return
    scores = _exact(q.vector[some], vectors)
    wanted = (scores >= q.least[some][:, None]) & (q.row[some][:, None] != rows)
    q.best.offer(some, scores, wanted, ids, rows)


def _buckets(candidates, width: int):
    """The candidates of a tile in buckets, longest first."""
    batches = list(candidates)
    if not batches:
        return
    all_ = pa.concat_batches(batches)

    def numbers(name):
        return all_.column(all_.schema.get_field_index(name)).to_numpy(zero_copy_only=False)

    length, ids, rows = numbers("length"), numbers("vec_id"), numbers("row")
    order = np.argsort(-length, kind="stable")
    vector = all_.column(all_.schema.get_field_index("vector"))
    for start in range(0, len(order), BUCKET):
        at = order[start:start + BUCKET]
        yield Bucket(matrix(vector.take(pa.array(at)), width), length[at], ids[at], rows[at])


def _seeded(k: int):
    """Queries with the k-th best score among the seeds as their threshold."""
    def run(batches):
        for queries, candidates in streams(batches, 2, "side"):
            q = Queries(queries, k)
            for bucket in _buckets(candidates, q.width):
                _search(q, bucket)
            at = queries.schema.get_field_index("threshold")
            yield queries.set_column(at, "threshold", pa.array(q.threshold())).select(
                ["row", "vec_id", "width", "vector", "length", "threshold"])

    return run


def _found(k: int):
    def run(batches):
        for queries, candidates in streams(batches, 5, "side"):
            q = Queries(queries, k)
            for bucket in _buckets(candidates, q.width):
                _search(q, bucket)
            best = q.best
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (q.row[best.slot], q.id[best.slot], best.score, best.id, best.row)],
                ["query", "query_id", "score", "id", "other"])

    return run


QUERY = "row long, vec_id long, width int, vector array<long>, length double, threshold long"


def _class(length: F.Column) -> F.Column:
    """The class of a length: 8 classes for a factor of two."""
    return F.when(length > 0, F.floor(F.log2(length) * 8).cast("int")).otherwise(NO_LENGTH)


def _with_thresholds(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    queries = queries.withColumn("threshold", F.lit(LOWEST))
    per = stored(parts(queries, ["width"], block_rows(QUERY_BYTES), "parts"), "parts")
    longest = Window.partitionBy("width").orderBy(F.desc("length"), "row")
    seeds = rows.withColumn("_n", F.row_number().over(longest)).where(
        (F.col("_n") <= SEEDS) & (F.col("_n") <= block_rows(QUERY_BYTES))).drop("_n").withColumn("threshold", F.lit(LOWEST))
    both = queries.join(per, "width").withColumn("part", spot("parts")).withColumn("side", F.lit(0)).drop("parts").unionByName(
        seeds.join(per, "width").withColumn("part", every("parts")).withColumn("side", F.lit(1)).drop("parts"))
    both = both.select("width", "part", "side", "row", "vec_id", "vector", "length", "threshold")
    return both.repartition("width", "part").sortWithinPartitions("width", "part", "side").mapInArrow(_seeded(k), QUERY)


def search(vectors: DataFrame, query: F.Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows by integer inner product for
    every row of ``vectors`` for which ``query``, a condition on vec_id, holds."""
    rows = integers(vectors, scale).withColumn(
        "length", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    queries = stored(_with_thresholds(rows.where(real_id("vec_id").isNotNull() & query), rows, k), "queries")
    need = F.when((F.col("threshold") > 0) & (F.col("length") > 0), F.col("threshold") / F.col("length") * (1 - SLACK)).otherwise(0.0)
    queries = queries.withColumn("need", _class(need))
    rows = rows.withColumn("class", _class(F.col("length")))
    # Neighbouring classes of need share a group while they fit one block.
    needs = queries.groupBy("width", "need").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("width").orderBy("need").rowsBetween(Window.unboundedPreceding, -1))
    needs = stored(needs.withColumn("group", F.floor(F.coalesce(before, F.lit(0)) / block_rows(QUERY_BYTES)).cast("int")), "needs")
    groups = needs.groupBy("width", "group").agg(
        F.min("need").alias("need"), F.ceil(F.sum("n") / block_rows(QUERY_BYTES)).cast("int").alias("parts"))
    # A class is reached by the groups that need its lengths (rounding can move either by one).
    classes = parts(rows, ["width", "class"], F.least(F.lit(TILE_ROWS), block_rows(2 * QUERY_BYTES)), "blocks")
    reach = stored(groups.join(classes, "width").where(F.col("need") <= F.col("class") + 1).drop("need"), "reach")
    tile = ["width", "class", "block", "group", "part"]
    names = [*tile, "side", "row", "vec_id", "vector", "length", "threshold"]
    asked = queries.join(needs.drop("n"), ["width", "need"]).join(reach, ["width", "group"]).withColumn("part", spot("parts")).withColumn("block", every("blocks")).withColumn("side", F.lit(0))
    given = rows.join(reach, ["width", "class"]).withColumn("block", spot("blocks")).withColumn("part", every("parts")).withColumn("side", F.lit(1))
    given = given.withColumn("threshold", F.lit(LOWEST))
    dealt = asked.select(names).unionByName(given.select(names)).repartition(*tile).sortWithinPartitions(*tile, "side")
    found = dealt.mapInArrow(_found(k), "query long, query_id long, score long, id long, other long")
    return best_of_tiles(found, ["query"], k, "rank").select("query_id", "rank", real_id("id").alias("vec_id"), "score")
