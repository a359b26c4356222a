"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

1. Equal vectors form one class with a count.  Classes are the nodes of what follows.
2. Spherical k-means is fitted on at most ``SAMPLE`` vectors (``SAMPLE_BYTES`` in all); every
   vector goes to the cell of its nearest centre.
3. Vectors are written once as blocks of up to ``BLOCK_BYTES``, sorted by cell, and each pair of
   blocks is compared by a task that reads both (a Cartesian product of the table's parts): no
   vector is copied, so the disk in use is in proportion to the input.
4. For near vectors x of cell c and y of cell h, the depths of x behind the plane between both
   centres and of y behind it add to at most the step |x - y|.  Only pairs whose depths add to at
   most the longest step that the similarity allows are multiplied, in single precision; cosines
   within its rounding of the similarity are worked out again in double.  No pair is lost with
   ``slack=None``; with a smaller ``slack`` only pairs with one depth of at most half of it count,
   which is faster and approximate.  A pair of blocks returns one row per linked vector (links
   counted, and the smallest node of its component inside both blocks), never the pairs.
5. Components of these rows give the groups; the smallest id of each is kept.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
nor do vectors of different length; lengths other than the sample's most frequent one have
one cell each.  Copies count as other vectors, also under one id.  A null id takes part but
represents a group only if it has no other id (component_id is null then).  An empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, stored
from .components import components

SIMILARITY = 0.9
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
CELLS = 2048
ROUNDS = 8
BLOCK = 512
BLOCK_BYTES = 2 << 20
PART_BYTES = 64 << 20


def unit(rows: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that squares of very small or
    large components neither vanish nor overflow."""
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array column of one length as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def fit_cells(vectors: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Centres (k x width) of spherical k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(ROUNDS):
        home = (vectors @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, vectors)
        length = np.linalg.norm(sums, axis=1)
        alone = length < 1e-9
        sums[alone], length[alone] = vectors[rng.integers(0, len(vectors), alone.sum())], 1.0
        centres = sums / length[:, None]
    return centres


def _centres(nodes: DataFrame) -> tuple[np.ndarray, int] | None:
    """Centres fitted on a sample of the most frequent vector length, and how many vectors have it."""
    row = nodes.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    if row is None:
        return None
    width, n = row
    size = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * width)))
    sample = nodes.where(F.col("width") == width).orderBy(F.xxhash64("node"), "node").limit(size)
    vectors = unit(matrix(sample.select("embedding").toArrow()["embedding"].combine_chunks(), width))
    k = max(1, min(CELLS, round(n ** 0.5), len(vectors) // 4))
    return fit_cells(vectors, k), n


def _assign(shared, narrow: bool):
    """Rows (cell, node, copies, width, vector as bytes): each vector with the cell of its nearest centre."""
    kind = np.float32 if narrow else np.float64

    def run(batches):
        centres = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                width, column = part.column(2).to_numpy(), part.column(3)
                cell = -width.astype(np.int64)  # of other lengths
                main = np.flatnonzero(width == centres.shape[1])
                if len(main):
                    cell[main] = (unit(matrix(column.take(pa.array(main)), centres.shape[1])) @ centres.T).argmax(axis=1)
                values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
                ends = np.cumsum(width)
                raw = [values[b - n:b].tobytes() for b, n in zip(ends, width)]
                yield pa.RecordBatch.from_arrays([pa.array(cell), part.column(0), part.column(1), part.column(2), pa.array(raw, pa.binary())],
                                                 ["cell", "node", "copies", "width", "vector"])

    return run


def _packed(most: int, nbytes: int):
    """Blocks of rows that come sorted by cell: vectors of one length, at most ``most`` of them and about ``nbytes``."""
    def run(batches):
        held, size = [], 0

        def block():
            cell, node, copies, width, vector = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array([width[0]], pa.int32()), *(pa.array([np.array(x, np.int64).tobytes()], pa.binary()) for x in (cell, node, copies)),
                 pa.array([b"".join(vector)], pa.binary())], ["width", "cells", "nodes", "copies", "vectors"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (row[3] != held[-1][3] or len(held) >= most or size + len(row[4]) > nbytes):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield block()

    return run


class _Block:
    """A block's nodes, copies, unit vectors (double and single precision) and runs of one cell."""

    def __init__(self, row: dict, side: str, kind):
        self.cells, self.nodes, self.copies = (np.frombuffer(row[f"{side}_{x}"], np.int64) for x in ("cells", "nodes", "copies"))
        self.units = unit(np.frombuffer(row[f"{side}_vectors"], kind).astype(np.float64).reshape(len(self.cells), -1))
        self.single = self.units.astype(np.float32)
        starts = np.append(0, np.flatnonzero(self.cells[1:] != self.cells[:-1]) + 1)
        self.runs = list(zip(self.cells[starts].tolist(), starts.tolist(), np.append(starts[1:], len(self.cells)).tolist()))

    def behind(self, cells: list[int], centres: np.ndarray) -> np.ndarray:
        """How much nearer each vector is to its own centre than to those of ``cells``, as cosines."""
        own = (self.units * centres[self.cells]).sum(axis=1)
        return own[:, None] - self.units @ centres[cells].T


def _hits(left: _Block, right: _Block, a: np.ndarray, b: np.ndarray, similarity: float, margin: float):
    """Places in ``a`` and ``b`` of the linked pairs.  Only cosines within the rounding of single
    precision of ``similarity`` are worked out again in double."""
    cosine = left.single[a] @ right.single[b].T
    flat = np.flatnonzero(cosine.ravel() >= np.float32(similarity - margin))
    if not len(flat):
        return flat, flat
    i, j = np.divmod(flat, len(b))
    linked = cosine.ravel()[flat] >= similarity + margin
    unsure = np.flatnonzero(~linked)
    for start in range(0, len(unsure), 16_384):
        some = unsure[start:start + 16_384]
        linked[some] = np.einsum("ij,ij->i", left.units[a[i[some]]], right.units[b[j[some]]]) >= similarity
    return i[linked], j[linked]


def _join(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``root`` (of each place the smallest of its component) after the links u - v."""
    while True:
        x, y = root[u], root[v]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]


def _links(left: _Block, right: _Block, same: bool, centres: np.ndarray, similarity: float, step: float, slack: float, chunk: int):
    """(left places, right places) of linked pairs, in parts.  For x of cell c and y of cell h only
    pairs whose depths behind the plane between both centres add to the longest step."""
    margin = 2e-7 * (left.units.shape[1] + 8)
    planes = left.runs[0][0] >= 0
    if planes:
        to_left, to_right = [c for c, *_ in left.runs], [c for c, *_ in right.runs]
        depth_a, depth_b = left.behind(to_right, centres), right.behind(to_left, centres)
    for p, (c, a0, a1) in enumerate(left.runs):
        for q, (h, b0, b1) in enumerate(right.runs):
            if same and q < p:
                continue
            a, b = np.arange(a0, a1), np.arange(b0, b1)
            if c == h:
                for start in range(0, len(a), chunk):
                    i, j = _hits(left, right, a[start:start + chunk], b, similarity, margin)
                    i, j = i + a0 + start, j + b0
                    if same:
                        i, j = i[i < j], j[i < j]
                    if len(i):
                        yield i, j
                continue
            gap = np.linalg.norm(centres[c] - centres[h])
            most, half = step * gap + 1e-9, slack / 2 * gap + 1e-12
            x, y = depth_a[a0:a1, q], depth_b[b0:b1, p]
            use, low = np.flatnonzero(x <= most - y.min()), np.flatnonzero(y <= most - x.min())
            if not len(use) or not len(low):
                continue
            a, b = a[use[np.argsort(x[use])]], b[low[np.argsort(y[low])]]
            x, y = depth_a[a, q], depth_b[b, p]
            size = min(chunk, max(64, -(-len(a) // 4)))
            for start in range(0, len(a), size):
                top = most - x[start]
                n = int(np.searchsorted(y, min(top, half) if x[start] > half else top, "right"))
                if not n:
                    break
                i, j = _hits(left, right, a[start:start + size], b[:n], similarity, margin)
                kept = np.minimum(x[start + i], y[j]) <= half
                if kept.any():
                    yield a[start + i[kept]], b[j[kept]]


def _compare(shared, narrow: bool, similarity: float, step: float, slack: float, chunk: int):
    kind = np.float32 if narrow else np.float64

    def run(batches):
        held = {}
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: column[n].as_py() for name, column in zip(batch.schema.names, batch.columns)}
                for side in "ab":
                    if held.get(side, (None,))[0] != row[f"{side}_block"]:
                        held[side] = row[f"{side}_block"], _Block(row, side, kind)
                left, right, same = held["a"][1], held["b"][1], row["a_block"] == row["b_block"]
                nodes = left.nodes if same else np.concatenate([left.nodes, right.nodes])
                copies = left.copies if same else np.concatenate([left.copies, right.copies])
                found, root = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
                for i, j in _links(left, right, same, shared.value, similarity, step, slack, chunk):
                    j = j if same else j + len(left.nodes)
                    for u, v in ((i, j), (j, i)):
                        found += np.bincount(u, copies[v], len(nodes)).astype(np.int64)
                    root = _join(root, i, j)
                some = np.flatnonzero(found)
                if len(some):
                    least = nodes.copy()
                    np.minimum.at(least, root, nodes)
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(found[some]), pa.array(least[root[some]])], ["node", "n", "to"])

    return run


def _linked(nodes: DataFrame, similarity: float, slack: float | None) -> DataFrame:
    """(node, n, to) rows of all pairs of blocks."""
    spark = nodes.sparkSession
    fitted = _centres(nodes)
    if fitted is None:
        return spark.createDataFrame([], "node long, n long, to long")
    centres, n = fitted
    step = (2 - 2 * similarity) ** 0.5
    shared = spark.sparkContext.broadcast(centres)
    narrow = nodes.schema["embedding"].dataType.elementType.typeName() == "float"
    assigned = nodes.select("node", "copies", "width", "embedding").mapInArrow(
        _assign(shared, narrow), "cell long, node long, copies long, width int, vector binary")
    row_bytes, cores = (4 if narrow else 8) * centres.shape[1], max(2, spark.sparkContext.defaultParallelism)
    # Enough blocks for the cores; a part is held once by each task that reads it.
    most = max(1, min(16 * BLOCK, max(BLOCK, n // (4 * cores)), BLOCK_BYTES // row_bytes))
    parts = max(1, min(2 * cores, n // (8 * BLOCK)), n * row_bytes // PART_BYTES)
    spread = assigned.repartitionByRange(parts, "cell", F.xxhash64("node")).sortWithinPartitions("cell")
    # Pairs of parts are tasks; a session that deals rows to more parts gets no more of them.
    blocks = spread.coalesce(parts).mapInArrow(_packed(most, BLOCK_BYTES), "width int, cells binary, nodes binary, copies binary, vectors binary")
    blocks = cut(blocks.withColumn("block", F.monotonically_increasing_id()))
    left, right = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    # Each pair of blocks once, shared out evenly to both orders of their parts.  Tasks read two
    # parts of the written table; no copy of a vector is shuffled.
    a, b = F.col("a_block"), F.col("b_block")
    odd = (a + F.shiftright(a, 33) + b + F.shiftright(b, 33)) % 2 == 1
    pairs = left.hint("shuffle_replicate_nl").join(right, (F.col("a_width") - F.col("b_width") == 0) & ((a == b) | ((a != b) & ((a < b) == odd))))
    return pairs.mapInArrow(_compare(shared, narrow, similarity, step, step if slack is None else slack, BLOCK), "node long, n long, to long")


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, slack: float | None = None) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    prepare(vectors.sparkSession)
    e = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Single precision is kept as it is; as doubles every table would be twice as large.
    narrow = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = vectors.select("vec_id", (F.col("embedding") if narrow else e).alias("embedding"), F.xxhash64(e).alias("k1"), F.xxhash64(F.lit(1), e).alias("k2"))
    rows = stored(rows.withColumn("valid", F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))), "vectors")
    nodes = rows.where("valid").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    nodes = stored(nodes.withColumns({"node": F.monotonically_increasing_id(), "width": F.size("embedding")}), "nodes")
    linked = cut(_linked(nodes, similarity, slack))
    groups = components(linked.select(F.col("node").alias("a"), F.col("to").alias("b")))
    thin = nodes.select("k1", "k2", "node", "vec_id", "copies")
    named = cut(thin.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = cut(named.groupBy("component").agg(F.min("vec_id").alias("component_id")))
    links = cut(linked.groupBy("node").agg(F.sum("n").alias("n")))
    named = named.join(least, "component").join(links, "node", "left").select(
        "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id", F.lit(True).alias("found"))
    # Written first, so that the join is between two plain shuffles and a hot vector can be split.
    named = cut(named)
    out = rows.where("valid").select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    out = out.select("vec_id", "n_links", "component_id").unionByName(
        rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def deduplicate(vectors: DataFrame, similarity: float = SIMILARITY, slack: float | None = None) -> DataFrame:
    """``vectors`` (same columns) of the kept ids."""
    kept = near_duplicates(vectors, similarity, slack).where("kept").select("vec_id").distinct()
    return vectors.join(kept, vectors["vec_id"].eqNullSafe(kept["vec_id"]), "left_semi")
