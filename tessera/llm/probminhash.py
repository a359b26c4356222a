"""Near-duplicate texts by ProbMinHash signatures, banding and exact verification.

Shingles are runs of five words (a shorter text is one shingle).  A shingle that occurs n times
has weight 1 + ln n.  Two texts are near if the probability Jaccard similarity of their weighted
shingles, the sum over common shingles i of 1 / sum_j max(x_j / x_i, y_j / y_i), is at least 0.8;
where no shingle repeats this is the Jaccard similarity of the shingle sets.  Candidates and
links use the same weights.  For every shingle a Poisson process of rate weight, seeded by the
shingle, throws arrivals on the signature's components; the shingle of the first arrival is the component's value, and two
texts agree in a component with the probability Jaccard similarity of their weighted shingles
(Ertl, 2020).  Generation ends early at a time by which all components are very likely
filled; texts with an empty component are continued to a later time, so nothing is lost.

1. Texts of equal words form one class, represented by its smallest id.
2. Representatives that agree in a whole band of the signature share a bucket.  Buckets are
   compared in tiles of about ``TILE`` x ``TILE`` signatures; tiles of a large bucket go to
   different tasks.  A tile returns, of the pairs whose signatures agree enough, only a
   maximum spanning forest (fewer pairs than rows).
3. The similarity of these pairs is computed exactly (in double precision, ``ROUNDING`` below
   0.8 still counts) and those of at least 0.8 are linked.
4. The pairs of step 2, verified or not, join the representatives to clusters that hold every
   agreeing pair.  Clusters whose members step 3 did not link to one component are compared
   once more, in tiles with their texts, of fewer rows where texts are long (about
   ``TILE_BYTES`` a side): each agreeing pair of different components is verified inside the
   tile, which returns a spanning forest of the links found.
5. Connected components of all links are the classes of near duplicates.

The result is exact but for pairs that share no band (about 5e-5 of pairs at similarity 0.8,
fewer above) or whose signatures agree in fewer than ``AGREE`` of 125 components.

Null texts and texts without a word are similar to nothing.  Of repeated rows all get the
same class; a row with a null id belongs to its text's class but represents it only if the
class has no other id (then class_id is null and every such row is kept).  Empty tables give
empty tables.  Only the id and text columns are read; ``deduplicate`` keeps all columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, prepare, small_batches, sorted_groups, stored, utf8_parts
from .components import components
from .words import grams, mix, tokens

SHINGLE = 5
SIMILARITY = 0.8
ROUNDING = 1e-9
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
AGREE = 81
TILE = 256
TILE_BYTES = 8 << 20
PAIR_CELLS = 1 << 20  # shingles of the pairs compared at a time
_U = np.uint64


def shingles(offsets: np.ndarray, data: np.ndarray):
    """(shingle, text index) pairs, and the class hashes and word counts of the texts."""
    n = len(offsets) - 1
    hashes, doc, _, _ = tokens(offsets, data)
    counts = np.bincount(doc, minlength=n)
    place = (np.arange(len(doc)) - (np.cumsum(counts) - counts)[doc]).astype(_U)
    classes = np.zeros((2, n), _U)
    some = np.flatnonzero(counts)
    if len(some):
        firsts = (np.cumsum(counts) - counts)[some]
        classes[0, some] = np.add.reduceat(mix(hashes + place * _U(0xA0761D6478BD642F)), firsts)
        classes[1, some] = np.add.reduceat(mix((hashes ^ _U(0xE7037ED1A0B428DB)) * (_U(2) * place + _U(1))), firsts)
    runs, owner = grams(hashes, doc, SHINGLE)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    return np.concatenate([runs, classes[0, short]]), np.concatenate([owner, short]), classes, counts


def weighted(values: np.ndarray, owner: np.ndarray):
    """Distinct (text, shingle) pairs in order, with their weights: 1 + ln of the occurrences."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))[:len(values)])
    return values[first], owner[first], 1 + np.log(np.diff(np.append(first, len(values))))


def probability_jaccard(a, b, n: int) -> np.ndarray:
    """The probability Jaccard similarity of ``n`` pairs; a side is (shingle, pair, weight), the
    shingles of a pair distinct.  Sorted by the ratio of a pair's weights, the inner sum over j
    is one of x over the greater ratios and one of y over the smaller."""
    values, pair = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    left = np.concatenate([a[2], np.zeros(len(b[2]))])
    right = np.concatenate([np.zeros(len(a[2])), b[2]])
    if not len(values):
        return np.zeros(n)
    order = np.lexsort((values, pair))
    values, pair = values[order], pair[order]
    first = np.flatnonzero(np.append(True, (values[1:] != values[:-1]) | (pair[1:] != pair[:-1])))
    pair, left, right = pair[first], np.add.reduceat(left[order], first), np.add.reduceat(right[order], first)
    with np.errstate(divide="ignore"):
        order = np.lexsort((left / right, pair))
    pair, left, right = pair[order], left[order], right[order]
    ends = np.searchsorted(pair, np.arange(n + 1))
    x, y = np.append(0.0, np.cumsum(left)), np.append(0.0, np.cumsum(right))
    at = np.flatnonzero((left > 0) & (right > 0))
    inner = (x[ends[pair[at] + 1]] - x[at]) / left[at] + (y[at] - y[ends[pair[at]]]) / right[at]
    return np.bincount(pair[at], 1 / inner, n)


def signatures(values: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, time: float = 4.0) -> np.ndarray:
    """ProbMinHash signatures (n x COMPONENTS shingles; 0 for texts without shingles)."""
    total = np.bincount(owner, weight, n)
    end = (COMPONENTS / np.maximum(total, 1e-300) * (np.log(COMPONENTS) + time))[owner]
    best = np.full(n * COMPONENTS, np.inf)
    hits = []
    at, now = np.arange(len(values)), np.zeros(len(values))
    arrival = 0
    while len(at):
        arrival += 1
        bits = mix(values[at] + _U(arrival * 0x9E3779B97F4A7C15 % (1 << 64)))
        now = now - np.log(((bits >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight[at]
        early = now < end[at]
        at, now, bits = at[early], now[early], bits[early]
        slot = owner[at] * COMPONENTS + (mix(bits) % _U(COMPONENTS)).astype(np.int64)
        closer = now < best[slot]
        np.minimum.at(best, slot[closer], now[closer])
        hits.append((slot[closer], now[closer], at[closer]))
    out = np.zeros(n * COMPONENTS, _U)
    for slot, when, which in hits:
        won = best[slot] == when
        out[slot[won]] = values[which[won]]
    out = out.reshape(n, COMPONENTS)
    open_ = np.zeros(n, bool)
    open_[owner] = True
    open_ &= np.isinf(best).reshape(n, COMPONENTS).any(axis=1)
    if open_.any():
        rows = open_[owner]
        number = np.cumsum(open_) - 1
        out[open_] = signatures(values[rows], number[owner[rows]], weight[rows], int(open_.sum()), max(2 * time, 4.0))
    return out


SIGNED = "doc_id long, text_key long, n_words long, h1 long, h2 long, signature binary, bands array<long>"


def _sign(batches):
    names = [c.split()[0] for c in SIGNED.split(", ")]
    for batch in small_batches(batches):
        n = batch.num_rows
        values, owner, classes, counts = shingles(*utf8_parts(batch.column(2)))
        signature = signatures(*weighted(values, owner), n)
        bands = np.zeros((n, BANDS), _U)
        for r in range(ROWS):
            bands = mix(bands * _U(0xD6E8FEB86659FD93) + signature[:, r::ROWS])
        bands = mix(bands + np.arange(1, BANDS + 1, dtype=_U))
        small = (mix(signature) & _U(255)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
            pa.array(classes[0].view(np.int64)), pa.array(classes[1].view(np.int64)),
            pa.array([row.tobytes() for row in small], pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel())),
        ], names)


def sign(docs: DataFrame) -> DataFrame:
    """One row per document: id, hash of the exact text, word count, class hashes, the
    signature in 8 bits a component, and a hash of each band."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(_sign, SIGNED)


def _forest(agree: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest of a symmetric matrix of agreements (0: no pair)."""
    n, out = len(agree), []
    label = np.arange(n)
    while True:
        apart = np.where(label[:, None] != label[None, :], agree, 0)
        best = apart.argmax(axis=1)
        value = apart[np.arange(n), best]
        if not value.any():
            return out
        order = np.lexsort((-value.astype(int), label))
        order = order[value[order] > 0]
        parts = label[order]
        for i in order[np.append(True, parts[1:] != parts[:-1])]:  # the best pair of each part
            j = best[i]
            if label[i] != label[j]:
                out.append((int(i), int(j)))
                label[label == label[j]] = label[i]


def _agreeing(tile: pa.RecordBatch):
    """Node ids of a tile (bucket, i, j, node, block, signature, ...) and the symmetric matrix
    of how many components its rows agree in, 0 below ``AGREE`` and inside a block of two."""
    i, j = (tile.column(k)[0].as_py() for k in (1, 2))
    block = tile.column(4).to_numpy()
    signature = np.frombuffer(utf8_bytes(tile.column(5)), np.uint8).reshape(-1, COMPONENTS)
    agree = np.zeros((len(block), len(block)), np.uint8)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for k in left:
        same = np.count_nonzero(signature[right] == signature[k], axis=1)
        agree[k, right] = np.where(same >= AGREE, same, 0)
    np.fill_diagonal(agree, 0)
    return tile.column(3).to_numpy(), np.maximum(agree, agree.T)


def _pairs_batch(node: np.ndarray, agree: np.ndarray):
    found = np.array([(node[i], node[j]) for i, j in _forest(agree)], np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(found.min(axis=1)), pa.array(found.max(axis=1))], ["a", "b"])


def _candidates(batches):
    """A spanning forest of the agreeing pairs of each tile."""
    for tile in sorted_groups(batches, 3):
        if tile.num_rows > 1:
            node, agree = _agreeing(tile)
            if agree.any():
                yield _pairs_batch(node, agree)


def _shared(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many distinct shingles each two of ``n`` texts share, as a matrix."""
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    common = times[column] > 1
    number = np.cumsum(times > 1) - 1
    column, owner = number[column[common]], owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (start, start + 4096))
        used = np.zeros((n, 4096), np.float32)
        used[owner[a:b], column[a:b] - start] = 1.0
        out += used @ used.T
    return out.astype(np.int64)


def _links(values: np.ndarray, owner: np.ndarray, weight: np.ndarray, agree: np.ndarray, part: np.ndarray):
    """A spanning forest of the near pairs among the agreeing ones (a symmetric matrix), as row
    numbers.  Texts without a repeated shingle are compared as sets, all at once.  Of the other
    pairs those that agree most are compared first; those inside one part, as given or as linked
    by then, need no comparison."""
    starts = np.searchsorted(owner, np.arange(len(agree) + 1))
    size = np.diff(starts)
    plain = np.bincount(owner[weight > 1], minlength=len(agree)) == 0
    rows = plain[owner]
    shared = _shared(values[rows], owner[rows], len(agree))
    near = shared >= (SIMILARITY - ROUNDING) * (size[:, None] + size[None, :] - shared)
    agree = np.where(near | ~(plain[:, None] & plain[None, :]), agree, 0)
    i, j = np.nonzero(np.triu(agree))
    order = np.argsort(-agree[i, j].astype(int), kind="stable")
    i, j, part, out, chunk = i[order], j[order], part.copy(), [], 4 * len(agree)
    while True:
        apart = part[i] != part[j]
        i, j = i[apart], j[apart]
        if not len(i):
            return out
        n = min(chunk, max(1, int(np.searchsorted(np.cumsum(size[i] + size[j]), PAIR_CELLS, "right"))))
        sides = []
        for side in (i[:n], j[:n]):
            pair = np.repeat(np.arange(n), size[side])
            at = starts[side][pair] + np.arange(len(pair)) - (np.cumsum(size[side]) - size[side])[pair]
            sides.append((values[at], pair, weight[at]))
        for k in np.flatnonzero(probability_jaccard(*sides, n) >= SIMILARITY - ROUNDING):
            p, q = part[i[k]], part[j[k]]
            if p != q:
                out.append((int(i[k]), int(j[k])))
                part[part == q] = p
        i, j = i[n:], j[n:]


def _verified_tiles(batches):
    """Pairs of labels: a spanning forest of the exact links of each tile between labels."""
    for tile in sorted_groups(batches, 3):
        label = tile.column(6).to_numpy()
        if (label == label[0]).all():
            continue
        _, agree = _agreeing(tile)
        agree[label[:, None] == label[None, :]] = 0
        rows = np.flatnonzero(agree.any(axis=1))
        if not len(rows):
            continue
        values, owner, _, _ = shingles(*utf8_parts(tile.column(7).take(pa.array(rows))))
        values, owner, weight = weighted(values, owner)
        label = label[rows]
        found = np.array([(label[i], label[j]) for i, j in _links(values, owner, weight, agree[np.ix_(rows, rows)], label)], np.int64).reshape(-1, 2)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.min(axis=1)), pa.array(found.max(axis=1))], ["a", "b"])


def utf8_bytes(column: pa.Array) -> bytes:
    """The joined bytes of a binary column without nulls."""
    return utf8_parts(column.cast(pa.large_binary()))[1].tobytes()


def _tiles(members: DataFrame, *more: str) -> DataFrame:
    """Rows of ``members`` (bucket, size, node, signature, more) dealt to the tiles they are
    compared in: those of each two blocks of a bucket, and of each block with itself.  With a
    column ``bytes``, the bucket's text, blocks hold about ``TILE_BYTES`` at most."""
    blocks = F.ceil(F.col("size") / F.lit(TILE))
    if "bytes" in members.columns:
        blocks = F.least(F.col("size"), F.greatest(blocks, F.ceil(F.col("bytes") / F.lit(TILE_BYTES))))
    blocks = blocks.cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                       "node", "block", "signature", *more)
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose probability Jaccard similarity is at least 0.8."""
    def run(batches):
        for batch in small_batches(batches, 4 << 20, "text_a"):
            sides = []
            for i in (2, 3):
                values, owner, _, _ = shingles(*utf8_parts(batch.column(i)))
                sides.append(weighted(values, owner))
            near = pa.array(probability_jaccard(*sides, batch.num_rows) >= SIMILARITY - ROUNDING)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _groups(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) of the class representatives that have a candidate pair."""
    bands = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = cut(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = bands.join(shared, "bucket").join(nodes.select("node", "signature"), "node")
    pairs = cut(_tiles(members).mapInArrow(_candidates, "a long, b long").distinct())

    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    keys = nodes.join(wanted, "node", "left_semi").select("node", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    texts = texts.join(keys, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")))
    texts = stored(texts.groupBy("node").agg(F.first("text").alias("text")), "candidate_texts")

    found = components(_verified(pairs, texts)).withColumnRenamed("component", "label")
    labels = cut(wanted.join(found, "node", "left").withColumn("label", F.coalesce("label", "node")))
    # From here on the labels are the nodes: a cluster is a set of labels that pairs connect.
    a, b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
    apart = pairs.join(a, "a").join(b, "b").where("label_a <> label_b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    clusters = components(apart).select(F.col("node").alias("label"), F.col("component").alias("bucket"))
    members = cut(labels.join(clusters, "label"))
    members = members.join(texts.select("node", F.octet_length("text").alias("length")), "node")
    sizes = cut(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("length").alias("bytes")))
    members = members.join(sizes, "bucket").join(nodes.select("node", "signature"), "node").join(texts, "node")
    joined = components(_tiles(members, "label", "text").mapInArrow(_verified_tiles, "a long, b long"))
    joined = joined.withColumnRenamed("node", "label")
    return labels.join(joined, "label", "left").select("node", F.coalesce("component", "label").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text_key, text_class (smallest id of equal texts), class_id
    (smallest id of the near duplicates) and kept (it is that id)."""
    signed = stored(sign(docs), "signatures")
    classes = signed.where("n_words > 0").groupBy("h1", "h2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("least"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    # Numbers of their own, as one id may stand on several texts or be null.
    classes = stored(classes.select("h1", "h2", F.monotonically_increasing_id().alias("node"),
                                    "least.doc_id", "least.text_key", "signature", "bands"), "text_classes")
    linked = cut(_groups(docs, classes).join(classes.select("node", "doc_id"), "node"))
    least = linked.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    linked = linked.join(cut(least), "component").select("node", "class_id", F.lit(True).alias("linked"))
    named = cut(classes.select("h1", "h2", "node", "doc_id").join(linked, "node", "left").select(
        "h1", "h2", F.col("doc_id").alias("text_class"),
        F.when(F.col("linked"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")))
    rows = signed.select("doc_id", "text_key", "h1", "h2", "n_words").join(named, ["h1", "h2"], "left")
    worded = F.col("n_words") > 0
    own = F.when(worded, F.col("class_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "text_key", F.when(worded, F.col("text_class")).otherwise(F.col("doc_id")).alias("text_class"),
                       own.alias("class_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` (same columns) with one document of each class; repeated rows stay once."""
    key, number = fresh(docs, "text_key"), fresh(docs, "doc_number")
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias(number), F.col("text_key").alias(key)).distinct()
    rows = docs.withColumn(key, F.xxhash64("text"))
    same = rows[key].eqNullSafe(kept[key]) & rows["doc_id"].cast("long").eqNullSafe(kept[number])
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).select(docs.columns)
