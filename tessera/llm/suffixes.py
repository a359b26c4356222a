"""Benchmark decontamination with suffix arrays of the training text.

Documents are taken in shards (Arrow batches of about 8 MB).  Words become numbers of the
benchmark's vocabulary (0: not in it); a shard's suffix array sorts, by their first words,
the suffixes that begin with at least as many benchmark words as the shortest window has
(no other suffix can hold a window).  Every distinct window of the benchmark is
binary-searched in it, so a place has at most one hit for each length of window, however often words
repeat.  Of the benchmark suffixes that begin with the window, those whose preceding word differs
from the document's start a match; it is extended word by word to the longest verbatim
match, so that each document gets the matches with their places, the words they cover and the items
found.  Documents never leave their task; nothing is shuffled.  Very long and repetitive texts
take time in proportion to their words and matches.

Words: runs of 0-9, a-z (A-Z lower-cased first) and characters from U+0080 up.  A window is
``window`` consecutive words of an item, or all words of a shorter item.

Null or empty text has no words and is clean.  Items without words or with a null id match
nothing; items repeated under one id count once; equal windows of several items report each
item.  Repeated documents give repeated rows.  Empty tables: no document, no row; no item,
no hit.  All columns are kept; added ones get a trailing underscore if their name is taken.
The benchmark is broadcast in blocks of at most ``BLOCK_BYTES`` of text (measured first);
with more than one block the table is written between the passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, fresh, prepare, small_batches, stored, utf8_parts
from .words import tokens

WINDOW = 10
BLOCK_BYTES = 48 << 20
SHARD_BYTES = 8 << 20
HITS = "array<struct<begin:int,until:int>>"
MATCHES = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"


class Suffixes:
    """Benchmark windows, packed for the search: built on the driver from one bounded block."""

    def __init__(self, ids: list, texts: pa.Array, window: int):
        offsets, data = utf8_parts(texts)
        hashes, item, _, _ = tokens(offsets, data)
        self.ids = np.array([str(i) for i in ids], dtype=object)
        self.vocabulary = np.unique(hashes)
        self.words = (np.searchsorted(self.vocabulary, hashes) + 1).astype(np.int64)
        counts = np.bincount(item, minlength=len(ids))
        size = np.minimum(counts, window)[item]
        place = np.arange(len(item)) - (np.cumsum(counts) - counts)[item]
        self.at = np.flatnonzero(place + size <= counts[item])  # suffixes that hold a window
        self.item, self.place, self.size = item[self.at], place[self.at], size[self.at]
        self.left = counts[self.item] - self.place  # words to the item's end
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.shortest = int(self.size.min()) if len(self.at) else 0
        depth = int(self.size.max()) if len(self.at) else 1
        self.per = min(62 // self.bits, depth)
        self.keys = -(-depth // self.per)
        self._classes()

    def _classes(self) -> None:
        """Suffixes in classes of equal windows, inside a class by the word before them (-1: none)."""
        keys = self.pack(self.words, self.at, self.size)
        before = np.where(self.place > 0, self.words[self.at - 1] if len(self.at) else 0, -1)
        order = np.lexsort((before, *keys[::-1]))
        for name in ("at", "item", "place", "size", "left"):
            setattr(self, name, getattr(self, name)[order])
        keys = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], len(order)).astype(np.int64)
        self.span = len(self.vocabulary) + 3
        self.by_before = (np.cumsum(new) - 1) * self.span + before[order] + 1
        # The items of each class.
        pairs = np.unique(np.stack([np.cumsum(new) - 1, self.item]), axis=1) if len(order) else np.zeros((2, 0), np.int64)
        self.class_item, self.item_start = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.start) + 1))

    def starts(self, codes: np.ndarray, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The (document position, suffix) pairs of the hits that start a match: the words before
        both differ."""
        before = np.where(at > 0, codes[at - 1], 0)  # 0 is no benchmark word
        wanted = group * self.span + before + 1
        low, high = np.searchsorted(self.by_before, wanted, "left"), np.searchsorted(self.by_before, wanted, "right")
        low, high = np.where(before > 0, low, self.end[group]), np.where(before > 0, high, self.end[group])
        first, upto = np.append(self.start[group], high), np.append(low, self.end[group])
        return np.repeat(np.append(at, at), upto - first), ranges(first, upto)

    def pack(self, codes: np.ndarray, at: np.ndarray, size=None, plus: int = 0) -> list[np.ndarray]:
        """Integer keys of the first words at ``at``; past ``size`` words are 0.  ``plus`` is
        added to the last word."""
        codes = np.append(codes, np.zeros(self.per * self.keys, np.int64))
        out = []
        for k in range(self.keys):
            key = np.zeros(len(at), np.int64)
            for j in range(k * self.per, (k + 1) * self.per):
                word = codes[at + j]
                if size is not None:
                    word = np.where(j < size, word, 0) + plus * (j == size - 1)
                key = (key << self.bits) + word
            out.append(key)
        return out

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (document position, class of windows) pairs."""
        filled = codes > 0
        zero = np.append(np.flatnonzero(~filled), len(codes))
        at = np.flatnonzero(filled)
        at = at[zero[np.searchsorted(zero, at)] - at >= self.shortest]
        keys = self.pack(codes, at)
        order = np.lexsort(keys[::-1])
        at, keys = at[order], [k[order] for k in keys]
        one, size = self.at[self.start], self.size[self.start]
        low = bisect(keys, self.pack(self.words, one, size))
        high = bisect(keys, self.pack(self.words, one, size, 1))
        return at[ranges(low, high)], np.repeat(np.arange(len(low)), high - low)


def ranges(first: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """All numbers of the half-open ranges, one range after the other."""
    n = upto - first
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def bisect(keys: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """First place in the lexicographically sorted ``keys`` not below each wanted key."""
    low = np.zeros(len(wanted[0]), np.int64)
    high = np.full(len(low), len(keys[0]), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        below, equal = np.zeros(len(low), bool), open_.copy()
        for k, w in zip(keys, wanted):
            value = k[np.minimum(mid, len(k) - 1)]
            below |= equal & (value < w)
            equal &= value == w
        low = np.where(open_ & below, mid + 1, low)
        high = np.where(open_ & ~below, mid, high)
    return low


def _lists(doc: np.ndarray, n: int, columns: dict[str, np.ndarray | pa.Array]) -> pa.Array:
    """Rows, sorted by document, as one list of structs for each document."""
    ends = np.append(0, np.cumsum(np.bincount(doc, minlength=n))).astype(np.int32)
    struct = pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int32))
                                         for c in columns.values()], list(columns))
    return pa.ListArray.from_arrays(pa.array(ends), struct)


def match_block(index: Suffixes, texts: pa.Array, before=None, matches: bool = True) -> dict[str, pa.Array]:
    """n_words, hits, items and matches (if wanted) of each text; ``before``: hits of earlier
    blocks."""
    n = len(texts)
    offsets, data = utf8_parts(texts)
    hashes, doc, _, _ = tokens(offsets, data)
    counts = np.bincount(doc, minlength=n)
    starts = np.cumsum(counts) - counts + np.arange(n)  # each document is followed by a 0
    code = np.searchsorted(index.vocabulary, hashes)
    known = code < len(index.vocabulary)
    known[known] = index.vocabulary[code[known]] == hashes[known]
    codes = np.zeros(len(hashes) + n, np.int64)
    spot = np.arange(len(hashes)) + doc
    codes[spot[known]] = code[known] + 1
    owner = np.repeat(np.arange(n), counts + 1)

    empty = np.zeros(0, np.int64)
    at, group = index.search(codes) if len(index.at) else (empty, empty)
    marks = np.zeros(len(codes) + 1, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + index.size[index.start[group]], -1)
    if before is not None:
        for d, hits in enumerate(before.to_pylist()):
            for h in hits or ():
                marks[starts[d] + h["begin"]] += 1
                marks[starts[d] + h["until"]] -= 1
    covered = np.append(np.cumsum(marks[:-1]) > 0, False)
    edge = np.flatnonzero(np.diff(np.append(False, covered).astype(np.int8)))
    begin, until = edge[::2], edge[1::2]
    hits = _lists(owner[begin], n, {"begin": begin - starts[owner[begin]], "until": until - starts[owner[begin]]})

    found = np.unique(np.stack([owner[at], group]), axis=1)
    first, upto = index.item_start[found[1]], index.item_start[found[1] + 1]
    pairs = np.unique(np.stack([np.repeat(found[0], upto - first), index.class_item[ranges(first, upto)]]), axis=1)
    ends = np.append(0, np.cumsum(np.bincount(pairs[0], minlength=n))).astype(np.int32)
    items = pa.ListArray.from_arrays(pa.array(ends), pa.array(index.ids[pairs[1]], pa.string()))
    out = {"n_words": pa.array(counts, pa.int64()), "hits": hits, "items": items}
    return out | ({"matches": _matches(index, codes, at, group, owner, starts, n)} if matches else {})


def _matches(index: Suffixes, codes, at, group, owner, starts, n: int) -> pa.Array:
    """The longest matches of the hits (``at``, ``group``)."""
    words = np.append(index.words, 0)
    at_, suffix_ = index.starts(codes, at, group)
    length = index.size[suffix_].copy()
    going = np.arange(len(length))
    while len(going):
        going = going[length[going] < index.left[suffix_[going]]]
        going = going[codes[at_[going] + length[going]] == words[index.at[suffix_[going]] + length[going]]]
        length[going] += 1
    order = np.lexsort((suffix_, at_))
    at_, suffix_, length = at_[order], suffix_[order], length[order]
    return _lists(owner[at_], n, {
        "item_id": pa.array(index.ids[index.item[suffix_]], pa.string()),
        "item_word": index.place[suffix_], "doc_word": at_ - starts[owner[at_]], "n_words": length})


def _blocks(benchmark: DataFrame, window: int, limit: int):
    """The benchmark as indexes of at most about ``limit`` bytes of text each."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // limit) if size > limit else 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n if n > 1 else 1))
    for k in range(2 * n if n > 1 else 1):
        block = items.where(part == k).toArrow()
        texts = block["text"].combine_chunks() if block.num_rows else pa.array([], pa.string())
        yield Suffixes(block["item_id"].to_pylist(), texts, window)


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES, matches: bool = True) -> DataFrame:
    """``docs`` with n_words, hits (word ranges), items (ids found) and, if wanted, matches
    (longest)."""
    spark = docs.sparkSession
    prepare(spark)
    added = {n: fresh(docs, n) for n in ("n_words", "hits", "items", *(["matches"] if matches else []))}
    kinds = {"n_words": "bigint", "hits": HITS, "items": "array<string>", "matches": MATCHES}
    schema = extended(docs, **{a: kinds[k] for k, a in added.items()})
    out = docs
    for number, index in enumerate(_blocks(benchmark, window, block_bytes)):
        shared = spark.sparkContext.broadcast(index)
        later = number > 0

        def run(batches, shared=shared, later=later):
            index = shared.value
            for batch in small_batches(batches, SHARD_BYTES, text_col):
                column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                got = match_block(index, column[text_col], column[added["hits"]] if later else None, matches)
                if later:
                    for k in ("items", *(["matches"] if matches else [])):
                        old, new = column[added[k]].to_pylist(), got[k].to_pylist()
                        got[k] = pa.array([(a or []) + b for a, b in zip(old, new)], got[k].type)
                column |= {added[k]: v for k, v in got.items()}
                yield pa.RecordBatch.from_arrays(list(column.values()), list(column))

        if later:
            out = stored(out, "decontamination")
        out = out.mapInArrow(run, schema)
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(docs.select("doc_id", "text"), benchmark, window=window, matches=False)
    items = F.array_sort(F.array_distinct("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["until"] - h["begin"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (same columns) without the documents that hold a window of the benchmark."""
    hits = fresh(docs, "hits")
    return find(docs, benchmark, window=window, matches=False).where(F.size(hits) == 0).select(docs.columns)
