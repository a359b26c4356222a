"""Spelling variants: words one edit apart, found through a trie of letter-group counts.

1. Texts give their runs of letters, counted as words (``word_counts``: plain SQL functions,
   summed before the shuffle).
2. A word's vector holds how many of its letters fall into each of ``GROUPS``.  An edit of one
   code point changes it by a surplus of one in one group (an insertion), a deficit of one (a
   deletion) or both (a replacement; none if both letters share a group).
3. Words are arranged in tries by successive group counts.  A trie holds the words of one
   prefix of ``PREFIX`` counts (a block of ``BLOCK`` of them, if there are more); a word is sent
   as a query to every prefix that one surplus and one deficit can reach.
4. A depth-first search walks the trie with what is left of the budget; the words at the
   leaves it reaches are verified letter by letter.  Each pair is searched from one side: from the shorter
   word, or of equally long ones from the one whose vector is the smaller, so the surplus is
   spent before the deficit.  The search works on bounded chunks of (query, node) states, kept on
   a stack, so memory does not grow with the number of states.
5. Per word the near words are counted and the most frequent is chosen; forms are followed to
   their root by pointer doubling (a form is ``RATIO`` times as frequent, so no chain is
   longer than log(2^63) / log(RATIO), and the number of joins is fixed).

Null and empty texts have no words; a null id counts as empty.  Texts of any length are
read whole.  Words may have any length.  Repeated rows are documents of their own.  Ties go to the word
that is first in code-point order.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, stored
from .tiles import every, streams

MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
#: Letters counted together; all others share the group after these.
GROUPS = ("e", "a", "i", "n", "o", "r", "s", "t", "l", "u", "d", "c", "m", "h", "g", "pb", "vw", "fk", "yjxqz")
PREFIX = 6
BLOCK = 65_536
STATES = 1 << 16
LETTERS = 1 << 22


def word_counts(docs: DataFrame, drop_every: int = 199) -> DataFrame:
    """(word, n) of all texts: maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-casing only A-Z.

    Of a run whose hash h, the CRC-32 of ``<doc_id>:<run>``, is divisible by ``drop_every``,
    code point h mod length is left out.
    """
    run, text = "[A-Za-zÀ-ÿ]+", F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(ident.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(run), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = F.pmod(h, F.length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    runs = runs.select(F.when(h % drop_every == 0, short).otherwise(F.col("run")).alias("word"))
    return runs.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vector(word) -> F.Column:
    """Counts of the letter groups and of all other letters."""
    word = F.col(word)
    counts = [F.length(word) - F.length(F.translate(word, g, "")) for g in GROUPS]
    rest = F.length(F.translate(word, "".join(GROUPS), ""))
    return F.array(*counts, rest)


def _reachable(prefix: F.Column) -> F.Column:
    """The prefixes that a search from the smaller side can reach: as it is, one surplus, or a
    surplus and a later deficit."""
    def changed(up, down=None):
        parts = [prefix[i] + (1 if i == up else -1 if i == down else 0) for i in range(PREFIX)]
        return F.array(*parts)

    out = [prefix, *[changed(i) for i in range(PREFIX)],
           *[changed(i, j) for i in range(PREFIX) for j in range(i + 1, PREFIX)]]
    return F.filter(F.array(*out), lambda p: F.forall(p, lambda x: x >= 0))


class Trie:
    """Distinct count vectors as a trie: at each level the nodes are the distinct beginnings,
    numbered in order, and a child is found by the key (parent, count)."""

    def __init__(self, vectors: np.ndarray):
        order = np.lexsort(vectors.T[::-1])
        rows = vectors[order]
        node = np.zeros(len(rows), np.int64)
        self.span = int(vectors.max(initial=0)) + 1
        self.levels = []
        for level in range(vectors.shape[1]):
            keys, node = np.unique(node * self.span + rows[:, level], return_inverse=True)
            self.levels.append(keys)
        # Words of each leaf: positions in ``order`` from starts to ends.
        self.order = order
        self.starts = np.searchsorted(node, np.arange(len(keys)), "left")
        self.ends = np.searchsorted(node, np.arange(len(keys)), "right")

    def step(self, level: int, node: np.ndarray, count: np.ndarray):
        """(found, child) of each (node, count)."""
        keys = self.levels[level]
        wanted = node * self.span + count
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return (count >= 0) & (count < self.span) & (keys[at] == wanted), at

    def search(self, queries: np.ndarray):
        """Chunks of (query, leaf) within a budget of one surplus and, after it, one deficit."""
        stack = []
        for start in range(0, len(queries), STATES):
            q = np.arange(start, min(start + STATES, len(queries)))
            stack.append((0, q, np.zeros(len(q), np.int64), np.zeros(len(q), np.int8)))
        while stack:
            level, q, node, spent = stack.pop()  # spent: 0 nothing, 1 the surplus, 2 both
            if level == len(self.levels):
                yield q, node
                continue
            parts = []
            for allowed, change, after in ((None, 0, 0), (0, 1, 1), (1, -1, 1)):
                some = np.arange(len(q)) if allowed is None else np.flatnonzero(spent == allowed)
                found, child = self.step(level, node[some], queries[q[some], level] + change)
                parts.append((q[some][found], child[found], (spent[some] + after)[found].astype(np.int8)))
            q, node, spent = (np.concatenate(x) for x in zip(*parts))
            for start in range(0, len(q), STATES):
                stop = start + STATES
                stack.append((level + 1, q[start:stop], node[start:stop], spent[start:stop]))


class Words:
    """Words as code points in one array."""

    def __init__(self, column: pa.Array):
        texts = column.to_pylist()
        self.length = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


def one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether word i of ``a`` becomes word j of ``b`` by one inserted or replaced code point:
    common beginning and end leave at most one code point of either."""
    short, long = a.length[i], b.length[j]
    ends = np.cumsum(short)
    pair = np.repeat(np.arange(len(i)), short)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - short, short)
    x = a.points[a.start[i][pair] + inside]
    same_front = x == b.points[b.start[j][pair] + inside]
    same_back = x == b.points[(b.start[j] + long - short)[pair] + inside]
    front = np.minimum.reduceat(np.where(same_front, short[pair], inside), ends - short)
    back = short - 1 - np.maximum.reduceat(np.where(same_back, -1, inside), ends - short)
    exact = (short == long) & (front == short)
    return ~exact & (front + back >= long - 1) & (long - short <= 1)


def _near(groups: int):
    """Both directions of every near pair of a tile: (word, n, other, other_n)."""
    def unpacked(batch):
        counts = batch.column(batch.schema.get_field_index("counts"))
        return counts.flatten().to_numpy().astype(np.int64).reshape(-1, groups), batch.column(batch.schema.get_field_index("word"))

    def run(batches):
        for members, queries in streams(batches, PREFIX + 1, "side"):
            vectors, texts = unpacked(members)
            trie, words = Trie(vectors), Words(texts)
            n = members.column(members.schema.get_field_index("n"))
            for batch in queries:
                asked_vectors, asked_texts = unpacked(batch)
                asked, asked_n = Words(asked_texts), batch.column(batch.schema.get_field_index("n"))
                for q, leaf in trie.search(asked_vectors):
                    for i, j in _pairs(trie, q, leaf, asked.length):
                        # Equal vectors: each pair once, from the word that comes first.
                        keep = one_edit(asked, i, words, j)
                        i, j = pa.array(i[keep]), pa.array(j[keep])
                        a, b = asked_texts.take(i), texts.take(j)
                        same = (asked_vectors[i] == vectors[j]).all(axis=1)
                        once = pa.array(~same | (pc.less(a, b)).to_numpy(zero_copy_only=False))
                        a, b, an, bn = (x.filter(once) for x in (a, b, asked_n.take(i), n.take(j)))
                        names = ["word", "n", "other", "other_n"]
                        yield pa.RecordBatch.from_arrays([a, an, b, bn], names)
                        yield pa.RecordBatch.from_arrays([b, bn, a, an], names)

    return run


def _pairs(trie: Trie, q: np.ndarray, leaf: np.ndarray, length: np.ndarray):
    """(query, member) of the words at the reached leaves, in chunks of about LETTERS letters."""
    sizes = trie.ends[leaf] - trie.starts[leaf]
    letters = np.cumsum(sizes * length[q])
    at = 0
    while at < len(q):
        base = letters[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(letters, base + LETTERS, "right")))
        s = sizes[at:stop]
        i = np.repeat(q[at:stop], s)
        inside = np.arange(len(i)) - np.repeat(np.cumsum(s) - s, s)
        yield i, trie.order[np.repeat(trie.starts[leaf[at:stop]], s) + inside]
        at = stop


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all ordered pairs of distinct words (each once in
    ``words``) that differ by one inserted, deleted or replaced code point."""
    prepare(words.sparkSession)
    base = words.select("word", "n", vector("word").alias("counts"))
    prefix = F.slice("counts", 1, PREFIX)
    names = [f"p{i}" for i in range(PREFIX)]
    members = base.withColumn("to", prefix)
    sizes = stored(members.groupBy("to").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks")), "prefixes")
    members = members.join(sizes, "to").withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).withColumn("side", F.lit(0))
    asked = base.withColumn("to", F.explode(_reachable(prefix))).join(sizes, "to").withColumn("block", every("blocks")).withColumn("side", F.lit(1))
    both = members.unionByName(asked).select(*[F.col("to")[i].alias(c) for i, c in enumerate(names)], "block", "side", "word", "n", "counts")
    tile = [*names, "block"]
    return both.repartition(*tile).sortWithinPartitions(*tile, "side").mapInArrow(
        _near(len(GROUPS) + 1), "word string, n long, other string, other_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form, by pointer doubling."""
    longest = math.ceil(63 / math.log2(RATIO))
    at = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(longest))):
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = cut(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return at


def variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """Per word of at least ``min_letters`` code points and ``min_count`` occurrences: word, n,
    n_near, form, form_n and root."""
    words = word_counts(docs).where((F.length("word") >= min_letters) & (F.col("n") >= min_count))
    words = stored(words, "words")
    near = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    out = words.join(near, "word", "left").withColumn("top", -F.col("best.m"))
    is_form = F.col("top") >= RATIO * F.col("n")
    out = stored(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                            F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, F.col("top")).alias("form_n")), "forms")
    roots = _roots(out.where("form is not null"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
