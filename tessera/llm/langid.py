"""Language identification by segmentation-marginalised unigram models.

The vocabulary is that of a public byte-level tokenizer (all its tokens without digits or
punctuation that do not begin in upper case, and all single bytes).  Each language has a
probability for every piece.  A word is a run of ASCII letters and characters from U+0080 up,
lower-cased and preceded by a blank; its probability is the sum over all ways to cut it into
pieces, computed by a forward pass over its bytes.  Pieces do not cross words, so the sum over
all segmentations of a text is the product over its words, and each distinct word of a batch
is scored once.  Words of any length are whole: the pass holds as many positions as the longest
piece has bytes and is rescaled on the way, so that its memory does not grow with the word.

Learning: piece probabilities by expectation-maximisation (forward-backward) over the word
counts of about ``TRAIN_DOCS`` documents a language, those with the smallest hashes of their
id, whole texts, from documents that are not held out.  Only text and language are used.  All
languages are modelled, ``LANGUAGES_AT_ONCE`` of them in one pass; the model has 8 bytes for
every piece and language (about 0.3 MB a language), on the driver and in each worker.

Null text and text without a letter give ``und`` with score 0; the score of other texts is
the posterior of the predicted language under equal priors.  Ties go to the alphabetically
first language.  Without labelled documents everything is ``und``.  Null languages and null
ids are not learned from; a null id is not held out.  Repeated rows give repeated rows, an
empty table an empty table; other columns are not read.  A very long text is one batch.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, prepare, small_batches, stored, utf8_parts
from .words import CLASS, PUNCT, WORD, tokens

TRAIN_DOCS = 400
LANGUAGES_AT_ONCE = 64
ROUNDS = 3
SMOOTHING = 0.1
#: Pieces are scaled by this factor a byte, and a pass every RESCALE bytes, so that words of
#: any length stay within doubles.
SCALE = 100.0
RESCALE = 16
LETTERS = np.where(CLASS == WORD, WORD, PUNCT).astype(np.uint8)
LETTERS[48:58] = PUNCT
BATCH_BYTES = 8 << 20
#: Up to this many bytes, words of one length share a block; longer ones are padded by up to an eighth.
SHORT = 48
BLOCK_BYTES = 64 << 20


class Pieces:
    """The vocabulary as a trie of sorted edges by depth; pieces are numbered by length, then bytes."""

    def __init__(self, path: str):
        kept = {bytes([b]) for b in range(256)}
        with open(path, "rb") as f:
            for line in f:
                token = base64.b64decode(line.split()[0]) if line.strip() else b""
                body = np.frombuffer(token.removeprefix(b" "), np.uint8)
                if len(token) > 1 and (LETTERS[body] == WORD).all() and not (b"A" <= token.strip()[:1] <= b"Z"):
                    kept.add(token)
        ordered = sorted(kept, key=lambda t: (len(t), t))
        self.numbers = {t: i for i, t in enumerate(ordered)}
        self.lengths = np.array([len(t) for t in ordered])
        self.size, self.longest = len(ordered), len(ordered[-1])
        self.edges, self.piece, above = [], [], {b"": 0}
        for depth in range(1, self.longest + 1):
            # A node is its place among the sorted prefixes of its depth; an edge is (node above, byte).
            prefixes = sorted({t[:depth] for t in ordered if len(t) >= depth})
            self.edges.append(np.array([above[t[:-1]] * 256 + t[-1] for t in prefixes]))
            self.piece.append(np.array([self.numbers.get(t, -1) for t in prefixes]))
            above = {t: i for i, t in enumerate(prefixes)}

    def matches(self, words: np.ndarray, start: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For rows of ``words`` (n x bytes): by length, (rows where a piece begins at ``start``, pieces)."""
        n, width = words.shape
        rows, node, out = np.arange(n), np.zeros(n, np.int64), []
        for edges, piece, at in zip(self.edges, self.piece, range(start, width)):
            key = node * 256 + (words[rows, at] if len(rows) < n else words[:, at])
            node = np.searchsorted(edges, key)
            hit = edges[np.minimum(node, len(edges) - 1)] == key
            if not hit.all():
                rows, node = rows[hit], node[hit]
            if not len(rows):
                break
            ends = piece[node] >= 0
            out.append((rows, piece[node]) if ends.all() else (rows[ends], piece[node[ends]]))
        return out


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def words_of(texts: pa.Array):
    """(hash, text index, first byte, last byte + 1, bytes) of the words of lower-cased texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets, data = utf8_parts(pc.utf8_lower(texts))
    return *tokens(offsets, data, classes=LETTERS), data


def blocks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cell_bytes: int):
    """(word numbers, their bytes after a blank, widths) in blocks of words of like length.

    ``cell_bytes`` is what a word needs beside its bytes; a block keeps to BLOCK_BYTES or is one word.
    """
    size = ends - starts
    order = np.argsort(size, kind="stable")
    kind = np.where(size <= SHORT, size, SHORT + 1 + np.floor(np.log(np.maximum(size, SHORT) / SHORT) / np.log(1.125)).astype(np.int64))
    edges = np.append(np.flatnonzero(np.append(True, np.diff(kind[order]) > 0)), len(order))
    for a, b in zip(edges, edges[1:]):
        widest = int(size[order[b - 1]]) if b > a else 0
        rows = int(max(1, min(20_000, BLOCK_BYTES // (cell_bytes + 32 * (widest + 1)))))
        for i in range(a, b, rows):
            which = order[i:min(i + rows, b)]
            block = np.zeros((len(which), int(size[which].max()) + 1), np.uint8)
            block[:, 0] = 32
            if widest <= SHORT:
                block[:, 1:] = data[starts[which][:, None] + np.arange(widest)]
            else:
                for row, w in zip(block, which):
                    row[1:size[w] + 1] = data[starts[w]:ends[w]]
            yield which, block, size[which] + 1


def forward(vocabulary: Pieces, block: np.ndarray, widths: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Log probability (words x languages) of each word, summed over its segmentations."""
    n, width = block.shape
    slots = min(vocabulary.longest, width) + 1
    alpha = np.zeros((slots, n, probability.shape[1]))
    alpha[0] = 1.0
    logs, out = np.zeros(alpha.shape[1:]), np.empty(alpha.shape[1:])
    for start in range(width + 1):
        here = alpha[start % slots]
        if start == width or start > SHORT:
            done = np.flatnonzero(widths == start)
            out[done] = np.log(here[done]) + logs[done]
        if start == width:
            break
        if start and start % RESCALE == 0:
            factor = here.copy()
            alpha /= factor
            logs += np.log(factor)
        for size, (rows, piece) in enumerate(vocabulary.matches(block, start), 1):
            if len(rows) == n:
                alpha[(start + size) % slots] += here * probability[piece]
            elif len(rows):
                alpha[(start + size) % slots, rows] += here[rows] * probability[piece]
        here[:] = 0.0
    return out - (widths * np.log(SCALE))[:, None]


def expected(vocabulary: Pieces, block: np.ndarray, widths: np.ndarray, weight: np.ndarray, lang: np.ndarray,
             probability: np.ndarray, out: np.ndarray) -> None:
    """Adds the expected piece counts of words (one language each) to ``out`` (pieces x languages)."""
    n, width = block.shape
    each = np.arange(n)
    alpha, beta = np.zeros((width + 1, n)), np.zeros((width + 1, n))
    alpha[0] = 1.0
    beta[widths, each] = 1.0
    logs = np.zeros((width // RESCALE + 1, n))
    for start in range(width + 1):
        if start and start % RESCALE == 0:
            factor = alpha[start].copy()
            alpha[start:start + vocabulary.longest + 1] /= factor
            logs[start // RESCALE] = logs[start // RESCALE - 1] + np.log(factor)
        for size, (rows, piece) in enumerate(vocabulary.matches(block, start), 1):
            alpha[start + size, rows] += alpha[start, rows] * probability[piece, lang[rows]]
    total = np.log(alpha[widths, each]) + logs[widths // RESCALE, each]
    after = np.zeros(n)
    for start in range(width - 1, -1, -1):
        # Both passes are rescaled on their way; the shares need their true product.
        true = np.where(start < widths, np.exp(np.minimum(logs[start // RESCALE] + after - total, 700.0)), 0.0) * weight
        for size, (rows, piece) in enumerate(vocabulary.matches(block, start), 1):
            step = probability[piece, lang[rows]] * beta[start + size, rows]
            beta[start, rows] += step
            np.add.at(out, (piece, lang[rows]), alpha[start, rows] * step * true[rows])
        if start % RESCALE == 0:
            factor = np.where((beta[start] > 0) & (start < widths), beta[start], 1.0)
            beta[start:start + vocabulary.longest + 1] /= factor
            after += np.log(factor)


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _training_words(docs: DataFrame, train_docs: int) -> tuple[list[str], DataFrame]:
    """Languages and the table (lang number, word, n) of the learning sample."""
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return [], None
    rates = [(lang, i, min(1.0, train_docs / counts[lang])) for i, lang in enumerate(languages)]
    # As a written table its size is known, so that a short list is broadcast and no text is moved.
    rates = stored(docs.sparkSession.createDataFrame(rates, "lang string, number int, rate double"), "languages")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    sample = usable.join(rates, "lang").where(place < F.col("rate")).select("text", F.col("number").alias("lang"))

    def run(batches):
        for batch in small_batches(batches):
            hashes, doc, starts, ends, data = words_of(batch.column(0))
            lang = batch.column(1).to_numpy()[doc]
            order = np.lexsort((lang, hashes))
            new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (lang[order][1:] != lang[order][:-1]))[:len(order)]
            at = np.flatnonzero(new)
            first = order[at]
            yield pa.RecordBatch.from_arrays([
                pa.array(lang[first], pa.int32()),
                pa.array([data[starts[i]:ends[i]].tobytes() for i in first], pa.binary()),
                pa.array(np.diff(np.append(at, len(order))))], ["lang", "word", "n"])

    words = sample.mapInArrow(run, "lang int, word binary, n long")
    return languages, cut(words.groupBy("lang", "word").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS) -> tuple[list[str], list[np.ndarray]]:
    """Languages and their scaled piece probabilities, a matrix (pieces x languages) for every
    LANGUAGES_AT_ONCE of them.

    What reaches the driver at once is one number per piece and language of one matrix.
    """
    spark = docs.sparkSession
    prepare(spark)
    languages, words = _training_words(docs, train_docs)
    vocabulary = pieces(path)
    trie = spark.sparkContext.broadcast(vocabulary)
    scale = SCALE ** vocabulary.lengths[:, None]
    out = []
    for first in range(0, len(languages), LANGUAGES_AT_ONCE):
        some = min(LANGUAGES_AT_ONCE, len(languages) - first)
        own = words.where(F.col("lang").between(first, first + some - 1)) if some < len(languages) else words
        probability = np.full((vocabulary.size, some), 1.0 / vocabulary.size)
        for _ in range(ROUNDS):
            shared = spark.sparkContext.broadcast(probability * scale)
            rows = own.mapInArrow(_counting(trie, shared, first), "piece int, lang int, n double")
            rows = rows.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
            shared.unpersist()
            counts = np.full(probability.shape, SMOOTHING)
            counts[rows["piece"], rows["lang"]] += rows["n"]
            probability = counts / counts.sum(axis=0)
        out.append(probability * scale)
    return languages, out


def _counting(trie, shared, first: int):
    """Expected piece counts of the words of a partition, languages counted from ``first``."""
    def run(batches):
        out = np.zeros_like(shared.value)
        for batch in batches:
            lang, weight = batch.column(0).to_numpy() - first, batch.column(2).to_numpy().astype(float)
            offsets, data = utf8_parts(batch.column(1))
            for which, block, widths in blocks(data, offsets[:-1], offsets[1:], 0):
                expected(trie.value, block, widths, weight[which], lang[which], shared.value, out)
        piece, lang = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(out[piece, lang])],
                                         ["piece", "lang", "n"])

    return run


def predict(docs: DataFrame, languages: list[str], model: list[np.ndarray], path: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    prepare(spark)
    trie = spark.sparkContext.broadcast(pieces(path))
    shared = [spark.sparkContext.broadcast(m) for m in model]

    def run(batches):
        vocabulary = trie.value
        for batch in small_batches(batches, BATCH_BYTES):
            hashes, doc, starts, ends, data = words_of(batch.column(3))
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            scores = np.zeros((len(first), len(languages)))
            cell_bytes = 8 * (vocabulary.longest + 3) * min(len(languages), LANGUAGES_AT_ONCE)
            for rows, block, widths in blocks(data, starts[first], ends[first], cell_bytes):
                for i, part in enumerate(shared):
                    at = i * LANGUAGES_AT_ONCE
                    scores[rows, at:at + LANGUAGES_AT_ONCE] = forward(vocabulary, block, widths, part.value)
            total = np.stack([np.bincount(doc, scores[which, k], batch.num_rows) for k in range(len(languages))], axis=1)
            best = total.argmax(axis=1)
            score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([languages[b] if k else "und" for b, k in zip(best, letters)], pa.string()),
                pa.array(np.where(letters, score, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), letters.alias("letters"), "text")
    if not languages:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Learns from the documents that are not held out and predicts all."""
    return predict(docs, *fit(docs, path, train_docs), path)
