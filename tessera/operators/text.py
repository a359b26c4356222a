"""Text and retrieval jobs over document tables.

Steps are column expressions over whole texts (``split``, ``array_sort``,
``regexp_extract``, ``transform``...).  Two run in Arrow batches: the chunk packer, whose
cuts depend on each other, and the similarity search, where each task multiplies its batch
of corpus vectors with a part of the queries (bounded in bytes) in NumPy and keeps only its
k best rows per query before anything is shuffled.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import round_half_up
from ..functions.vectors import l2_norm
from ..session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have the package

QUERY_BYTES = 8 << 20

# Fixed values (they define the semantics that must be reproduced):
# whitespace as Python's str.strip()/str.split() understand it, and the line boundaries of
# str.splitlines(); both derived from Python's own definitions.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
PY_LINE_BREAKS = "".join(chr(c) for c in range(0x3001) if len(("a" + chr(c) + "b").splitlines()) == 2)


def _java_class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in chars) + "]"


WS = _java_class(PY_WHITESPACE)
TOKEN = f"[^{WS[1:]}+{WS}*"
LINE_BREAK = "\\r\\n|" + _java_class(PY_LINE_BREAKS)
# the context separator, prompt texts and the fallback answer of the retrieval chat.
CONTEXT_SEP = "\n\n---\n\n"
SYSTEM_MSG = ("You are a helpful assistant for question answering. "
              "Use only the provided context to answer. If the answer is not in the context, "
              "say: I don't know.")
FALLBACK_ANSWER = "I don't know based on the provided document."
# the multiple-choice format: line patterns (case-insensitive, per line) and the reasons
# reported for a missing part.
OPTION_LABELS = ("A", "B", "C", "D")
MCQ_QUESTION = r"(?im)^question:\s*(.+)$"
MCQ_OPTION = r"(?im)^{label}\)\s*(.+)$"
MCQ_ANSWER = r"(?im)^correct answer:\s*([ABCD])\b"
MCQ_MISSING_QUESTION = "Missing 'Question:' line."
MCQ_MISSING_OPTION = "Missing or malformed option {label})."
MCQ_MISSING_ANSWER = "Missing 'Correct Answer:' letter (A/B/C/D)."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace (a character-set trim)."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def split_paragraphs(text, sep: str = "\n\n") -> Column:
    """CR -> LF, split on ``sep``, strip, drop empty pieces (an array column)."""
    cleaned = F.regexp_replace(_c(text), "\r", "\n")
    parts = F.split(cleaned, "\\Q" + sep + "\\E", -1)
    return F.filter(F.transform(parts, py_strip), lambda p: p != "")


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               sep: str = "\n\n") -> DataFrame:
    """T1 as rows: (doc, paragraph number from 0, paragraph)."""
    return docs.select(id_col, F.posexplode(split_paragraphs(text_col, sep))
                       .alias("para_id", "paragraph"))


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_chars: int = 800, sep: str = "\n\n") -> DataFrame:
    """T1 + T2: (doc, chunk number from 0, chunk text): greedy packing of paragraphs into chunks
    of at most ``max_chars`` characters.

    A paragraph is appended to the open chunk (joined by LF) while
    ``len(chunk) + len(paragraph) + 1 <= max_chars``; otherwise the open chunk is closed and
    the paragraph opens the next one, or, when it is longer than ``max_chars``, is cut into
    ``max_chars`` pieces that are closed at once.  Chunks that are only whitespace are dropped.
    Where a chunk ends depends on where the one before ended, so each text is packed by one
    loop in its task, in time proportional to its length.
    """
    def packed(paragraphs):
        chunk, size = [], 0
        for p in paragraphs:
            if size + len(p) + 1 <= max_chars:
                size += len(p) + (1 if size else 0)
                chunk.append(p)
                continue
            if chunk:
                yield "\n".join(chunk)
            chunk, size = ([p], len(p)) if len(p) <= max_chars else ([], 0)
            if not chunk:
                yield from (p[i:i + max_chars] for i in range(0, len(p), max_chars))
        if chunk:
            yield "\n".join(chunk)

    def run(batches):
        for b in batches:
            for ident, paragraphs in zip(b.column(0), b.column(1)):
                chunks = [c for c in packed(paragraphs.as_py() or ()) if c.strip()]
                if chunks:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ident.as_py()] * len(chunks), b.column(0).type), pa.array(range(len(chunks)), pa.int32()), pa.array(chunks)],
                        [id_col, "chunk_id", "chunk"])

    schema = T.StructType([docs.schema[id_col], T.StructField("chunk_id", T.IntegerType()), T.StructField("chunk", T.StringType())])
    return docs.select(id_col, split_paragraphs(text_col, sep).alias("_p")).mapInArrow(run, schema)


def label_centroids(vectors: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Mean vector per label (element-wise), as query vectors: (label, centroid)."""
    x = vectors.select(label_col, F.posexplode(vec_col).alias("_pos", "_x"))
    m = x.groupBy(label_col, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    return (m.groupBy(label_col)
            .agg(F.sort_array(F.collect_list(F.struct("_pos", "_m"))).alias("_a"))
            .select(label_col, F.transform("_a", lambda s: s["_m"]).alias("centroid")))


def cosine_topk(corpus: DataFrame, queries: DataFrame, k: int = 2, corpus_id: str = "vec_id",
                corpus_vec: str = "embedding", query_id: str = "query_id",
                query_vec: str = "query_vec", eps: float = 1e-12) -> DataFrame:
    """T3 + T4: the ``k`` corpus rows most similar (cosine) to each query.

    Similarity is the dot product of the two L2-normalised vectors (eps 1e-12), unrounded;
    ties go to the smaller corpus id.  Queries are dealt into parts of at most about
    ``QUERY_BYTES``; a part at a time is broadcast, and every task keeps the k best of its corpus
    rows per query, so the corpus is never moved and only (tasks x queries x k) rows are
    shuffled for the final rank.  A matrix product finds the rows near a query's k-th best;
    their similarity is then summed component by component, so that equal vectors tie
    exactly.  Vectors that are null or of another length than the queries take no part.
    """
    spark = corpus.sparkSession
    n, width = queries.agg(F.count(query_vec), F.coalesce(F.max(F.size(query_vec)), F.lit(0))).first()
    parts = max(1, math.ceil(8 * n * max(width, 1) / QUERY_BYTES))
    base = scratch_path(spark, "topk")
    usable = F.col("v").isNotNull() & (F.size("v") == width)
    queries.select(F.col(query_id).alias("q"), F.col(query_vec).cast("array<double>").alias("v")).where(usable).withColumn(
        "part", F.pmod(F.xxhash64("q"), F.lit(parts))).write.parquet(f"{base}/queries")
    rows = corpus.select(F.col(corpus_id).alias("c"), F.col(corpus_vec).cast("array<double>").alias("v")).where(usable)
    asked = spark.read.parquet(f"{base}/queries")
    fields = [T.StructField(query_id, queries.schema[query_id].dataType), T.StructField(corpus_id, corpus.schema[corpus_id].dataType),
              T.StructField("similarity", T.DoubleType())]
    best = Window.partitionBy(query_id).orderBy(F.desc("similarity"), corpus_id)
    for part in range(parts):
        block = asked.where(F.col("part") == part).select("q", "v").toArrow().combine_chunks()
        shared = spark.sparkContext.broadcast((_array(block["q"]), _matrix(block["v"], width, eps)))
        found = rows.mapInArrow(_nearest(shared, k, width, eps, [f.name for f in fields]), T.StructType(fields))
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).write.mode("append").parquet(f"{base}/found")
        shared.unpersist()
    return spark.read.parquet(f"{base}/found")


def _array(column) -> pa.Array:
    """A column as one array."""
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else (
        column if isinstance(column, pa.Array) else pa.array([], column.type))


def _matrix(column, width: int, eps: float) -> np.ndarray:
    """Normalised vectors of an array column."""
    m = _array(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    return m / (np.sqrt((m * m).sum(axis=1, keepdims=True)) + eps)


def _nearest(shared, k: int, width: int, eps: float, names):
    """Keeps the k best (similarity, id) of a task's corpus rows per query."""
    def ranked(table):
        order = pc.sort_indices(table, sort_keys=[("slot", "ascending"), ("s", "descending"), ("c", "ascending")])
        table = table.take(order)
        slot = table["slot"].to_numpy()
        inside = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        return table.filter(pa.array(inside < k)), slot[inside == k - 1], table["s"].to_numpy()[inside == k - 1]

    def run(batches):
        ids, queries = shared.value
        floor, held = np.full(len(ids), -np.inf), None
        for b in batches:
            for start in range(0, b.num_rows, 1024):  # bounds the products in memory
                piece = b.slice(start, 1024)
                c = _matrix(piece.column(1), width, eps)
                for first in range(0, len(ids), 1024):
                    some = queries[first:first + 1024]
                    near = c @ some.T
                    least = floor[first:first + 1024]
                    if len(c) > k:
                        least = np.maximum(least, np.partition(near, len(c) - k, axis=0)[len(c) - k])
                    i, j = np.nonzero(near >= least - 1e-9)
                    s = np.zeros(len(i))
                    for d in range(width):
                        s += c[i, d] * some[j, d]
                    new = pa.table({"slot": j + first, "s": s, "c": piece.column(0).take(pa.array(i))})
                    held, full, kth = ranked(new if held is None else pa.concat_tables([held, new]))
                    floor[full] = kth
        if held is not None and len(held):
            yield pa.RecordBatch.from_arrays([ids.take(_array(held["slot"])), _array(held["c"]), _array(held["s"])], names)

    return run


def normalize_vectors(df: DataFrame, vec_col: str, places: int = 9, eps: float = 1e-12) -> DataFrame:
    """T3 as a column job: each vector divided by (its L2 norm + eps)."""
    x = df.withColumn("_norm", l2_norm(vec_col))  # once per row, not once per element
    unit = F.transform(F.col(vec_col), lambda v: round_half_up(v.cast("double") / (F.col("_norm") + F.lit(eps)), places))
    return x.withColumn(vec_col + "_unit", unit).drop("_norm")


def assemble_prompts(contexts: DataFrame, questions: DataFrame, query_id: str = "query_id",
                     rank_col: str = "rank", text_col: str = "context",
                     question_col: str = "question") -> DataFrame:
    """T5: per query the contexts in rank order joined by the separator, wrapped in the plain
    prompt template.  Contexts per query are the top-k rows (bounded by k)."""
    ctx = (contexts.groupBy(query_id)
           .agg(F.sort_array(F.collect_list(F.struct(rank_col, text_col))).alias("_c"))
           .select(query_id, F.array_join(F.transform("_c", lambda s: s[text_col]), CONTEXT_SEP)
                   .alias("context")))
    user = F.concat(F.lit("Context:\n"), F.col("context"), F.lit("\n\nQuestion: "),
                    F.col(question_col), F.lit("\nAnswer in 2-5 sentences:"))
    return (ctx.join(questions, query_id)
            .select(query_id, F.concat(F.lit(SYSTEM_MSG + "\n\n"), user, F.lit("\n")).alias("prompt")))


def truncate_tail(text, max_ctx: int, max_new_tokens: int, safety_margin: int = 32,
                  min_tokens: int = 128) -> Column:
    """The text from the first of its last ``max(max_ctx - max_new_tokens - safety_margin,
    min_tokens)`` whitespace tokens on, with its line breaks; shorter texts are returned
    unchanged."""
    allowed = max(max_ctx - max_new_tokens - safety_margin, min_tokens)
    toks = F.regexp_extract_all(_c(text), F.lit(TOKEN), F.lit(0))
    n = F.size(toks)
    tail = F.slice(toks, F.greatest(F.lit(1), n - F.lit(allowed) + 1), F.lit(allowed))
    return F.when(n > allowed, F.array_join(tail, "")).otherwise(_c(text))


def clean_answer(text, fallback: str = FALLBACK_ANSWER, min_chars: int = 10) -> Column:
    """Text after the first 'Answer:' (all of it if that part is empty), lines stripped,
    empty lines dropped, repeated lines (ignoring case) dropped keeping the first, joined by
    blanks; a result under ``min_chars`` characters becomes the fallback text."""
    t = py_strip(text)
    parts = F.split(t, "\\QAnswer:\\E", 2)
    after = py_strip(F.element_at(parts, -1))
    t = F.when(F.size(parts) > 1, F.when(after != "", after).otherwise(t)).otherwise(t)
    lines = F.filter(F.transform(F.split(t, LINE_BREAK, -1), py_strip), lambda ln: ln != "")
    # Lines sorted by (lower case, place): the first of each run stays, back in its place.
    keyed = F.transform(lines, lambda ln, i: F.struct(F.lower(ln).alias("key"), i.alias("i"), ln.alias("line")))
    first = F.transform(F.array(F.array_sort(keyed)), lambda a: F.filter(
        a, lambda x, i: (i == 0) | (x["key"] != F.get(a, i - 1)["key"])))[0]
    placed = F.array_sort(F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["line"].alias("line"))))
    dedup = F.transform(placed, lambda x: x["line"])
    joined = py_strip(F.array_join(dedup, " "))
    return F.when(F.length(joined) < min_chars, F.lit(fallback)).otherwise(joined)


def parse_mcq(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Question, four options and the answer letter of an MCQ block.

    Instead of raising, each row gets ``is_valid`` and the first missing part as ``reason``.
    """
    text = py_strip(raw_col)
    q = F.regexp_extract(text, MCQ_QUESTION, 1)
    opts = [F.regexp_extract(text, MCQ_OPTION.format(label=lbl), 1) for lbl in OPTION_LABELS]
    ans = F.regexp_extract(text, MCQ_ANSWER, 1)
    reason = F.when(q == "", F.lit(MCQ_MISSING_QUESTION))
    for lbl, o in zip(OPTION_LABELS, opts):
        reason = reason.when(o == "", F.lit(MCQ_MISSING_OPTION.format(label=lbl)))
    reason = reason.when(ans == "", F.lit(MCQ_MISSING_ANSWER))
    return df.select(
        "*", py_strip(q).alias("question"),
        F.array(*[py_strip(o) for o in opts]).alias("options"),
        F.upper(ans).alias("answer"), reason.alias("reason"),
        reason.isNull().alias("is_valid"))


def score_quiz(attempts: DataFrame, questions: DataFrame, user_col: str = "user_id",
               qid: str = "question_id") -> DataFrame:
    """Per user: attempts, correct and incorrect (valid questions only)."""
    j = attempts.join(questions.filter("is_valid").select(qid, "answer"), qid)
    ok = (F.col("choice") == F.col("answer")).cast("long")
    return j.groupBy(user_col).agg(F.count(F.lit(1)).alias("total"), F.sum(ok).alias("correct"),
                                   (F.count(F.lit(1)) - F.sum(ok)).alias("incorrect"))


def attempt_breakdown(attempts: DataFrame, questions: DataFrame, user_col: str = "user_id",
                      qid: str = "question_id") -> DataFrame:
    """One row per option of each attempt: label, text and status
    ('correct', 'your choice' for a wrong pick, 'other')."""
    j = attempts.join(questions.filter("is_valid").select(qid, "options", "answer"), qid)
    x = j.select(user_col, qid, "choice", "answer", F.posexplode("options").alias("_pos", "option_text"))
    label = F.element_at(F.array(*[F.lit(v) for v in OPTION_LABELS]), F.col("_pos") + 1)
    status = (F.when(label == F.col("answer"), "correct")
              .when(label == F.col("choice"), "your choice").otherwise("other"))
    return x.select(user_col, qid, label.alias("option_label"), "option_text", status.alias("status"))


def context_preview(df: DataFrame, text_col: str, score_col: str, n_chars: int = 400) -> DataFrame:
    """First ``n_chars`` characters with LF as blanks, '...' when longer, score to 3
    places (rounded half up)."""
    t = F.col(text_col)
    prev = F.concat(F.regexp_replace(F.substring(t, 1, n_chars), "\n", " "),
                    F.when(F.length(t) > n_chars, F.lit("...")).otherwise(F.lit("")))
    return df.withColumns({
        "preview": prev,
        "score_text": F.format_string("%.3f", round_half_up(F.col(score_col), 3)),
    })
