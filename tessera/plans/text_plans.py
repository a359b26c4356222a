"""Keys for paragraph splitting, chunking, retrieval, prompts, answer cleaning and quizzes.

Stand-in inputs: document texts; the embedding table as the corpus, with one query per
label (the label's mean vector) and vector i embedding document i; the benchmark item of
the same number as the question text; assistant turns as model generations; MCQ blocks
and attempts built from the part table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as T
from ..sources.retail_model import RetailModel
from ..sources.tables import Tables
from .registry import register, rounded, with_views

G = "text"
TOP_K = 5
MAX_CTX, MAX_NEW_TOKENS, SAFETY_MARGIN = 512, 200, 32
PARA_SEP = "\n"  # the test documents hold single line breaks, never blank lines

# The same whitespace and line-break classes for DuckDB (RE2 reads the \x{..} escapes too).
WS_RE2 = T.WS
LB_RE2 = T.LINE_BREAK


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_RE2}+|{WS_RE2}+$', '', 'g')"


def lit_sql(s: str) -> str:
    """A Python string as a DuckDB expression (line breaks as chr(10))."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


def _docs(spark, d):
    return Tables(spark, d).documents


@register("paragraphs", G, f"""
SELECT doc_id, CAST(unnest(generate_series(0, len(ps) - 1)) AS INTEGER) AS para_id, unnest(ps) AS paragraph
FROM (SELECT doc_id,
             list_filter(list_transform(string_split(replace(text, chr(13), chr(10)), chr(10)),
                                        lambda x: {strip_sql('x')}), lambda x: x <> '') AS ps
      FROM documents) s
WHERE len(ps) > 0""")
def q_paragraphs(spark, d):
    return T.paragraphs(_docs(spark, d), sep=PARA_SEP)


@register("chunk_documents", G)
def q_chunk_documents(spark, d):
    """Greedy 800-character chunks of every document (checked against a plain loop in pytest)."""
    return T.chunk_documents(_docs(spark, d), max_chars=800, sep=PARA_SEP)


@register("l2_normalize", G, """
SELECT vec_id, list_transform(embedding,
         lambda x: floor(CAST(x AS DOUBLE) / (sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) + 1e-12) * 1e9 + 0.5) / 1e9)
       AS embedding_unit
FROM embeddings""")
def q_l2_normalize(spark, d):
    return T.normalize_vectors(Tables(spark, d).embeddings, "embedding").select("vec_id", "embedding_unit")


def _topk(spark, d):
    emb = Tables(spark, d).embeddings
    queries = T.label_centroids(emb, "label", "embedding").select(
        F.col("label").alias("query_id"), F.col("centroid").alias("query_vec"))
    return rounded(T.cosine_topk(emb, queries, k=TOP_K), "similarity")


_TOPK_SQL = f"""
cen AS (
  SELECT label, pos, AVG(CAST(x AS DOUBLE)) AS m
  FROM (SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings) e
  GROUP BY label, pos),
q AS (SELECT label AS query_id, list(m ORDER BY pos) AS qv FROM cen GROUP BY label),
qn AS (SELECT query_id, list_transform(qv, lambda x: x / (sqrt(list_sum(list_transform(qv, lambda y: y * y))) + 1e-12)) AS qv
       FROM q),
cn AS (SELECT vec_id, list_transform(embedding,
               lambda x: CAST(x AS DOUBLE) / (sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) + 1e-12)) AS cv
       FROM embeddings),
sims AS (SELECT qn.query_id, cn.vec_id, list_dot_product(cn.cv, qn.qv) AS sim FROM cn CROSS JOIN qn),
topk AS (SELECT * FROM (
  SELECT query_id, vec_id, floor(sim * 1e6 + 0.5) / 1e6 AS similarity,
         row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM sims) r
  WHERE rank <= {TOP_K})"""


@register("cosine_topk", G, f"WITH {_TOPK_SQL}\nSELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM topk")
def q_cosine_topk(spark, d):
    return _topk(spark, d).withColumn("rank", F.col("rank").cast("int"))


def _contexts(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("vec_id"), F.col("text").alias("context"))
    return _topk(spark, d).join(docs, "vec_id")


def _prompts(spark, d):
    questions = Tables(spark, d).benchmark.select(
        F.col("item_id").cast("int").alias("query_id"), F.col("text").alias("question"))
    return T.assemble_prompts(_contexts(spark, d), questions)


_PROMPT_SQL = f"""{_TOPK_SQL},
ctx AS (SELECT t.query_id, string_agg(d.text, {lit_sql(T.CONTEXT_SEP)} ORDER BY t.rank) AS context
        FROM topk t JOIN documents d ON d.doc_id = t.vec_id GROUP BY t.query_id),
prompts AS (
  SELECT ctx.query_id,
         {lit_sql(T.SYSTEM_MSG + chr(10) + chr(10) + "Context:" + chr(10))} || ctx.context
         || {lit_sql(chr(10) + chr(10) + "Question: ")} || b.text
         || {lit_sql(chr(10) + "Answer in 2-5 sentences:" + chr(10))} AS prompt
  FROM ctx JOIN benchmark b ON b.item_id = ctx.query_id)"""


@register("assemble_prompt", G, f"WITH {_PROMPT_SQL}\nSELECT query_id, prompt FROM prompts")
def q_assemble_prompt(spark, d):
    return _prompts(spark, d)


_ALLOWED = max(MAX_CTX - MAX_NEW_TOKENS - SAFETY_MARGIN, 128)


@register("truncate_tail", G, f"""WITH {_PROMPT_SQL},
tk AS (SELECT query_id, prompt, regexp_extract_all(prompt, '{T.TOKEN}') AS toks FROM prompts)
SELECT query_id, CASE WHEN len(toks) > {_ALLOWED}
                      THEN array_to_string(list_slice(toks, len(toks) - {_ALLOWED} + 1, len(toks)), '')
                      ELSE prompt END AS prompt_tail
FROM tk""")
def q_truncate_tail(spark, d):
    p = _prompts(spark, d)
    return p.select("query_id", T.truncate_tail("prompt", MAX_CTX, MAX_NEW_TOKENS, SAFETY_MARGIN)
                    .alias("prompt_tail"))


@register("context_preview", G, f"""WITH {_TOPK_SQL}
SELECT t.query_id, CAST(t.rank AS INTEGER) AS rank, t.similarity,
       replace(substr(d.text, 1, 400), chr(10), ' ') || CASE WHEN length(d.text) > 400 THEN '...' ELSE '' END AS preview,
       printf('%.3f', floor(t.similarity * 1000 + 0.5) / 1000) AS score_text
FROM topk t JOIN documents d ON d.doc_id = t.vec_id""")
def q_context_preview(spark, d):
    c = _contexts(spark, d)
    out = T.context_preview(c, "context", "similarity")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "similarity", "preview",
                      "score_text")


@register("clean_answers", G, with_views(["generations"], f"""
WITH a AS (SELECT conv_id, turn, {strip_sql('generation')} AS t FROM generations),
b AS (SELECT conv_id, turn,
             CASE WHEN strpos(t, 'Answer:') > 0
                  THEN COALESCE(NULLIF({strip_sql("substr(t, strpos(t, 'Answer:') + 7)")}, ''), t)
                  ELSE t END AS t
      FROM a),
c AS (SELECT conv_id, turn,
             list_filter(list_transform(regexp_split_to_array(t, '{LB_RE2}'), lambda l: {strip_sql('l')}),
                         lambda l: l <> '') AS lines
      FROM b),
d AS (SELECT conv_id, turn,
             {strip_sql("array_to_string(list_filter(lines, lambda l, i: list_position(list_transform(lines, lambda z: lower(z)), lower(l)) = i), ' ')")}
               AS joined
      FROM c)
SELECT conv_id, turn,
       CASE WHEN length(joined) < 10 THEN {lit_sql(T.FALLBACK_ANSWER)} ELSE joined END AS answer
FROM d"""))
def q_clean_answers(spark, d):
    g = RetailModel(spark, d).generations
    return g.select("conv_id", "turn", T.clean_answer("generation").alias("answer"))


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_MCQ_SQL = f"""
blk AS (SELECT question_id, {strip_sql('raw')} AS t FROM mcq_raw),
ext AS (SELECT question_id,
               regexp_extract(t, {_q(T.MCQ_QUESTION)}, 1) AS q,
               """ + ",\n               ".join(
    f"regexp_extract(t, {_q(T.MCQ_OPTION.format(label=l))}, 1) AS o{l}" for l in T.OPTION_LABELS) + f""",
               regexp_extract(t, {_q(T.MCQ_ANSWER)}, 1) AS ans
        FROM blk),
mcq AS (SELECT question_id, {strip_sql('q')} AS question,
               [""" + ", ".join(strip_sql(f"o{l}") for l in T.OPTION_LABELS) + f"""] AS options,
               upper(ans) AS answer,
               CASE WHEN q = '' THEN {_q(T.MCQ_MISSING_QUESTION)}
                    """ + "\n                    ".join(
    f"WHEN o{l} = '' THEN {_q(T.MCQ_MISSING_OPTION.format(label=l))}" for l in T.OPTION_LABELS) + f"""
                    WHEN ans = '' THEN {_q(T.MCQ_MISSING_ANSWER)} END AS reason
        FROM ext)"""


def _mcq(spark, d):
    return T.parse_mcq(RetailModel(spark, d).mcq_raw).drop("raw")


@register("parse_mcq", G, with_views(["mcq_raw"], f"""WITH {_MCQ_SQL}
SELECT question_id, question, options, answer, reason, reason IS NULL AS is_valid FROM mcq"""))
def q_parse_mcq(spark, d):
    return _mcq(spark, d)


@register("score_quiz", G, with_views(["mcq_raw", "attempts"], f"""WITH {_MCQ_SQL}
SELECT a.user_id, COUNT(*) AS total, CAST(SUM(CASE WHEN a.choice = m.answer THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       CAST(COUNT(*) - SUM(CASE WHEN a.choice = m.answer THEN 1 ELSE 0 END) AS BIGINT) AS incorrect
FROM attempts a JOIN mcq m ON m.question_id = a.question_id
WHERE m.reason IS NULL GROUP BY a.user_id"""))
def q_score_quiz(spark, d):
    return T.score_quiz(RetailModel(spark, d).attempts, _mcq(spark, d))


@register("attempt_breakdown", G, with_views(["mcq_raw", "attempts"], f"""WITH {_MCQ_SQL}
SELECT a.user_id, a.question_id, ['A', 'B', 'C', 'D'][i] AS option_label, m.options[i] AS option_text,
       CASE WHEN ['A', 'B', 'C', 'D'][i] = m.answer THEN 'correct'
            WHEN ['A', 'B', 'C', 'D'][i] = a.choice THEN 'your choice' ELSE 'other' END AS status
FROM attempts a JOIN mcq m ON m.question_id = a.question_id
CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS i) k
WHERE m.reason IS NULL"""))
def q_attempt_breakdown(spark, d):
    return T.attempt_breakdown(RetailModel(spark, d).attempts, _mcq(spark, d))
