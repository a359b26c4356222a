"""Keys for feature preparation, splits and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import argmax
from ..operators import evaluate as E
from ..operators import metrics as M
from ..operators import prep as P
from ..sources.retail_model import RetailModel
from ..sources.tables import Tables
from .registry import r2_sql, register, rounded, with_views

G = "prep"
LANGS = ("de", "en", "es", "fr")


def _docs(spark, d):
    return RetailModel(spark, d).doc_frame


@register("fill_constant", G, with_views(["doc_frame"], """
SELECT doc_id, COALESCE(quality_tag, 'None') AS quality_tag FROM doc_frame"""))
def q_fill_constant(spark, d):
    return P.fill_constant(_docs(spark, d), "None", ["quality_tag"]).select("doc_id", "quality_tag")


@register("fill_median", G, with_views(["doc_frame"], """
WITH med AS (SELECT QUANTILE_CONT(quality, 0.5) AS mq, QUANTILE_CONT(toxic, 0.5) AS mt,
                    QUANTILE_CONT(n_chars, 0.5) AS mn FROM doc_frame)
SELECT doc_id, COALESCE(CAST(quality AS DOUBLE), mq) AS quality, COALESCE(CAST(toxic AS DOUBLE), mt) AS toxic,
       COALESCE(CAST(n_chars AS DOUBLE), mn) AS n_chars
FROM doc_frame CROSS JOIN med"""))
def q_fill_median(spark, d):
    df = _docs(spark, d)
    cols = ["quality", "toxic", "n_chars"]
    med = M.median_of(df, cols)  # statistics of the learning frame
    return P.fill_from_stats(df, med, cols).select("doc_id", *cols)


@register("fill_median_second", G, with_views(["doc_frame"], """
WITH med AS (SELECT QUANTILE_CONT(quality, 0.5) AS mq, QUANTILE_CONT(toxic, 0.5) AS mt,
                    QUANTILE_CONT(n_chars, 0.5) AS mn FROM doc_frame WHERE doc_id % 3 > 0)
SELECT doc_id, COALESCE(CAST(quality AS DOUBLE), mq) AS quality, COALESCE(CAST(toxic AS DOUBLE), mt) AS toxic,
       COALESCE(CAST(n_chars AS DOUBLE), mn) AS n_chars
FROM doc_frame CROSS JOIN med WHERE doc_id % 3 = 0"""))
def q_fill_median_second(spark, d):
    """The medians of one part of the documents (two of three) fill the other part."""
    df = _docs(spark, d)
    cols = ["quality", "toxic", "n_chars"]
    med = M.median_of(df.where("doc_id % 3 > 0"), cols)
    return P.fill_from_stats(df.where("doc_id % 3 = 0"), med, cols).select("doc_id", *cols)


@register("conditional_reset", G, with_views(["doc_frame"], """
SELECT doc_id, CASE WHEN toxic = 0 THEN 0 ELSE quality END AS quality, toxic,
       CASE WHEN toxic = 0 THEN 'None' ELSE quality_tag END AS quality_tag
FROM doc_frame"""))
def q_conditional_reset(spark, d):
    df = _docs(spark, d)
    out = P.conditional_reset(df, F.col("toxic") == 0, {"quality": 0, "quality_tag": "None"})
    return out.select("doc_id", "quality", "toxic", "quality_tag")


@register("label_binarize", G, with_views(["answers"], """
SELECT doc_id, CAST(lower(trim(answer)) = 'yes' AS INTEGER) AS label FROM answers"""))
def q_label_binarize(spark, d):
    a = RetailModel(spark, d).answers
    return a.select("doc_id", P.label_binarize("answer").alias("label"))


@register("one_hot", G, with_views(["doc_frame"], "SELECT doc_id, " + ", ".join(
    f"CAST(lang = '{v}' AS INTEGER) AS lang_{v}" for v in LANGS) + " FROM doc_frame"))
def q_one_hot(spark, d):
    return P.one_hot(_docs(spark, d).select("doc_id", "lang"), ["lang"])


@register("one_hot_vector", G, with_views(["doc_frame"], """
SELECT doc_id, DENSE_RANK() OVER (ORDER BY doc_id) - 1 AS hot, (SELECT COUNT(DISTINCT doc_id) FROM doc_frame) AS size,
       CAST(1.0 AS DOUBLE) AS value
FROM doc_frame"""))
def q_one_hot_vector(spark, d):
    """Sparse one-hot vectors of a column with as many levels as documents."""
    x = P.one_hot_vector(_docs(spark, d).select("doc_id"), "doc_id", "v")
    parts = F.from_json(F.to_json(F.struct("v")), "v struct<size long, indices array<long>, values array<double>>")["v"]
    return x.select("doc_id", parts["indices"][0].alias("hot"), parts["size"].alias("size"), parts["values"][0].alias("value"))


@register("align_columns", G, with_views(["doc_frame"], "SELECT doc_id, " + ", ".join(
    f"CAST(lang = '{v}' AS INTEGER) AS lang_{v}" for v in LANGS) + """, 0 AS lang_eo, 0 AS lang_la FROM doc_frame"""))
def q_align_columns(spark, d):
    """All documents, encoded by their own levels and with an extra column, aligned to a
    frame with two more levels, which are filled with 0."""
    docs = _docs(spark, d).select("doc_id", "lang", "source")
    wide = P.one_hot(docs.select("doc_id", "lang"), ["lang"], levels={"lang": [*LANGS, "eo", "la"]})
    return P.align_columns(P.one_hot(docs, ["lang"]), wide.columns, fill=0)


@register("label_encode", G, with_views(["doc_frame"], """
SELECT doc_id, lang, CAST(DENSE_RANK() OVER (ORDER BY lang) - 1 AS DOUBLE) AS lang_index FROM doc_frame"""))
def q_label_encode(spark, d):
    return P.label_encode(_docs(spark, d).select("doc_id", "lang"), "lang")


@register("class_weights", G, """
WITH c AS (SELECT label, COUNT(*) AS n_c FROM embeddings GROUP BY label)
SELECT label, n_c, CAST((SELECT SUM(n_c) FROM c) AS DOUBLE) / CAST((SELECT COUNT(*) FROM c) * n_c AS DOUBLE) AS weight
FROM c""")
def q_class_weights(spark, d):
    return P.class_weights(Tables(spark, d).embeddings, "label")


@register("stratified_split", G, """
WITH c AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label)
SELECT label, true AS is_train, CAST(floor(n * 0.7 + 0.5) AS BIGINT) AS n_rows FROM c
UNION ALL
SELECT label, false AS is_train, CAST(n - floor(n * 0.7 + 0.5) AS BIGINT) AS n_rows FROM c""")
def q_stratified_split(spark, d):
    s = P.stratified_split(Tables(spark, d).embeddings, "label", "vec_id", 0.7, seed=42)
    return s.groupBy("label", "is_train").agg(F.count(F.lit(1)).alias("n_rows"))


@register("per_class_split", G, """
WITH c AS (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label)
SELECT label, true AS is_train, CAST(floor(n * 0.8) AS BIGINT) AS n_rows FROM c
UNION ALL
SELECT label, false AS is_train, CAST(n - floor(n * 0.8) AS BIGINT) AS n_rows FROM c""")
def q_per_class_split(spark, d):
    s = P.per_class_split(Tables(spark, d).embeddings, "label", "vec_id", 0.8, seed=42)
    return s.groupBy("label", "is_train").agg(F.count(F.lit(1)).alias("n_rows"))


@register("random_split", G)
def q_random_split(spark, d):
    """Split membership comes from a seeded hash (no SQL twin); rows-only check."""
    lines = Tables(spark, d).lineitem
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = P.random_split(lines.withColumn("row_id", row_id), "row_id", 0.8, seed=42)
    return s.groupBy("is_train").agg(F.count(F.lit(1)).alias("n_rows"))


@register("merge_dimension", G, """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_brand, p.p_size
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey""")
def q_merge_dimension(spark, d):
    t = Tables(spark, d)
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
            .join(dim, "l_partkey", "left"))


@register("date_parts", G, """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS Year, CAST(month(o_orderdate) AS INTEGER) AS Month,
       CAST(day(o_orderdate) AS INTEGER) AS Day
FROM orders""")
def q_date_parts(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return P.add_date_parts(o, "o_orderdate").drop("o_orderdate")


# ---- evaluation ----

@register("accuracy", G, with_views(["binary_predictions"], """
SELECT CAST(SUM(CASE WHEN y = p THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS accuracy, COUNT(*) AS n
FROM binary_predictions"""))
def q_accuracy(spark, d):
    return E.accuracy(RetailModel(spark, d).binary_predictions, "y", "p")


def _multi(spark, d):
    """Predicted class: the place of the largest component of the whole vector."""
    emb = Tables(spark, d).embeddings
    return emb.select("vec_id", F.col("label").alias("y"), argmax("embedding").alias("p"))


_MULTI_SQL = """
mp AS (SELECT vec_id, label AS y, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS p
       FROM embeddings)"""
PLACES = 64


@register("confusion_matrix", G, f"""WITH {_MULTI_SQL}
SELECT y AS actual, """ + ", ".join(
    f'CAST(SUM(CASE WHEN p = {k} THEN 1 ELSE 0 END) AS BIGINT) AS "{k}"' for k in range(PLACES))
    + " FROM mp GROUP BY y")
def q_confusion_matrix(spark, d):
    return E.confusion_matrix(_multi(spark, d), "y", "p", list(range(PLACES)))


@register("classification_report", G, f"""WITH {_MULTI_SQL},
pc AS (SELECT y AS actual, p AS predicted, COUNT(*) AS n FROM mp GROUP BY 1, 2),
cls AS (SELECT actual AS cls FROM pc UNION SELECT predicted FROM pc),
per AS (
  SELECT c.cls,
         COALESCE((SELECT SUM(n) FROM pc WHERE actual = c.cls AND predicted = c.cls), 0) AS tp,
         COALESCE((SELECT SUM(n) FROM pc WHERE actual = c.cls), 0) AS support,
         COALESCE((SELECT SUM(n) FROM pc WHERE predicted = c.cls), 0) AS n_pred
  FROM cls c),
pr AS (
  SELECT cls, tp, support,
         CASE WHEN n_pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(n_pred AS DOUBLE) END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) END AS recall
  FROM per),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                     ELSE 2.0 * precision * recall / (precision + recall) END AS f1 FROM pr),
rep AS (
  SELECT CAST(cls AS VARCHAR) AS label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM f
  UNION ALL
  SELECT 'accuracy', NULL, NULL, CAST(SUM(tp) AS DOUBLE) / SUM(support), CAST(SUM(support) AS BIGINT) FROM f
  UNION ALL
  SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), CAST(SUM(support) AS BIGINT) FROM f
  UNION ALL
  SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
         SUM(f1 * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM f)
SELECT label, {r2_sql('precision', 6)} AS precision, {r2_sql('recall', 6)} AS recall,
       {r2_sql('f1', 6)} AS f1, support FROM rep""")
def q_classification_report(spark, d):
    return rounded(E.classification_report(_multi(spark, d), "y", "p"), "precision", "recall", "f1")


@register("regression_metrics", G, with_views(["series"], f"""
WITH f AS (
  SELECT value AS y, LAG(value) OVER (PARTITION BY series_id ORDER BY t) AS p FROM series),
g AS (SELECT CAST(y AS DECIMAL(18,2)) AS y, CAST(y AS DECIMAL(18,2)) - CAST(p AS DECIMAL(18,2)) AS e
      FROM f WHERE p IS NOT NULL),
s AS (SELECT SUM(abs(e)) AS sae, SUM(e * e) AS sse, SUM(y) AS sy, COUNT(*) AS n FROM g),
m AS (SELECT CAST(sy AS DOUBLE) / n AS mean FROM s),
t AS (SELECT SUM(pow(CAST(y AS DOUBLE) - m.mean, 2)) AS sst FROM g CROSS JOIN m)
SELECT {r2_sql('CAST(sae AS DOUBLE) / n', 6)} AS mae, {r2_sql('CAST(sse AS DOUBLE) / n', 6)} AS mse,
       {r2_sql('1.0 - CAST(sse AS DOUBLE) / sst', 6)} AS r2, n
FROM s CROSS JOIN t"""))
def q_regression_metrics(spark, d):
    """Naive "repeat the last value" forecast of each daily series, scored against the truth."""
    from pyspark.sql import Window

    s = RetailModel(spark, d).series
    w = Window.partitionBy("series_id").orderBy("t")
    f = s.withColumn("p", F.lag("value").over(w)).filter(F.col("p").isNotNull())
    return rounded(E.regression_metrics(f, "value", "p", decimals=2), "mae", "mse", "r2")
