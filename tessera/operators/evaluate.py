"""Evaluation of predictions (M23-M26, M28) as aggregations over (truth, prediction) rows.

Everything is reduced to the small (truth, prediction) count table first; the reports are
computed from that table, never from collected predictions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """Share of rows whose prediction equals the truth (one row)."""
    return df.agg((F.sum((F.col(y) == F.col(p)).cast("long")).cast("double")
                   / F.count(F.lit(1))).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def pair_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str, labels) -> DataFrame:
    """One row per actual label, one column per predicted label, zeros filled."""
    labels = list(labels)
    pc = pair_counts(df, y, p)
    grid = pc.groupBy("actual").pivot("predicted", labels).agg(F.sum("n"))
    return grid.fillna(0, subset=[str(v) for v in labels])


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted
    means.  Undefined ratios (no predictions / no support) count as 0.

    The (truth, prediction) count table has at most classes^2 rows and feeds every part of
    the report, so it is computed once and checkpointed: the predictions are read once.
    """
    from ..session import ensure_checkpoint_dir

    pc = pair_counts(df, y, p)
    ensure_checkpoint_dir(df.sparkSession)
    pc = pc.checkpoint(eager=True)
    tp = pc.filter(F.col("actual") == F.col("predicted")).select(
        F.col("actual").alias("cls"), F.col("n").alias("tp"))
    support = pc.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = pc.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("n_pred"))
    classes = support.select("cls").unionByName(predicted.select("cls")).distinct()
    per = (classes.join(tp, "cls", "left").join(support, "cls", "left")
           .join(predicted, "cls", "left")
           .fillna(0, subset=["tp", "support", "n_pred"]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    per = per.withColumn("f1", f1)
    rows = per.select(F.col("cls").cast("string").alias("label"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    total = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                    F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                    (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                    (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                    (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = reduce(DataFrame.unionByName, [
        total.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     (F.col("tp").cast("double") / F.col("n")).alias("f1"),
                     F.col("n").cast("long").alias("support")),
        total.select(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                     F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                     F.col("n").cast("long").alias("support")),
        total.select(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                     F.col("wr").alias("recall"), F.col("wf").alias("f1"),
                     F.col("n").cast("long").alias("support")),
    ])
    out = rows.unionByName(summary)
    return out.select("label", "precision", "recall", "f1", "support")


def regression_metrics(df: DataFrame, y: str, p: str, decimals: int | None = None) -> DataFrame:
    """M26 + M28: MAE, MSE and R2 = 1 - SS_res / SS_tot (one row).

    With ``decimals`` set (inputs with that many decimal places) the error sums are exact
    decimals, so MAE and MSE do not depend on the row order.  SS_tot is taken around the
    mean in a second pass (the mean is a one-row aggregate, broadcast).
    """
    yc, pc = F.col(y), F.col(p)
    if decimals is not None:
        yc, pc = yc.cast(f"decimal(18,{decimals})"), pc.cast(f"decimal(18,{decimals})")
    base = df.select(yc.alias("_y"), (yc - pc).alias("_e"))
    stats = base.agg(F.sum(F.abs("_e")).alias("_sae"), F.sum(F.col("_e") * F.col("_e")).alias("_sse"),
                     F.sum("_y").alias("_sy"), F.count(F.lit(1)).alias("n"))
    mean = stats.select((F.col("_sy").cast("double") / F.col("n")).alias("_mean"))
    sst = (base.crossJoin(F.broadcast(mean))
           .agg(F.sum(F.pow(F.col("_y").cast("double") - F.col("_mean"), 2)).alias("_sst")))
    sse = F.col("_sse").cast("double")
    return stats.crossJoin(sst).select(
        (F.col("_sae").cast("double") / F.col("n")).alias("mae"),
        (sse / F.col("n")).alias("mse"),
        (F.lit(1.0) - F.try_divide(sse, F.col("_sst"))).alias("r2"),
        "n")
