"""Ordered series: sliding windows, last window, naive forecasts, ordered split, z-scores,
early stopping (W5-W9, M6, M7).

A series is rows (series key..., order column, value).  Row positions inside a series come
from ``ranking.row_numbers`` (no task ever holds a whole series), and windows are built by
sending each value to the ``k`` later positions that use it, then grouping by target
position: every group has exactly ``k`` rows, whatever the length of the series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import row_numbers


def positions(df: DataFrame, series_cols, order_col: str, out_col: str = "pos") -> DataFrame:
    """1-based position of each row in its series (``group_n`` = series length)."""
    return row_numbers(df, series_cols, order_col, order_col, out_col=out_col)


def sliding_windows(df: DataFrame, series_cols, order_col: str, value_col: str,
                    k: int) -> DataFrame:
    """For each row with ``k`` earlier rows: the ``k`` previous values (oldest first)
    as ``features`` and the row's own value as ``target``."""
    series_cols = list(series_cols)
    p = positions(df, series_cols, order_col)
    # value at position q feeds targets q+1 .. q+k, at slot k - j (0-based, oldest first)
    sent = p.select(*series_cols, "pos", value_col,
                    F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_j"))
    sent = sent.select(*series_cols, (F.col("pos") + F.col("_j")).alias("_target_pos"),
                       (F.lit(k) - F.col("_j")).alias("_slot"), F.col(value_col).alias("_v"))
    windows = (sent.groupBy(*series_cols, "_target_pos")
               .agg(F.sort_array(F.collect_list(F.struct("_slot", "_v"))).alias("_w"))
               .filter(F.size("_w") == k)
               .select(*series_cols, F.col("_target_pos").alias("pos"),
                       F.transform("_w", lambda s: s["_v"]).alias("features")))
    return (p.join(windows, series_cols + ["pos"])
            .select(*series_cols, order_col, "features", F.col(value_col).alias("target")))


def last_window(df: DataFrame, series_cols, order_col: str, value_col: str, k: int) -> DataFrame:
    """The last ``k`` values of each series (oldest first); shorter series give all."""
    series_cols = list(series_cols)
    # Spark limits each task to k rows of a series before the shuffle (window group limit).
    latest = Window.partitionBy(*series_cols).orderBy(F.desc(order_col))
    tail = df.withColumn("_back", F.row_number().over(latest)).where(F.col("_back") <= k)
    return (tail.groupBy(*series_cols)
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("_at"), value_col))).alias("_w"))
            .select(*series_cols, F.transform("_w", lambda s: s[value_col]).alias("last_values")))


def naive_forecast(df: DataFrame, series_cols, order_col: str, value_col: str) -> DataFrame:
    """Per series the last value, the last difference, and the two naive forecasts
    (repeat the last value; last value plus last difference)."""
    series_cols = list(series_cols)
    v = F.col(value_col)
    last_two = (df.groupBy(*series_cols)
                .agg(F.max_by(F.struct(order_col, value_col), F.col(order_col)).alias("_last"),
                     F.max(order_col).alias("_tmax")))
    prev = (df.join(last_two.select(*series_cols, "_tmax"), series_cols)
            .filter(F.col(order_col) < F.col("_tmax"))
            .groupBy(*series_cols).agg(F.max_by(v, F.col(order_col)).alias("_prev")))
    j = last_two.join(prev, series_cols, "left")
    last = F.col("_last")[value_col]
    diff = last - F.col("_prev")
    return j.select(*series_cols, last.alias("last_value"), diff.alias("last_diff"),
                    last.alias("forecast_repeat_last"), (last + diff).alias("forecast_add_last_diff"))


def ordered_split(df: DataFrame, series_cols, order_col: str, share: float = 0.8) -> DataFrame:
    """The first ``max(1, floor(share x n))`` rows of each series are learning rows."""
    p = positions(df, list(series_cols), order_col)
    n_train = F.greatest(F.lit(1), F.floor(F.col("group_n") * F.lit(float(share))))
    return p.withColumn("is_train", F.col("pos") <= n_train)


def zscore_stats(train: DataFrame, series_cols, value_col: str, eps: float = 1e-8) -> DataFrame:
    """M6: mean and population std (+ eps) of the learning rows per series."""
    return train.groupBy(*series_cols).agg(
        F.avg(value_col).alias("mean"),
        (F.stddev_pop(value_col) + F.lit(eps)).alias("std"))


def zscore(df: DataFrame, stats: DataFrame, series_cols, value_col: str,
           out_col: str = "z") -> DataFrame:
    """(v - mean) / std with statistics from the learning part only."""
    return df.join(stats, list(series_cols)).withColumn(
        out_col, (F.col(value_col) - F.col("mean")) / F.col("std"))


def zscore_inverse(df: DataFrame, z_col: str = "z", out_col: str = "restored") -> DataFrame:
    """M7: z x std + mean (predictions back to the original scale)."""
    return df.withColumn(out_col, F.col(z_col) * F.col("std") + F.col("mean"))


def early_stop(df: DataFrame, series_cols, order_col: str, metric_col: str,
               patience: int = 3, start_best: float = 0.0) -> DataFrame:
    """Best-so-far, improvement flag and patience counter over epochs.

    An epoch improves when its metric is strictly above every earlier one (and above
    ``start_best``); the counter is the number of epochs since the last improvement; the
    stop epoch is the first whose counter reaches ``patience``.  Epoch histories are short,
    so the windows run per series.
    """
    series_cols = list(series_cols)
    w = Window.partitionBy(*series_cols).orderBy(order_col)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.greatest(F.coalesce(F.max(metric_col).over(before), F.lit(start_best)),
                             F.lit(start_best))
    x = df.withColumn("best_before", best_before).withColumn(
        "improved", F.col(metric_col) > F.col("best_before"))
    x = x.withColumn("_grp", F.sum(F.col("improved").cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    wg = Window.partitionBy(*series_cols, "_grp").orderBy(order_col)
    x = x.withColumn("no_improve", F.sum((~F.col("improved")).cast("int")).over(
        wg.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("best_so_far", F.greatest(F.col("best_before"), F.col(metric_col)))
    first_stop = F.min(F.when(F.col("no_improve") >= patience, F.col(order_col))).over(
        Window.partitionBy(*series_cols))
    return (x.withColumn("stop_here", F.coalesce(F.col(order_col) == first_stop, F.lit(False)))
            .withColumn("after_stop", F.coalesce(F.col(order_col) > first_stop, F.lit(False)))
            .drop("_grp"))
