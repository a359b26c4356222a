"""Exact ranks, row numbers and prefix sums without sorting a whole group in one task.

``Window.partitionBy(g).orderBy(v)`` sends every row of a group to one task.  Here all groups
are range-partitioned together by (group, order, input position) and sorted inside their
partitions, so a hot group, and equal rows in it, spread over many partitions.  That is the
only exchange of the rows: a row's place is its number inside its partition (or the running
weight there), less that of the group's first row in the partition, plus the group's total in
earlier partitions.  These totals are one row per (group, partition) that meet; they are a table of
their own, so the planner knows their size and broadcasts them only while they are small.
The number of partitions follows ``spark.sql.shuffle.partitions``, which is sized to the
data.  There is one plan for every size.

The sorted rows are written once, because partition numbers must not change between their
two uses.  NULLs sort first and are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def _null_safe_on(left: DataFrame, right: DataFrame, cols):
    cond = None
    for c in cols:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _running(df: DataFrame, weight: str) -> DataFrame:
    """Adds ``_upto``: the sum of ``weight`` over the earlier rows of the same partition."""
    at = df.columns.index(weight)

    def run(batches):
        total = 0
        for b in batches:
            w = b.column(at).fill_null(0).to_numpy(zero_copy_only=False)
            sums = np.cumsum(w) + total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums - w)], [*b.schema.names, "_upto"])
            total = int(sums[-1]) if len(sums) else total

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_upto", T.LongType())]))


def prefix_sums(df: DataFrame, group_cols, order_cols, weight: str | None = None,
                before_col: str = "_before", total_col: str = "group_n") -> DataFrame:
    """Adds the sum of ``weight`` (default 1 a row) over the rows of the same group that come
    earlier in ``order_cols`` (input order among equals), and the sum over the whole group."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    keys = [*group_cols, *order_cols, "_at"]
    ranged = df.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at")
    if weight is None:  # the low 33 bits are the number of the row inside its partition
        placed = ranged.withColumn("_upto", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        own = F.count(F.lit(1))
    else:
        placed = _running(ranged.withColumn("_w", F.col(weight).cast("long")), "_w").drop("_w")
        own = F.coalesce(F.sum(F.col(weight).cast("long")), F.lit(0))
    placed = _stored(placed.withColumn("_part", F.spark_partition_id()), "placed")
    per = placed.groupBy(*group_cols, "_part").agg(F.min("_upto").alias("_first"), own.alias("_n"))
    group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    parts = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(*group_cols, "_part", (F.coalesce(F.sum("_n").over(parts), F.lit(0)) - F.col("_first")).alias("_start"),
                        F.sum("_n").over(group).alias(total_col))
    i, s = placed.alias("_i"), _stored(starts, "starts").alias("_s")
    return i.join(s, _null_safe_on(i, s, [*group_cols, "_part"])).select(
        *[i[c] for c in df.columns], (s["_start"] + i["_upto"]).alias(before_col), s[total_col])


def value_ranks(df: DataFrame, group_cols, order_col: str) -> DataFrame:
    """One row per distinct (group, value): ``rank`` (SQL RANK, ascending, NULL first),
    ``group_n`` and ``value_count``.  Equal values are one row before anything is sorted."""
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, order_col).agg(F.count(F.lit(1)).alias("value_count"))
    ranked = prefix_sums(counts, group_cols, [order_col], "value_count")
    return ranked.select(*group_cols, order_col, (F.col("_before") + 1).alias("rank"), "group_n", "value_count")


def with_percent_rank(df: DataFrame, group_cols, order_col: str, out_col: str = "pr") -> DataFrame:
    """Adds SQL ``PERCENT_RANK() OVER (PARTITION BY group ORDER BY order_col)``."""
    group_cols = list(group_cols)
    ranks = value_ranks(df, group_cols, order_col)
    pr = F.when(F.col("group_n") <= 1, F.lit(0.0)).otherwise(
        (F.col("rank") - 1).cast("double") / (F.col("group_n") - 1).cast("double"))
    a = df.alias("_l")
    r = ranks.select(*group_cols, order_col, pr.alias(out_col)).alias("_r")
    return a.join(r, _null_safe_on(a, r, [*group_cols, order_col]), "inner").select("_l.*", r[out_col])


def row_numbers(df: DataFrame, group_cols, order_col: str, tiebreak_col: str,
                out_col: str = "rn") -> DataFrame:
    """SQL ``ROW_NUMBER() OVER (PARTITION BY group ORDER BY order_col, tiebreak_col)`` plus
    ``group_n``."""
    order = [order_col] if tiebreak_col == order_col else [order_col, tiebreak_col]
    out = prefix_sums(df, group_cols, order, before_col="_rows_before")
    return out.withColumn(out_col, F.col("_rows_before") + 1).drop("_rows_before").select(
        *df.columns, out_col, "group_n")
