"""Jump consistent hashing: stable keys to shards without a ring table.

The key of a row is 60 bits of the MD5 of its id's text; the shard follows from key and
shard count alone (Lamping and Veach's jump function, vectorised in NumPy).  Appending a
shard moves a row only if it goes to the new shard, about 1 / (n + 1) of the rows.

Slots number the rows of each shard 0, 1, 2, ... by (id, size, checksum).  No shard is sorted
in one task: rows are range-partitioned over all shards at once, numbered inside their
partition, and the rows of earlier partitions are added from a table with one row per
(shard, partition) pair.  Rows that compare equal are spread by their input position.

Null ids hash as the word 'null'; null text counts as empty (16 bytes).  Repeated rows share
a shard and get slots of their own.  An empty table gives an empty table.  Only the id and
text columns are read by ``assign``; ``write_shards`` keeps all columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, extended, fresh, prepare, unsigned_crc32

OVERHEAD_BYTES = 16
_FACTOR = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard in 0..shards-1 of each unsigned 64-bit key."""
    key = keys.astype(np.uint64)
    last = np.full(len(key), -1, np.int64)
    ahead = np.zeros(len(key), np.int64)
    moving = ahead < shards
    while moving.any():
        last[moving] = ahead[moving]
        key[moving] = key[moving] * _FACTOR + np.uint64(1)
        step = float(1 << 31) / ((key[moving] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[moving] = ((last[moving] + 1) * step).astype(np.int64)
        moving = ahead < shards
    return last


def shard_of(id_col, shards: int):
    """Column expression: the shard of an id."""
    @F.pandas_udf("int")
    def run(key: pd.Series) -> pd.Series:
        return pd.Series(jump(key.to_numpy(np.int64), shards).astype(np.int32))

    text = F.coalesce(id_col.cast("string"), F.lit("null"))
    return run(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"))


def _number(batches):
    """Position of each row among its partition's rows of the same shard (rows come sorted)."""
    part, shard, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        s = batch.column(batch.schema.get_field_index("shard")).to_numpy()
        if not len(s):
            continue
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        run = np.diff(np.append(first, len(s)))
        rel = np.arange(len(s)) - np.repeat(first, run)
        if s[0] == shard:
            rel[:run[0]] += seen
        shard, seen = s[-1], int(rel[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(s), part, np.int32)), pa.array(rel)],
            [*batch.schema.names, "_part", "_rel"])


def assign(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law`` ('key'), ``shard``, ``slot``, ``grown_shard``."""
    prepare(df.sparkSession)
    i, t = F.col(id_col), F.col(text_col)
    thin = cut(df.select(
        id_col,
        (F.coalesce(F.octet_length(t), F.lit(0)) + OVERHEAD_BYTES).cast("long").alias("size"),
        unsigned_crc32(t).alias("text_crc32"),
        shard_of(i, shards).alias("shard"), shard_of(i, shards + 1).alias("grown_shard")))
    order = ["shard", id_col, "size", "text_crc32"]
    ranged = (thin.withColumn("_at", F.monotonically_increasing_id())
              .repartitionByRange(*order, "_at").sortWithinPartitions(*order).drop("_at"))
    numbered = cut(ranged.mapInArrow(_number, extended(ranged, _part="int", _rel="bigint")))
    counts = numbered.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per (shard, partition) that meet: at most partitions + shards rows.
    return numbered.join(F.broadcast(starts), ["shard", "_part"]).select(
        id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_rel")).alias("slot"), "grown_shard")


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id") -> None:
    """All rows as Parquet folders ``<shard column>=k``; a large shard is split over several files."""
    prepare(df.sparkSession)
    name = fresh(df, "shard")
    out = df.withColumn(name, shard_of(F.col(id_col), shards))
    out.hint("rebalance", name).write.partitionBy(name).parquet(path)

