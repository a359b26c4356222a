"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers and the checkpoint folder known."""
    ensure_checkpoint_dir(spark)
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Unlike a checkpoint the planner then knows the table's size, so a join with it is
    broadcast only when the written files are below the broadcast threshold.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = name
    while out.lower() in taken:
        out += "_"
    return out


def extended(df: DataFrame, **types: str) -> T.StructType:
    """The schema of ``df`` with more columns, as DDL types by name."""
    more = [T.StructField(n, T.DataType.fromDDL(t)) for n, t in types.items()]
    return T.StructType([*df.schema.fields, *more])


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return np.zeros(1, np.int64), data[:0]
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def small_batches(batches, max_bytes: int = 2 << 20, column: str = "text"):
    """The same rows in batches of about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = utf8_parts(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def sorted_groups(batches, keys: int):
    """Batches of the rows with equal values in the first ``keys`` (integer) columns, of rows
    that arrive sorted by these."""
    held = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        values = np.stack([held.column(i).to_numpy() for i in range(keys)])
        starts = np.append(0, np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1)
        for a, b in zip(starts, starts[1:]):
            yield held.slice(a, b - a)
        held = held.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def unsigned_crc32(c) -> F.Column:
    """CRC-32 of the UTF-8 text as an unsigned LONG; null counts as empty."""
    return F.crc32(F.coalesce(c, F.lit("")).cast("binary")).cast("long")
