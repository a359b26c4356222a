"""File sources and sinks (S1, S2, S5-S8, S14): CSV and JSON with explicit schemas,
metric histories, class-per-directory scans, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             date_format: str | None = None, timestamp_format: str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a header.  Give ``schema`` (no inference pass over the data); date
    columns in the schema are parsed with ``date_format``."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    if date_format:
        r = r.option("dateFormat", date_format)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", date_format: str = "yyyy-MM-dd") -> str:
    """CSV with a header line (one file per partition)."""
    df.write.mode(mode).option("header", True).option("dateFormat", date_format).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines."""
    df.write.mode(mode).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


HISTORY_SCHEMA = "epoch int, train_loss double, val_loss double, train_acc double, val_acc double"


def save_history(history: DataFrame, out_dir: str) -> tuple[str, str]:
    """Metric history as JSON and CSV with the fixed column set (missing values NULL)."""
    cols = [f.name for f in T._parse_datatype_string(HISTORY_SCHEMA).fields]
    full = history.select(*[F.col(c) if c in history.columns else F.lit(None).alias(c) for c in cols])
    full = full.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                         for f in T._parse_datatype_string(HISTORY_SCHEMA).fields])
    j = write_json(full.coalesce(1), f"{out_dir}/train_history_json")
    c = write_csv(full.coalesce(1), f"{out_dir}/train_history_csv")
    return j, c


def scan_class_dirs(spark: SparkSession, root: str, exts=("*.txt",), class_pattern: str = r"/([^/=]+=)?([^/]+)/[^/]+$",
                    class_group: int = 2) -> DataFrame:
    """Files below ``root`` whose name matches one of ``exts``; the class is the name of
    the file's directory.  File contents are not read (only path and length)."""
    frames = []
    for ext in exts:
        frames.append(spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                      .option("pathGlobFilter", ext).load(root).select("path", "length"))
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    return df.withColumn("class", F.regexp_extract("path", class_pattern, class_group))


def sorted_files(files: DataFrame, n: int = 16) -> DataFrame:
    """The first ``n`` files in path order."""
    return files.orderBy("path").limit(n)


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows in a stated order (give a unique tie-breaker last)."""
    return df.orderBy(*order).limit(n)
