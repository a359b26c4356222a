"""Table layout jobs on Parquet (D1-D11): clustered, Z-ordered, partitioned and compacted
writes, identity ids, derived partition columns and partition-pruned reads.

All writes go to paths the caller names (the plans use folders below the session's shared
checkpoint directory).  Sizes are derived from the data, not collected rows.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .ranking import row_numbers


def cluster_write(df: DataFrame, path: str, keys=None, num_files: int | None = None,
                  mode: str = "overwrite", max_records_per_file: int | None = None) -> str:
    """Write ``df`` range-clustered by ``keys`` (sorted inside each file).

    ``keys=None`` writes without clustering (clustering dropped for later writes).  Without
    ``num_files`` the range shuffle uses the session's partition count and AQE merges small
    partitions.
    """
    out = df
    if keys:
        keys = list(keys)
        out = (df.repartitionByRange(num_files, *keys) if num_files else df.repartitionByRange(*keys))
        out = out.sortWithinPartitions(*keys)
    w = out.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def suggest_cluster_keys(filter_log: DataFrame, table: DataFrame, top_k: int = 3,
                         column_col: str = "column_name", exact: bool = False,
                         rsd: float = 0.01) -> DataFrame:
    """D3: rank candidate clustering columns by (times filtered) x (distinct values).

    ``filter_log`` has one row per logged filter with the filtered column's name.  Distinct
    counts come from one scan of ``table``: by default HyperLogLog sketches (one small state
    per column, no shuffle of values); ``exact=True`` counts exactly.
    """
    freq = filter_log.groupBy(column_col).agg(F.count(F.lit(1)).alias("filter_count"))
    cols = [c for c in table.columns]
    if not exact:
        wide = table.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in cols])
        ndv = wide.unpivot([], cols, column_col, "distinct_values")
    else:
        long_df = table.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias(column_col), F.col(c).cast("string").alias("v")) for c in cols]))
            .alias("_kv")).select("_kv.*")
        ndv = long_df.groupBy(column_col).agg(F.count_distinct("v").alias("distinct_values"))
    scored = freq.join(ndv, column_col).withColumn(
        "score", F.col("filter_count") * F.col("distinct_values"))
    w = Window.orderBy(F.desc("score"), column_col)  # one row per column: a small table
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)


def file_sizes(spark, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, length) of the data files below ``path`` (file contents are not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path).select("path", "length"))


def small_file_bins(spark, path: str, target_file_bytes: int, small_share: float = 0.75) -> DataFrame:
    """(folder, bin, files): the files below ``small_share`` of the target size, packed within
    each folder into bins of about the target size, in path order.  Bins of a single file are
    left out."""
    files = file_sizes(spark, path).where(F.col("length") < small_share * target_file_bytes)
    files = files.withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    earlier = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(earlier), F.lit(0)) / target_file_bytes))
    return files.groupBy("folder", "bin").agg(F.sort_array(F.collect_list("path")).alias("files")).where(F.size("files") > 1)


def compact_files(spark, path: str, target_file_bytes: int = 128 * 1024 * 1024, bins_per_job: int = 64) -> DataFrame:
    """Merge the small Parquet files of each partition folder of the table at ``path``.

    Files are packed per folder (``small_file_bins``); each bin is read and written by one
    task, without a shuffle, into a hidden folder of the table; the new file is then moved
    into the bin's own folder and the files it replaces are deleted.  Folders, their
    partition values and files that are large enough stay as they are.  The file list, not
    the data, passes through the driver, ``bins_per_job`` bins at a time.  A job that ends early leaves whole
    bins done or untouched, but for one whose old files were not all deleted yet: readers
    must not run meanwhile.  Returns one row: files before and after, bins, files replaced.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    before = file_sizes(spark, path).count()
    staging, bins, replaced = f"{path.rstrip('/')}/_compact-{uuid4().hex[:12]}", 0, 0
    # Written first: the list must not change while files are replaced.
    listed = scratch_path(spark, "bins")
    small_file_bins(spark, path, target_file_bytes).write.parquet(listed)
    jobs: list[list] = [[]]
    for row in spark.read.parquet(listed).toLocalIterator():
        jobs[-1].append(row)
        if len(jobs[-1]) == bins_per_job:
            bins, replaced = bins + bins_per_job, replaced + _merge_bins(spark, fs, fs_path, jobs.pop(), f"{staging}/{bins}")
            jobs.append([])
    replaced += _merge_bins(spark, fs, fs_path, jobs[-1], f"{staging}/{bins}")
    bins += len(jobs[-1])
    fs.delete(fs_path(staging), True)
    after = before - replaced + bins
    return spark.createDataFrame([(before, after, bins, replaced)], "files_before long, files_after long, bins long, files_replaced long")


def _merge_bins(spark, fs, fs_path, rows, staging: str) -> int:
    """One file per (folder, bin, files) row in place of its files; the number replaced."""
    if not rows:
        return 0
    parts = [spark.read.option("mergeSchema", True).parquet(*r.files).coalesce(1).withColumn("_bin", F.lit(i)) for i, r in enumerate(rows)]
    # Files of one table can differ in columns (added later); a bin has all those of its files.
    same: dict[str, list] = {}
    for i, p in enumerate(parts):
        same.setdefault(p.schema.simpleString(), []).append(p)
    for n, group in enumerate(same.values()):
        reduce(DataFrame.unionByName, group).write.partitionBy("_bin").parquet(f"{staging}/{n}")
    for n, _ in enumerate(same):
        for folder in fs.listStatus(fs_path(f"{staging}/{n}")):
            name = folder.getPath().getName()
            if not name.startswith("_bin="):
                continue
            row = rows[int(name[5:])]
            new = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().endswith(".parquet")]
            for f in new:
                if not fs.rename(f, fs_path(row.folder, f"compact-{uuid4().hex[:12]}-{f.getName()}")):
                    raise OSError(f"cannot move {f} into {row.folder}")
            for old in row.files:
                fs.delete(fs_path(old), False)
    return sum(len(r.files) for r in rows)


#: Rows from which the edges of Z-order buckets are taken.
EDGE_SAMPLE = 20_000


def typed_edges(df: DataFrame, keys, buckets: int, sample: int = EDGE_SAMPLE) -> list[list]:
    """Ascending distinct values of each key that part a bounded random sample of the rows
    into about ``buckets`` equal parts.  Values keep their type: strings are whole."""
    some = df.select(*keys).orderBy(F.rand(7)).limit(sample).toLocalIterator()
    columns = list(zip(*(tuple(r) for r in some))) or [()] * len(keys)
    out = []
    for values in columns:
        values = sorted(v for v in values if v is not None and v == v)
        at = sorted({values[len(values) * i // buckets] for i in range(1, buckets)}) if values else []
        out.append(at)
    return out


def bucket_of(c: Column, edges: list) -> Column:
    """How many of the ascending edges are not above the value, by a binary search over the
    (constant) array of edges (NULL: 0)."""
    if not edges:
        return F.lit(0).cast("long")
    held = F.array(*[F.lit(e) for e in edges])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda b, step: F.when(F.get(held, b + step - 1) <= c, b + step).otherwise(b)).cast("long")


def zorder_key(df: DataFrame, keys, bits: int = 8, sample: int = EDGE_SAMPLE) -> DataFrame:
    """Adds ``_z``: each key ranked into 2^bits buckets, bits interleaved.

    The bucket edges are values of the key's own type from a sample of ``sample`` rows, at most
    2^bits - 1 a key; the Z-value is a plain projection that later stages (range sampling,
    shuffle) do not recompute through an aggregate.
    """
    keys = list(keys)
    edges = typed_edges(df, keys, 2 ** bits, sample)
    names = [f"_zb{j}" for j in range(len(keys))]
    x = df.withColumns({n: bucket_of(F.col(k), e) for n, k, e in zip(names, keys, edges)})
    z = F.lit(0).cast("long")
    for i in range(bits):
        for j, n in enumerate(names):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(n), i).bitwiseAND(F.lit(1)), i * len(keys) + j))
    return x.withColumn("_z", z).drop(*names)


def zorder_write(df: DataFrame, path: str, keys, num_files: int = 16, bits: int = 8,
                 mode: str = "overwrite") -> str:
    """Z-ordered write: range partitions of the interleaved key, sorted inside."""
    z = zorder_key(df, keys, bits)
    (z.repartitionByRange(num_files, "_z").sortWithinPartitions("_z").drop("_z")
     .write.mode(mode).parquet(path))
    return path


def file_skipping(spark, path: str, predicates: dict) -> DataFrame:
    """Files whose min/max admit each point value (what Parquet min/max skipping can skip)."""
    df = spark.read.parquet(path).withColumn("_file", F.input_file_name())
    stats = df.groupBy("_file").agg(*[agg for c in predicates for agg in
                                      (F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}"))])
    return stats.agg(F.count(F.lit(1)).alias("files"), *[
        F.sum(((F.col(f"_min_{c}") <= F.lit(v)) & (F.col(f"_max_{c}") >= F.lit(v))).cast("long"))
        .alias(f"files_admitting_{c}") for c, v in predicates.items()])


def with_derived_day(df: DataFrame, ts_col: str, day_col: str) -> DataFrame:
    """Generated partition column ``day = CAST(ts AS DATE)``."""
    return df.withColumn(day_col, F.to_date(F.col(ts_col)))


def partitioned_write(df: DataFrame, path: str, ts_col: str, day_col: str = "creation_day",
                      mode: str = "overwrite") -> str:
    """Write partitioned by the derived day (one folder per day).

    REBALANCE on the day groups each day's rows into few files while AQE splits a day that
    is much larger than the others, so one hot day is written by several tasks.
    """
    with_derived_day(df, ts_col, day_col).hint("rebalance", day_col).write.mode(mode) \
        .partitionBy(day_col).parquet(path)
    return path


def assign_identity(df: DataFrame, order_col: str, start: int = 10000, step: int = 1,
                    id_col: str = "id", offset: Column | int = 0) -> DataFrame:
    """Identity ids ``start, start + step, ...`` following ``order_col`` (unique, numeric).

    Positions come from ``ranking.row_numbers`` (bucketed prefix sums), so the global order
    never passes through one task; the ids do not depend on the partitioning.
    """
    rn = row_numbers(df, [], order_col, order_col, out_col="_rn").drop("group_n")
    off = offset if isinstance(offset, Column) else F.lit(offset)
    return rn.withColumn(id_col, (F.lit(start) + (F.col("_rn") - 1 + off) * F.lit(step)).cast("long")) \
        .drop("_rn")


def insert_select(spark, df: DataFrame, path: str, columns, order_col: str, ts_col: str,
                  day_col: str = "creation_day", id_col: str = "id", start: int = 10000) -> str:
    """``INSERT INTO t (columns) SELECT ...`` into a partitioned table with an identity
    column and a generated day column; ids continue after the table's current maximum."""
    try:
        current = spark.read.parquet(path).agg(F.max(id_col).alias("m")).first()["m"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a table that is not there yet starts anew
            raise
        current = None
    offset = 0 if current is None else int(current) - start + 1
    rows = assign_identity(df.select(*columns), order_col, start=start, id_col=id_col, offset=offset)
    with_derived_day(rows, ts_col, day_col).write.mode("append").partitionBy(day_col).parquet(path)
    return path


def partition_predicate_from_source(ts_col: str, day_col: str, lo=None, hi=None) -> Column:
    """A timestamp range on the source column plus the implied range on the derived
    day partition column, so plain Parquet prunes folders as a generated column would."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(ts_col) >= F.lit(lo)) & (F.col(day_col) >= F.to_date(F.lit(lo)))
    if hi is not None:
        cond = cond & (F.col(ts_col) <= F.lit(hi)) & (F.col(day_col) <= F.to_date(F.lit(hi)))
    return cond


def rebalance_write(df: DataFrame, path: str, max_records_per_file: int | None = None,
                    mode: str = "overwrite") -> str:
    """Write-time auto sizing: REBALANCE hint (AQE picks partition sizes) and an
    optional per-file record cap."""
    w = df.hint("rebalance").write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path
