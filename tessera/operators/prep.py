"""Feature preparation (P10-P17, M1-M5, M8): masks, fills, encodings, splits, weights.

Splits are deterministic functions of a row id and a seed (``xxhash64``), not of the
partitioning, so a lost executor recomputes exactly the same split.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import row_numbers


def conditional_reset(df: DataFrame, mask: Column, assignments: dict) -> DataFrame:
    """P10: ``frame.loc[mask, col] = value`` for each (col, value); other rows unchanged.

    A NULL mask leaves the row unchanged (as a NaN comparison does in pandas).
    """
    return df.withColumns({c: F.when(mask, F.lit(v)).otherwise(F.col(c))
                           for c, v in assignments.items()})


def fill_constant(df: DataFrame, value, cols) -> DataFrame:
    """NULL -> constant in the listed columns."""
    return df.fillna(value, subset=list(cols))


def fill_from_stats(df: DataFrame, stats: DataFrame, cols) -> DataFrame:
    """NULL -> the value of a one-row statistics frame (e.g. medians of the learning part).

    ``stats`` has one row (a global aggregate), so broadcasting it is size-safe; the same
    statistics can be applied to any number of frames (train, test).
    """
    s = stats.select(*[F.col(c).alias(f"_stat_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(s))
    return j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_stat_{c}"))
                          for c in cols}).drop(*[f"_stat_{c}" for c in cols])


def label_binarize(c, positive: str = "yes") -> Column:
    """Trim, lower-case, compare with ``positive``; 1 or 0 (NULL stays NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.lower(F.trim(c)) == F.lit(positive.lower())).cast("int")


def align_columns(df: DataFrame, columns, fill=0) -> DataFrame:
    """P16 + P17: exactly ``columns`` in that order; missing ones filled, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])


def drop_columns(df: DataFrame, cols) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def level_index(df: DataFrame, col: str) -> DataFrame:
    """(level, level_index): the distinct values in sort order, numbered from 0.  The values are
    ranked across partitions and stay a table; none reaches the driver."""
    levels = df.select(F.col(col).alias("level")).where(F.col("level").isNotNull()).distinct()
    ranked = row_numbers(levels, [], "level", "level", out_col="_rn")
    return ranked.select("level", (F.col("_rn") - 1).alias("level_index"))


def category_levels(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a categorical column, for outputs with one column per level
    (their names must be known when the plan is built)."""
    return [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).toLocalIterator()]


def one_hot(df: DataFrame, cols, levels: dict | None = None, drop_original: bool = True) -> DataFrame:
    """M5 / H2: one 0/1 column ``<col>_<level>`` per level, every level kept (no drop-first).
    For columns of many levels use ``one_hot_vector``."""
    out = df
    for c in cols:
        lv = (levels or {}).get(c) or category_levels(df, c)
        out = out.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int") for v in lv})
        if drop_original:
            out = out.drop(c)
    return out


def label_encode(df: DataFrame, col: str, out_col: str | None = None, levels: DataFrame | None = None) -> DataFrame:
    """M4: alphabetical label encoding (0 for the first label in sort order), as a double.

    Codes are joined by value from the level table (``level_index`` of this frame unless one
    is given); a NULL or unseen label gets the next code, as an "unknown" bucket.  The number
    of levels is not limited.
    """
    out_col = out_col or f"{col}_index"
    levels = level_index(df, col) if levels is None else levels
    x = df.join(levels, F.col(col) == F.col("level"), "left")
    unknown = F.broadcast(levels.agg(F.count(F.lit(1)).alias("_unknown")))  # one row
    return x.crossJoin(unknown).withColumn(out_col, F.coalesce("level_index", "_unknown").cast("double")).drop(
        "level", "level_index", "_unknown")


def one_hot_vector(df: DataFrame, col: str, out_col: str | None = None, levels: DataFrame | None = None) -> DataFrame:
    """M5 / H2 for any number of levels: a sparse vector with a 1 at the level's code (no 1
    for a NULL or unseen label)."""
    out_col = out_col or f"{col}_onehot"
    levels = level_index(df, col) if levels is None else levels
    size = levels.count()
    x = label_encode(df, col, "_code", levels)
    if not size:
        return x.withColumn(out_col, array_to_vector(F.array().cast("array<double>"))).drop("_code")
    encoder = OneHotEncoder(inputCol="_code", outputCol=out_col, dropLast=True, handleInvalid="error")
    # The model only needs the number of codes; the last, for unknown labels, is dropped.
    codes = df.sparkSession.range(size, size + 1).select(F.col("id").cast("double").alias("_code"))
    return encoder.fit(codes).transform(x).drop("_code")


def _hash_order(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col), F.lit(int(seed)))


def stratified_split(df: DataFrame, label_col: str, id_col: str, train_share: float = 0.7,
                     seed: int = 42) -> DataFrame:
    """M1: per class, the ``floor(share x n_c + 0.5)`` rows first in a seeded hash order are
    learning rows.  Adds ``is_train``; class sizes are kept exactly."""
    x = df.withColumn("_h", _hash_order(id_col, seed))
    x = row_numbers(x, [label_col], "_h", id_col, out_col="_rn")
    n_train = F.floor(F.col("group_n") * F.lit(float(train_share)) + F.lit(0.5))
    return x.withColumn("is_train", F.col("_rn") <= n_train).drop("_h", "_rn", "group_n")


def per_class_split(df: DataFrame, label_col: str, id_col: str, train_share: float = 0.8,
                    seed: int = 42) -> DataFrame:
    """M3: per class ``n_train = int(n_c x share)`` (floor) in a seeded hash order."""
    x = df.withColumn("_h", _hash_order(id_col, seed))
    x = row_numbers(x, [label_col], "_h", id_col, out_col="_rn")
    n_train = F.floor(F.col("group_n") * F.lit(float(train_share)))
    return x.withColumn("is_train", F.col("_rn") <= n_train).drop("_h", "_rn", "group_n")


def random_split(df: DataFrame, id_col: str, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """M2: plain random split; each row independently by a seeded hash of its id."""
    u = F.pmod(_hash_order(id_col, seed), F.lit(1_000_000)).cast("double") / F.lit(1e6)
    return df.withColumn("is_train", u < F.lit(float(train_share)))


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """M8: "balanced" weight per class, n / (k x n_c).  One row per class."""
    per = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    tot = per.agg(F.sum("n_c").alias("_n"), F.count(F.lit(1)).alias("_k"))  # one row
    return (per.crossJoin(F.broadcast(tot))
            .select(label_col, "n_c",
                    (F.col("_n").cast("double") / (F.col("_k") * F.col("n_c")).cast("double"))
                    .alias("weight")))


def with_class_weights(df: DataFrame, label_col: str, weight_col: str = "weight") -> DataFrame:
    """Rows with their class weight attached (the weight table has one row per class)."""
    w = class_weights(df, label_col).select(label_col, F.col("weight").alias(weight_col))
    return df.join(w, label_col)


def add_date_parts(df: DataFrame, col: str, names=("Year", "Month", "Day")) -> DataFrame:
    """Year, month and day-of-month columns of a date / timestamp column."""
    y, m, d = names
    c = F.col(col)
    return df.withColumns({y: F.year(c), m: F.month(c), d: F.dayofmonth(c)})
