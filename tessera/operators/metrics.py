"""Descriptive statistics, daily rollups, trailing means and reshapes (sections 2.4, 2.5, 2.12)."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import cents, from_cents, money_sum, thousands

# Timestamp text patterns tried in order (text with a zone offset, then without).
SOCIAL_TS_FORMATS = ("yyyy-MM-dd HH:mm:ss Z", "yyyy-MM-dd HH:mm:ss")


def parse_timestamp_multi(c, formats=SOCIAL_TS_FORMATS) -> Column:
    """First pattern that parses wins; NULL when none does (never an error)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def _has_zone(fmt: str) -> bool:
    return any(ch in fmt for ch in "ZXxOVz")


def parse_day_multi(c, formats=SOCIAL_TS_FORMATS) -> Column:
    """Calendar day of a timestamp text: text with a zone offset gives its UTC day, text
    without one gives its written day; the first pattern that parses wins.  The result does
    not depend on the session time zone."""
    c = F.col(c) if isinstance(c, str) else c
    days = []
    for f in formats:
        ts = F.try_to_timestamp(c, F.lit(f))
        if _has_zone(f):  # an instant: its UTC day from epoch seconds
            days.append(F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")))
        else:  # wall time read and written back in the same (session) zone
            days.append(F.to_date(ts))
    return F.coalesce(*days)


def flag_not_null(c) -> Column:
    """1 when the value is present, else 0."""
    return F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def social_enrich(posts: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """Per post: calendar date from the text timestamp, retweet flag, likes."""
    return posts.withColumns({
        "date": parse_day_multi(ts_col),
        "retweet_count": flag_not_null("retweeted_status_id"),
        "likes": F.col("rating_numerator"),
    })


def trailing_mean_strict(df: DataFrame, value_col: str, order_col: str, width: int,
                         partition_cols=(), out_col: str | None = None) -> DataFrame:
    """Mean of the last ``width`` rows; NULL until ``width`` rows exist or if any is NULL.

    The frame counts rows, not days (missing days are not filled in).
    """
    w = (Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy(F.lit(1)))
    w = w.orderBy(order_col).rowsBetween(-(width - 1), 0)
    out_col = out_col or f"{value_col}_ma{width}"
    v = F.col(value_col)
    return df.withColumn(
        out_col,
        F.when((F.count(F.lit(1)).over(w) == width) & (F.count(v).over(w) == width),
               F.sum(v).over(w) / F.lit(float(width))))


def daily_rollup(enriched: DataFrame, ma_width: int = 7) -> DataFrame:
    """A11 + W4: per date likes (NULLs skipped, all-NULL gives 0), retweets, posts, and
    strict trailing means.  The window runs on the daily table (one row per date)."""
    daily = enriched.groupBy("date").agg(
        F.coalesce(F.sum(cents("likes")), F.lit(0).cast("long")).alias("_likes"),
        F.sum("retweet_count").cast("long").alias("retweets"),
        F.count(F.lit(1)).alias("tweets"))
    # Likes stay in whole cents, so the window sums do not depend on evaluation order.
    daily = daily.withColumn("likes", from_cents("_likes"))
    for c in ("retweets", "tweets"):
        daily = trailing_mean_strict(daily, c, "date", ma_width)
    w = Window.partitionBy(F.lit(1)).orderBy("date").rowsBetween(-(ma_width - 1), 0)
    likes_ma = F.when(F.count(F.lit(1)).over(w) == ma_width,
                      from_cents(F.sum("_likes").over(w)) / F.lit(float(ma_width)))
    return daily.select("date", "likes", "retweets", "tweets", likes_ma.alias(f"likes_ma{ma_width}"),
                        f"retweets_ma{ma_width}", f"tweets_ma{ma_width}").orderBy("date")


def date_range_filter(df: DataFrame, start, end, col: str = "date") -> DataFrame:
    """Closed range ``start <= col <= end``."""
    return df.filter(F.col(col).between(F.lit(start), F.lit(end)))


def period_totals(daily: DataFrame) -> DataFrame:
    """Totals over the (filtered) daily rows, with the likes total also as text with
    thousands separators (as on the dashboard tiles)."""
    t = daily.agg(money_sum("likes").alias("total_likes"),
                  F.sum("retweets").cast("long").alias("total_retweets"),
                  F.sum("tweets").cast("long").alias("total_tweets"),
                  F.count(F.lit(1)).alias("days"))
    return t.withColumn("total_likes_text", thousands("total_likes", 2))


def details_transmute(enriched: DataFrame) -> DataFrame:
    """P2 + P18: the detail table, only the listed columns, retweet flag as Yes/No."""
    return enriched.select(
        "date", "tweet_id", "text", "likes",
        F.when(F.col("retweet_count") == 1, "Yes").otherwise("No").alias("is_retweet"),
        "doggo", "floofer", "pupper", "puppo", "name")


def unpivot_metrics(df: DataFrame, id_cols, value_cols, var_name: str = "metric",
                    value_name: str = "value") -> DataFrame:
    """H1: wide to long."""
    cast = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    return cast.unpivot(list(id_cols), list(value_cols), var_name, value_name)


def group_mean(df: DataFrame, keep: Column, group_col, value_col: str,
               out_col: str = "mean_value") -> DataFrame:
    """A10: mean of a value per group over the rows that pass ``keep``."""
    g = F.col(group_col) if isinstance(group_col, str) else group_col
    return (df.filter(keep).groupBy(g)
            .agg((from_cents(F.sum(cents(value_col))) / F.count(value_col)).alias(out_col)))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of NULLs per column, one row per column (one scan)."""
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def table_shape(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named frame."""
    parts = [f.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(f.columns)).cast("long").alias("n_cols"))
        for name, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def date_bounds(frames: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last date of a date/time column per named frame."""
    parts = [f.agg(F.min(F.to_date(c)).alias("min_date"), F.max(F.to_date(c)).alias("max_date"))
             .select(F.lit(name).alias("table_name"), "min_date", "max_date")
             for name, (f, c) in frames.items()]
    return reduce(DataFrame.unionByName, parts)


#: Size of the quantile sketch (rank error about 0.0004) and the half widths of the brackets
#: that are tried around a wanted rank before the whole range.
SKETCH_K = 8000
BRACKETS = (0.002, 0.02)


def _number(c) -> Column:
    """The column as a double, NaN as NULL (both count as missing)."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None))


def _sketched(df: DataFrame, cols, probs, *more) -> tuple[dict, dict]:
    """One pass: per column (count, min, max, ``more`` functions of it), and per (column,
    prob, width) two values that very probably enclose the wanted position."""
    functions = (F.count, F.min, F.max, *more)
    aggs = [f(_number(c)).alias(f"{i}_{j}") for i, c in enumerate(cols) for j, f in enumerate(functions)]
    aggs += [F.kll_sketch_agg_double(_number(c), F.lit(SKETCH_K)).alias(f"s{i}") for i, c in enumerate(cols)]
    sides = [(p, w, side) for p in probs for w in BRACKETS for side in (-1, 1)]
    ranks = [F.lit(min(1.0, max(0.0, p + side * w))) for p, w, side in sides]
    row = df.agg(*aggs).select("*", *[F.when(F.col(f"{i}_0") > 0, F.array(*[
        F.kll_sketch_get_quantile_double(f"s{i}", r) for r in ranks])).alias(f"q{i}") for i in range(len(cols))]).first()
    stats = {c: [row[f"{i}_{j}"] for j in range(len(functions))] for i, c in enumerate(cols)}
    around = {(c, *at): q for i, c in enumerate(cols) for at, q in zip(sides, row[f"q{i}"] or ())}
    return stats, around


def _inside(df: DataFrame, brackets) -> DataFrame:
    """(k, v, c): per bracket (column, low, high) number k how often each value inside it
    occurs, and with v NULL how many values lie below; counted per batch, so a frequent
    value is few rows."""
    lows, highs = [b[1] for b in brackets], [b[2] for b in brackets]
    wide = df.select(*[_number(c).alias(f"c{i}") for i, c in enumerate(dict.fromkeys(b[0] for b in brackets))])
    place = {c: i for i, c in enumerate(dict.fromkeys(b[0] for b in brackets))}
    at = [place[b[0]] for b in brackets]

    def run(batches):
        below = np.zeros(len(at), np.int64)
        for b in batches:
            arrays = [b.column(i).drop_null().to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
            for k, i in enumerate(at):
                below[k] += np.count_nonzero(arrays[i] < lows[k])
                v, c = np.unique(arrays[i][(arrays[i] >= lows[k]) & (arrays[i] <= highs[k])], return_counts=True)
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k)), pa.array(v), pa.array(c)], ["k", "v", "c"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(at))), pa.nulls(len(at), pa.float64()), pa.array(below)], ["k", "v", "c"])

    return wide.mapInArrow(run, "k long, v double, c long")


def _quantiles(df: DataFrame, stats: dict, around: dict, cols, probs) -> DataFrame:
    """(column_name, prob, quantile): the values inside the brackets are placed by prefix sums;
    where a bracket misses the position (the sketch is random) the next wider one is tried."""
    from .ranking import prefix_sums

    open_, found = [(c, float(p)) for c in cols for p in probs if stats[c][0]], {}
    for w in (*BRACKETS, None):
        if not open_:
            break
        brackets, positions = [], []
        for c, p in open_:
            n, least, most = stats[c][:3]
            low = least if w is None or p - w <= 0 else around[c, p, w, -1]
            high = most if w is None or p + w >= 1 else around[c, p, w, 1]
            brackets.append((c, low, high))
            positions.append((n - 1) * p)
        placed = prefix_sums(_inside(df, brackets), ["k"], ["v"], "c", "_below")
        edges = [F.array(*[F.lit(f(h)).cast("long") for h in positions])[F.col("k").cast("int")] for f in (math.floor, math.ceil)]
        holds = [(e >= F.col("_below")) & (e < F.col("_below") + F.col("c")) & F.col("v").isNotNull() for e in edges]
        rows = placed.groupBy("k").agg(*[F.max(F.when(h, F.col("v"))).alias(n) for h, n in zip(holds, ("lo", "hi"))]).collect()
        for r in rows:
            if r.lo is not None and r.hi is not None:
                h = positions[r.k]
                found[open_[r.k]] = r.lo + (r.hi - r.lo) * (h - math.floor(h))
        open_ = [x for x in open_ if x not in found]
    return df.sparkSession.createDataFrame([(c, p, q) for (c, p), q in found.items()], "column_name string, prob double, quantile double")


def exact_quantiles(df: DataFrame, cols, probs) -> DataFrame:
    """Exact, linearly interpolated quantiles of columns (as pandas / numpy ``linear``).

    Two scans and no exchange of all values: a sketch encloses the wanted positions
    (h = (n - 1) q and its two neighbours), then values below each bracket are counted and only
    the few inside it are shuffled.  NULL and NaN are left out.  Returns (column_name, prob, quantile), one
    row per column with values and probability.
    """
    return _quantiles(df, *_sketched(df, cols, probs), cols, probs)


def describe_numeric(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample std, min, 25%, 50%, 75%, max for each numeric column.

    One row per column, unrounded.  The first of two scans gives all but the quantiles, which
    are exact and interpolated.
    """
    probs = [0.25, 0.5, 0.75]
    stats, around = _sketched(df, cols, probs, F.avg, F.stddev_samp)
    basic = df.sparkSession.createDataFrame([(c, *stats[c]) for c in cols],
                                            "column_name string, count long, min double, max double, mean double, std double")
    qw = _quantiles(df, stats, around, cols, probs).groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in zip(probs, ("p25", "p50", "p75"))])
    return basic.join(qw, "column_name", "left").select("column_name", "count", "mean", "std", "min", "max", "p25", "p50", "p75")


def median_of(df: DataFrame, cols) -> DataFrame:
    """Exact interpolated median of each column, as one row (for ``fill_median``)."""
    q = exact_quantiles(df, cols, [0.5])
    return q.groupBy().pivot("column_name", list(cols)).agg(F.first("quantile"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max; the maximum falls in the last bin.

    Two passes: the minimum and maximum (two scalars), then one counting pass with them
    as literals.  Every bin is returned, empty ones with count 0.
    """
    v = F.col(col).cast("double")
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    spark = df.sparkSession
    if lo is None:  # no values: every bin empty
        return spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"),
                                               F.lit(None).cast("double").alias("lower"),
                                               F.lit(None).cast("double").alias("upper"),
                                               F.lit(0).cast("long").alias("count"))
    mn, mx = F.lit(float(lo)), F.lit(float(hi))
    width = mx - mn
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((v - mn) / width * F.lit(float(bins))) + 1, F.lit(bins)))
    counts = (df.filter(F.col(col).isNotNull())
              .groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    lower = mn + (F.col("bin") - 1) * (mx - mn) / F.lit(float(bins))
    upper = mn + F.col("bin") * (mx - mn) / F.lit(float(bins))
    return (grid.join(counts, "bin", "left")
            .select("bin", lower.alias("lower"), upper.alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")).orderBy("bin"))
