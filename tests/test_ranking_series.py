"""Scalable ranks, quantiles and series windows against window functions / plain loops."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators import ranking as RK
from tessera.operators import series as S


@pytest.fixture(scope="module")
def skewed(spark):
    """One hot group (60% of rows) with many ties, plus small groups; a third of the hot
    group shares the value 0."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        g = "hot" if i < 1800 else f"g{i % 7}"
        v = 0.0 if (g == "hot" and i % 3 == 0) else float(rng.integers(0, 400))
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_percent_rank_equals_window(spark, skewed):
    got = RK.with_percent_rank(skewed, ["g"], "v").select("id", "pr")
    want = skewed.select("id", F.percent_rank().over(Window.partitionBy("g").orderBy("v")).alias("pr"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_row_numbers_equal_window(spark, skewed):
    got = RK.row_numbers(skewed, ["g"], "v", "id").select("id", "rn", "group_n")
    want = skewed.select("id", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).alias("rn"),
                         F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_n"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_global_ranks_without_groups(spark, skewed):
    got = RK.value_ranks(skewed, [], "v").select("v", "rank").collect()
    want = skewed.select("v", F.rank().over(Window.orderBy("v")).alias("rank")).distinct().collect()
    assert sorted(got) == sorted(want)


def test_nulls_ties_and_single_rows_keep_sql_ranks(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", None, 2), ("a", 3.0, 3), ("a", 3.0, 4), ("b", None, 5), (None, 2.0, 6)],
                               "g string, v double, id long")
    w = Window.partitionBy("g").orderBy("v")
    got = RK.with_percent_rank(df, ["g"], "v").select("id", "pr").collect()
    assert sorted(got) == sorted(df.select("id", F.percent_rank().over(w).alias("pr")).collect())
    rn = RK.row_numbers(df, ["g"], "v", "id").select("id", "rn", "group_n").collect()
    want = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).alias("rn"),
                     F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_n")).collect()
    assert sorted(rn) == sorted(want)


def test_rounding_does_not_saturate(spark):
    from tessera.functions.common import round_half_up

    row = spark.range(1).select(round_half_up(F.lit(1e14), 6).alias("a"), round_half_up(F.lit(1.005), 2).alias("b"),
                                round_half_up(F.lit(-1e300), 2).alias("c")).first()
    assert (row.a, row.b, row.c) == (1e14, 1.0, -1e300)


@pytest.mark.parametrize("n", [1, 2, 3, 500, 4100])
def test_exact_quantiles_equal_numpy(spark, n):
    """Ties, one hot value, nulls, an empty column and a constant one; small and bracketed sizes."""
    rng = np.random.default_rng(n)
    a, b = rng.normal(size=n), np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 40, n)).astype(float)
    rows = [(float(x), None if i % 3 == 1 else float(y), 2.5, None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column_name, r.prob): r.quantile for r in M.exact_quantiles(df, ["a", "b", "c", "d"], probs).collect()}
    values = {"a": a, "b": np.array([r[1] for r in rows if r[1] is not None]), "c": np.full(n, 2.5)}
    want = {(c, p): float(np.percentile(v, p * 100)) for c, v in values.items() for p in probs}
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_describe_counts_every_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "x double, y double")
    rows = {r.column_name: r for r in M.describe_numeric(df, ["x", "y"]).collect()}
    assert (rows["x"]["count"], rows["x"].p50, rows["x"].max) == (3, 2.0, 4.0)
    assert (rows["y"]["count"], rows["y"].mean, rows["y"].p25) == (0, None, None)


def test_weighted_prefix_sums_equal_window(spark, skewed):
    df = skewed.withColumn("w", F.when(F.col("id") % 5 > 0, F.col("id") % 7))
    got = RK.prefix_sums(df, ["g"], ["v", "id"], "w", "before", "total").select("id", "before", "total")
    over = Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("id", F.coalesce(F.sum("w").over(over), F.lit(0)).alias("before"), F.sum("w").over(Window.partitionBy("g")).alias("total"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_windows_of_five(spark):
    values = [3.0, 1.0, 4.0, 1.5, 9.0, 2.0, 6.0, 5.0, 3.5, 8.0]
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate(values)], "s string, t int, value double")
    w = S.sliding_windows(df, ["s"], "t", "value", 5).orderBy("t").collect()
    assert [list(r.features) for r in w] == [values[i:i + 5] for i in range(5)]
    assert [r.target for r in w] == values[5:]
    split = S.ordered_split(df, ["s"], "t", 0.8)
    assert split.filter("is_train").count() == 8
    wins = spark.createDataFrame([("m", r.t, r.target) for r in w], "s string, t int, value double")
    assert S.ordered_split(wins, ["s"], "t", 0.8).filter("is_train").count() == 4  # max(1, int(0.8 * 5))
    assert list(S.last_window(df, ["s"], "t", "value", 5).first().last_values) == values[5:]


def test_windows_of_seven(spark):
    df = spark.createDataFrame([("x", i, i * 1.5) for i in range(10)], "s string, t int, value double")
    assert S.sliding_windows(df, ["s"], "t", "value", 7).count() == 3


def test_naive_forecasts(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate([12.0, 15.0, 11.0, 14.5])], "s string, t int, value double")
    r = S.naive_forecast(df, ["s"], "t", "value").first()
    assert (r.forecast_repeat_last, r.forecast_add_last_diff, r.last_diff) == (14.5, 18.0, 3.5)


def test_zscore_population_std_and_inverse(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])],
                               "s string, t int, value double")
    sp = S.ordered_split(df, ["s"], "t", 0.8)
    stats = S.zscore_stats(sp.filter("is_train"), ["s"], "value")
    st = stats.first()
    assert st.mean == pytest.approx(2.5) and st.std == pytest.approx(np.std([1, 2, 3, 4]) + 1e-8)
    back = S.zscore_inverse(S.zscore(sp, stats, ["s"], "value")).collect()
    for r in back:
        assert r.restored == pytest.approx(r.value)


def test_early_stop_equals_loop(spark):
    metric = [0.5, 0.6, 0.55, 0.58, 0.61, 0.60, 0.59, 0.60, 0.7, 0.2]
    df = spark.createDataFrame([("r", i + 1, m) for i, m in enumerate(metric)], "s string, epoch int, acc double")
    got = S.early_stop(df, ["s"], "epoch", "acc", patience=3).orderBy("epoch").collect()
    best, no_improve, stop = 0.0, 0, None
    for i, m in enumerate(metric):
        if m > best:
            best, no_improve = m, 0
        else:
            no_improve += 1
        assert got[i].no_improve == no_improve and got[i].best_so_far == best
        if stop is None and no_improve >= 3:
            stop = i + 1
    assert [r.epoch for r in got if r.stop_here] == [stop]


def test_trailing_mean_strict_nulls(spark):
    df = spark.createDataFrame([(i, None if i == 9 else float(i)) for i in range(12)], "t int, v double")
    got = {r.t: r.v_ma3 for r in M.trailing_mean_strict(df, "v", "t", 3).collect()}
    assert got[0] is None and got[1] is None and got[2] == pytest.approx(1.0)
    assert got[9] is None and got[10] is None and got[11] is None  # a NULL inside the frame
    assert got[8] == pytest.approx(7.0)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5]], "x double")
    h = {r.bin: r["count"] for r in M.histogram(df, "x", 5).collect()}
    assert h == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2}


def test_parse_day_uses_utc_day_for_zoned_text(spark):
    import datetime as dt

    df = spark.createDataFrame([("2024-01-01 23:30:00 -0200",), ("2024-01-01 01:00:00 +0530",),
                                ("2024-01-01 23:59:59",), ("not a time",)], "s string")
    got = [r.d for r in df.select(M.parse_day_multi("s").alias("d")).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2023, 12, 31), dt.date(2024, 1, 1), None]
