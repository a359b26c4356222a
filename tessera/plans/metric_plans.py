"""Keys for daily social metrics, descriptive statistics, series windows and reshapes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.common import round_half_up
from ..operators import metrics as M
from ..operators import retail as R
from ..operators import series as S
from ..sources.retail_model import RetailModel
from ..sources.tables import TABLES, Tables
from .registry import r2_sql, register, rounded, with_views

G = "metrics"
RANGE_START, RANGE_END = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
WINDOW_K = 5
DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _daily(spark, d):
    return M.daily_rollup(M.social_enrich(RetailModel(spark, d).posts))


_DAILY_SQL = """
p AS (SELECT CAST(substr(created_at, 1, 10) AS DATE) AS date,
             CASE WHEN retweeted_status_id IS NOT NULL THEN 1 ELSE 0 END AS retweet_count,
             rating_numerator AS likes, tweet_id, text, doggo, floofer, pupper, puppo, name
      FROM posts),
dd AS (SELECT date, COALESCE(SUM(CAST(likes AS DECIMAL(18,2))), 0) AS likes_dec,
              CAST(SUM(retweet_count) AS BIGINT) AS retweets, COUNT(*) AS tweets
       FROM p GROUP BY date),
daily AS (
  SELECT date, CAST(likes_dec AS DOUBLE) AS likes, retweets, tweets,
         CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(likes_dec) OVER w AS DOUBLE) / 7.0 END AS likes_ma7,
         CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(retweets) OVER w AS DOUBLE) / 7.0 END AS retweets_ma7,
         CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(tweets) OVER w AS DOUBLE) / 7.0 END AS tweets_ma7
  FROM dd WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


@register("daily_rollup", G, with_views(["posts"], f"WITH {_DAILY_SQL}\nSELECT * FROM daily"))
def q_daily_rollup(spark, d):
    return _daily(spark, d)


@register("date_range_filter", G, with_views(["posts"], f"""WITH {_DAILY_SQL}
SELECT * FROM daily WHERE date >= DATE '{RANGE_START}' AND date <= DATE '{RANGE_END}'"""))
def q_date_range_filter(spark, d):
    return M.date_range_filter(_daily(spark, d), RANGE_START, RANGE_END)


@register("period_totals", G, with_views(["posts"], f"""WITH {_DAILY_SQL}
SELECT total_likes, total_retweets, total_tweets, days,
       format('{{:,.2f}}', total_likes) AS total_likes_text FROM (
SELECT CAST(SUM(CAST(likes AS DECIMAL(18,2))) AS DOUBLE) AS total_likes,
       CAST(SUM(retweets) AS BIGINT) AS total_retweets, CAST(SUM(tweets) AS BIGINT) AS total_tweets,
       COUNT(*) AS days
FROM daily WHERE date >= DATE '{RANGE_START}' AND date <= DATE '{RANGE_END}') t"""))
def q_period_totals(spark, d):
    return M.period_totals(M.date_range_filter(_daily(spark, d), RANGE_START, RANGE_END))


@register("details_transmute", G, with_views(["posts"], f"""WITH {_DAILY_SQL}
SELECT date, tweet_id, text, likes, CASE WHEN retweet_count = 1 THEN 'Yes' ELSE 'No' END AS is_retweet,
       doggo, floofer, pupper, puppo, name
FROM p WHERE date >= DATE '{RANGE_START}' AND date <= DATE '{RANGE_END}'"""))
def q_details_transmute(spark, d):
    e = M.social_enrich(RetailModel(spark, d).posts)
    return M.details_transmute(M.date_range_filter(e, RANGE_START, RANGE_END))


@register("unpivot_metrics", G, with_views(["posts"], f"""WITH {_DAILY_SQL}
SELECT date, 'likes' AS metric, CAST(likes AS DOUBLE) AS value FROM daily
UNION ALL
SELECT date, 'retweets' AS metric, CAST(retweets AS DOUBLE) AS value FROM daily"""))
def q_unpivot_metrics(spark, d):
    return M.unpivot_metrics(_daily(spark, d), ["date"], ["likes", "retweets"])


@register("trailing_mean_strict", G, with_views(["series"], f"""
SELECT series_id, t, value,
       CASE WHEN COUNT(*) OVER w = 7 AND COUNT(value) OVER w = 7
            THEN {r2_sql('SUM(value) OVER w / 7.0', 6)} END AS value_ma7
FROM series WINDOW w AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""))
def q_trailing_mean_strict(spark, d):
    s = RetailModel(spark, d).series
    out = M.trailing_mean_strict(s, "value", "t", 7, partition_cols=["series_id"])
    return out.withColumn("value_ma7", round_half_up(F.col("value_ma7"), 6))


@register("group_mean", G, """
SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS mean_value
FROM events WHERE event_type <> 'error' GROUP BY dayofweek(ts)""")
def q_group_mean(spark, d):
    ev = Tables(spark, d).events
    return M.group_mean(ev, F.col("event_type") != "error",
                        F.dayofweek("ts").alias("day_of_week"), "value")


@register("null_counts", G, with_views(["doc_frame"], """
SELECT column_name, null_count FROM (
  SELECT CAST(SUM(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS doc_id,
         CAST(SUM(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS lang,
         CAST(SUM(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS source,
         CAST(SUM(CASE WHEN n_chars IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_chars,
         CAST(SUM(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS quality,
         CAST(SUM(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS toxic,
         CAST(SUM(CASE WHEN quality_tag IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS quality_tag
  FROM doc_frame) w
UNPIVOT (null_count FOR column_name IN (doc_id, lang, source, n_chars, quality, toxic, quality_tag))"""))
def q_null_counts(spark, d):
    return M.null_counts(RetailModel(spark, d).doc_frame)


@register("table_shape", G, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS n_rows, "
    f"(SELECT COUNT(*) FROM information_schema.columns WHERE table_name = '{t}') AS n_cols"
    for t in TABLES))
def q_table_shape(spark, d):
    tb = Tables(spark, d)
    return M.table_shape({t: getattr(tb, t) for t in TABLES})


_BOUNDS = (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))


@register("date_bounds", G, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(MIN({c}) AS DATE) AS min_date, CAST(MAX({c}) AS DATE) AS max_date "
    f"FROM {t}" for t, c in _BOUNDS))
def q_date_bounds(spark, d):
    tb = Tables(spark, d)
    return M.date_bounds({t: (getattr(tb, t), c) for t, c in _BOUNDS})


@register("describe_numeric", G, "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, COUNT({c}) AS count, {r2_sql(f'AVG({c})', 6)} AS mean,
       {r2_sql(f'STDDEV_SAMP({c})', 6)} AS std, MIN({c}) AS min, MAX({c}) AS max,
       {r2_sql(f'QUANTILE_CONT({c}, 0.25)', 6)} AS p25, {r2_sql(f'QUANTILE_CONT({c}, 0.5)', 6)} AS p50,
       {r2_sql(f'QUANTILE_CONT({c}, 0.75)', 6)} AS p75
FROM lineitem""" for c in DESCRIBE_COLS))
def q_describe_numeric(spark, d):
    return rounded(M.describe_numeric(Tables(spark, d).lineitem, DESCRIBE_COLS), "mean", "std", "p25", "p50", "p75")


@register("histogram", G, """
WITH s AS (SELECT MIN(l_extendedprice) AS mn, MAX(l_extendedprice) AS mx FROM lineitem),
c AS (
  SELECT CAST(CASE WHEN s.mx - s.mn = 0 THEN 1
              ELSE LEAST(floor((l.l_extendedprice - s.mn) / (s.mx - s.mn) * 50.0) + 1, 50) END AS INTEGER) AS bin,
         COUNT(*) AS cnt
  FROM lineitem l CROSS JOIN s GROUP BY 1),
g AS (SELECT CAST(unnest(range(1, 51)) AS INTEGER) AS bin)
SELECT g.bin, s.mn + (g.bin - 1) * (s.mx - s.mn) / 50.0 AS lower, s.mn + g.bin * (s.mx - s.mn) / 50.0 AS upper,
       COALESCE(c.cnt, 0) AS count
FROM g CROSS JOIN s LEFT JOIN c ON c.bin = g.bin""")
def q_histogram(spark, d):
    return M.histogram(Tables(spark, d).lineitem, "l_extendedprice", 50)


@register("sliding_windows", G, with_views(["series"], f"""
SELECT series_id, t, features, target FROM (
  SELECT series_id, t, value AS target,
         list(value) OVER (PARTITION BY series_id ORDER BY t
                           ROWS BETWEEN {WINDOW_K} PRECEDING AND 1 PRECEDING) AS features
  FROM series) x
WHERE len(features) = {WINDOW_K}"""))
def q_sliding_windows(spark, d):
    return S.sliding_windows(RetailModel(spark, d).series, ["series_id"], "t", "value", WINDOW_K)


@register("last_window", G, with_views(["series"], f"""
SELECT series_id, list(value ORDER BY t) AS last_values FROM (
  SELECT series_id, t, value, row_number() OVER (PARTITION BY series_id ORDER BY t DESC) AS rn
  FROM series) x
WHERE rn <= {WINDOW_K} GROUP BY series_id"""))
def q_last_window(spark, d):
    return S.last_window(RetailModel(spark, d).series, ["series_id"], "t", "value", WINDOW_K)


@register("naive_forecast", G, with_views(["series"], """
SELECT series_id, last_value, last_value - prev_value AS last_diff, last_value AS forecast_repeat_last,
       last_value + (last_value - prev_value) AS forecast_add_last_diff
FROM (SELECT series_id, arg_max(value, t) AS last_value,
             arg_max(value, t) FILTER (WHERE t < (SELECT MAX(t) FROM series s2 WHERE s2.series_id = s.series_id))
               AS prev_value
      FROM series s GROUP BY series_id) x"""))
def q_naive_forecast(spark, d):
    return S.naive_forecast(RetailModel(spark, d).series, ["series_id"], "t", "value")


_SPLIT_SQL = """
sp AS (
  SELECT series_id, t, value,
         row_number() OVER (PARTITION BY series_id ORDER BY t) <=
           GREATEST(1, floor(COUNT(*) OVER (PARTITION BY series_id) * 0.8)) AS is_train
  FROM series)"""


@register("ordered_split", G, with_views(["series"], f"WITH {_SPLIT_SQL}\nSELECT * FROM sp"))
def q_ordered_split(spark, d):
    out = S.ordered_split(RetailModel(spark, d).series, ["series_id"], "t", 0.8)
    return out.select("series_id", "t", "value", "is_train")


_Z_SQL = f"""{_SPLIT_SQL},
st AS (SELECT series_id, AVG(value) AS mean, STDDEV_POP(value) + 1e-8 AS std
       FROM sp WHERE is_train GROUP BY series_id)"""


@register("zscore", G, with_views(["series"], f"""WITH {_Z_SQL}
SELECT sp.series_id, sp.t, sp.value, sp.is_train, {r2_sql('(sp.value - st.mean) / st.std', 6)} AS z
FROM sp JOIN st ON sp.series_id = st.series_id"""))
def q_zscore(spark, d):
    sp = S.ordered_split(RetailModel(spark, d).series, ["series_id"], "t", 0.8)
    stats = S.zscore_stats(sp.filter("is_train"), ["series_id"], "value")
    z = S.zscore(sp, stats, ["series_id"], "value")
    return z.select("series_id", "t", "value", "is_train", round_half_up("z", 6).alias("z"))


@register("zscore_inverse", G, with_views(["series"], f"""WITH {_Z_SQL}
SELECT sp.series_id, sp.t, {r2_sql('((sp.value - st.mean) / st.std) * st.std + st.mean', 6)} AS restored
FROM sp JOIN st ON sp.series_id = st.series_id"""))
def q_zscore_inverse(spark, d):
    sp = S.ordered_split(RetailModel(spark, d).series, ["series_id"], "t", 0.8)
    stats = S.zscore_stats(sp.filter("is_train"), ["series_id"], "value")
    back = S.zscore_inverse(S.zscore(sp, stats, ["series_id"], "value"))
    return back.select("series_id", "t", round_half_up("restored", 6).alias("restored"))


@register("early_stop", G, """
WITH m AS (
  SELECT event_type AS series_id, CAST(ts AS DATE) AS t,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS metric
  FROM events GROUP BY 1, 2),
b AS (
  SELECT *, GREATEST(COALESCE(MAX(metric) OVER (PARTITION BY series_id ORDER BY t
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS best_before
  FROM m),
i AS (SELECT *, metric > best_before AS improved FROM b),
g AS (SELECT *, SUM(CAST(improved AS INTEGER)) OVER (PARTITION BY series_id ORDER BY t
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM i),
n AS (SELECT *, SUM(CAST(NOT improved AS INTEGER)) OVER (PARTITION BY series_id, grp ORDER BY t
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no_improve FROM g),
f AS (SELECT *, MIN(CASE WHEN no_improve >= 3 THEN t END) OVER (PARTITION BY series_id) AS first_stop FROM n)
SELECT series_id, t, metric, GREATEST(best_before, metric) AS best_so_far, improved,
       CAST(no_improve AS BIGINT) AS no_improve, COALESCE(t = first_stop, false) AS stop_here,
       COALESCE(t > first_stop, false) AS after_stop
FROM f""")
def q_early_stop(spark, d):
    ev = Tables(spark, d).events
    m = (ev.groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("t"))
         .agg((F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("value"))
              .alias("metric")))
    out = S.early_stop(m, ["series_id"], "t", "metric", patience=3)
    return out.select("series_id", "t", "metric", "best_so_far", "improved",
                      F.col("no_improve").cast("long").alias("no_improve"), "stop_here", "after_stop")


@register("cohort_grid", G, with_views(["customers", "orders"], """
WITH member AS (
  SELECT customer_id, CAST(date_trunc('month', registration_date) AS DATE) AS joined FROM customers),
bought AS (
  SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS bm
  FROM orders WHERE order_status <> 'Cancelled'),
size AS (SELECT joined, COUNT(*) AS n FROM member GROUP BY joined),
act AS (
  SELECT me.joined, date_diff('month', me.joined, bo.bm) AS cohort_index, COUNT(*) AS a
  FROM member me JOIN bought bo ON bo.customer_id = me.customer_id AND bo.bm >= me.joined
  GROUP BY 1, 2),
r AS (
  SELECT strftime(sz.joined, '%Y-%m-01') AS cohort_month, ac.cohort_index,
         floor(CAST(ac.a AS DOUBLE) * 100.0 / CAST(sz.n AS DOUBLE) * 100.0 + 0.5) / 100.0 AS pct
  FROM size sz JOIN act ac ON ac.joined = sz.joined)
SELECT ro.cohort_month, list((SELECT MAX(pct) FROM r WHERE r.cohort_month = ro.cohort_month AND r.cohort_index = ix.i) ORDER BY ix.i) AS cells
FROM (SELECT DISTINCT cohort_month FROM r) ro
CROSS JOIN (SELECT unnest(generate_series(0, (SELECT MAX(cohort_index) FROM r))) AS i) ix
GROUP BY ro.cohort_month"""))
def q_cohort_grid(spark, d):
    m = RetailModel(spark, d)
    return R.cohort_grid(R.cohort_retention(m.customers, m.orders))
