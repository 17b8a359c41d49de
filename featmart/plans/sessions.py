"""Session-log features on ``events`` (FIXTURES F2: user_id = visitor, ts = visit start,
props = JSON totals, value on ``purchase`` rows = revenue)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featmart.functions import keywords as kw
from featmart.functions.rows import pack, row_stats, nonzero_row_mean
from featmart.functions.scalar import (cross, epoch_to_ts, floor_div, hour_of, interaction_terms, json_number,
                                       json_struct, json_text, log_sum_exp1p, lower_or_nan, parse_yyyymmdd,
                                       quarter_of_month, safe_div, ts_micros, weekday_mon0)
from featmart.operators import encode as enc
from featmart.operators import relational as rel
from featmart.operators import windows as win
from featmart.operators.profile import group_median
from featmart.operators.split import group_kfold, kfold
from featmart.plans.registry import case_sql, query, rounded
from featmart.sources import tables

DAYS = list(range(1, 32))  # every day a month can have


def day_matrix(spark, base):
    """F3 surrogate: user x day-of-month event counts ``d1..d31`` (0 = no event) and a target
    (purchase revenue of the user). One conditional aggregate, no pivot discovery job."""
    e = tables(spark, base).events
    day = F.dayofmonth("ts")
    return e.groupBy("user_id").agg(
        *[F.count_if(day == d).cast("double").alias(f"d{d}") for d in DAYS],
        F.round(F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0)), 2)
        .alias("target"))


DAY_MATRIX_SQL = ("SELECT user_id, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE day(ts) = {d}) AS DOUBLE) AS d{d}" for d in DAYS)
    + ", round(coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0.0), 2) AS target"
    + " FROM events GROUP BY user_id")


@query("win05_session_gaps", """
SELECT event_id, user_id,
  CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3600000000.0) AS BIGINT) AS hours_since_prev,
  CAST(floor((epoch_us(ts) - epoch_us(lead(ts) OVER w)) / 3600000000.0) AS BIGINT) AS hours_to_next,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month,
  CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(day(ts) // 8 AS INTEGER) AS quarter_month
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""", ("WIN-5", "WIN-6", "SRT-1", "DAT-3", "DAT-4", "DAT-5", "DAT-6", "SCL-5"))
def win05_session_gaps(spark, base):
    e = tables(spark, base).events.select("event_id", "user_id", "ts")
    g = win.session_gaps(e, "user_id", "ts", "event_id")
    return g.select("event_id", "user_id", "hours_since_prev", "hours_to_next",
                    hour_of("ts").alias("hour"), F.dayofmonth("ts").alias("day"), F.month("ts").alias("month"),
                    weekday_mon0("ts").alias("weekday"), quarter_of_month("ts").alias("quarter_month"))


@query("win03_daily_ordinals", """
SELECT event_id, user_id,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS ordinal,
  count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS group_size,
  round(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)
        / count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)), 6) AS ordinal_ratio
FROM events
""", ("WIN-2", "WIN-3", "WIN-4"))
def win03_daily_ordinals(spark, base):
    e = tables(spark, base).events.select("event_id", "user_id", "ts").withColumn("day", F.to_date("ts"))
    out = win.ordinal_in_group(e, ["user_id", "day"], ["ts", "event_id"])
    return rounded(out.select("event_id", "user_id", "ordinal", "group_size", "ordinal_ratio"))


def _user_agg(e, sum_of_logs: bool):
    k = json_number("props", "k")
    rev = F.when(F.col("event_type") == "purchase", F.col("value"))
    revenue = F.sum(F.log1p(rev)) if sum_of_logs else F.log1p(F.sum(rev))
    stats = e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.coalesce(revenue, F.lit(0.0)).alias("revenue_log"),
        F.avg(k).alias("k_mean"), F.var_samp(k).alias("k_var"),
        F.stddev_samp("value").alias("value_std"), F.max(k).alias("k_max"),
        F.floor((ts_micros(F.max("ts")) - ts_micros(F.min("ts"))) / F.lit(86_400_000_000)).cast("bigint")
        .alias("span_days"),
        F.count_distinct(F.to_date("ts")).alias("n_days"))
    return stats.join(group_median(e, ["user_id"], k, "k_median"), "user_id", "left")


USER_AGG_SQL = """
SELECT user_id, count(*) AS n_events,
  round(coalesce({rev}, 0.0), 6) AS revenue_log,
  round(avg(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)), 6) AS k_mean,
  round(median(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)), 6) AS k_median,
  round(var_samp(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)), 6) AS k_var,
  round(stddev_samp(value), 6) AS value_std,
  round(max(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)), 6) AS k_max,
  CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0) AS BIGINT) AS span_days,
  count(DISTINCT CAST(ts AS DATE)) AS n_days
FROM events GROUP BY user_id
"""


@query("session_user_agg", USER_AGG_SQL.format(
    rev="ln(1 + sum(value) FILTER (WHERE event_type = 'purchase'))"),
    ("JSN-1", "AGG-2", "AGG-3", "AGG-4", "AGG-5", "AGG-16", "AGG-15", "SCL-1", "SRC-4"))
def session_user_agg(spark, base):
    return rounded(_user_agg(tables(spark, base).events, sum_of_logs=False))


@query("session_user_agg_sum_of_logs", USER_AGG_SQL.format(
    rev="sum(ln(1 + value)) FILTER (WHERE event_type = 'purchase')"), ("AGG-15", "SCL-1"))
def session_user_agg_sum_of_logs(spark, base):
    return rounded(_user_agg(tables(spark, base).events, sum_of_logs=True))


@query("win01_day_means", """
SELECT event_id,
  round(avg(value) OVER (PARTITION BY user_id, CAST(ts AS DATE)), 6) AS user_day_value_mean,
  round(avg(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0))
        OVER (PARTITION BY event_type), 6) AS type_k_mean
FROM events
""", ("WIN-1", "JN-6"))
def win01_day_means(spark, base):
    e = tables(spark, base).events.select("event_id", "user_id", "ts", "event_type", "value", "props") \
        .withColumn("day", F.to_date("ts")).withColumn("k", json_number("props", "k"))
    e = win.partition_mean(e, ["user_id", "day"], "value", "user_day_value_mean")
    e = win.partition_mean(e, "event_type", "k", "type_k_mean")
    return rounded(e.select("event_id", "user_day_value_mean", "type_k_mean"))


@query("enc07_freq_encoding", """
SELECT event_id, round(count(*) OVER (PARTITION BY event_type) / (SELECT count(*) FROM events), 6)
  AS event_type_frequency FROM events
""", ("ENC-7",))
def enc07_freq_encoding(spark, base):
    e = tables(spark, base).events.select("event_id", "event_type")
    return rounded(enc.frequency_encode(e, "event_type").select("event_id", "event_type_frequency"))


def _enc_frame(spark, base):
    e = tables(spark, base).events
    return e.select("event_id", json_number("props", "k").cast("int").cast("string").alias("k_cat"),
                    F.when(F.col("event_type") == "purchase", F.col("value")).alias("revenue"),
                    (F.dayofmonth("ts") > 20).alias("is_test"))


@query("enc08_target_encoding", """
WITH e AS (SELECT event_id, CAST(CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS INTEGER) AS VARCHAR) AS k_cat,
                  CASE WHEN event_type = 'purchase' THEN value END AS revenue, day(ts) > 20 AS is_test FROM events),
g AS (SELECT avg(revenue) AS g FROM e WHERE NOT is_test),
s AS (SELECT k_cat, count(revenue) AS n, sum(revenue) AS s FROM e WHERE NOT is_test GROUP BY k_cat)
SELECT event_id, round(CASE WHEN n > 0 THEN (s + g * 5) / (n + 5) END, 6) AS enc_k
FROM e LEFT JOIN s USING (k_cat), g WHERE is_test
""", ("ENC-8", "Q17"))
def enc08_target_encoding(spark, base):
    e = _enc_frame(spark, base)
    train, test = e.where(~F.col("is_test")), e.where(F.col("is_test"))
    params, _ = enc.target_mean_fit(train, "k_cat", "revenue", alpha=5.0)
    return rounded(enc.target_mean_apply(test, params, "k_cat", "enc_k").select("event_id", "enc_k"))


@query("enc09_target_encoding_oof", """
WITH e AS (SELECT event_id, CAST(CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS INTEGER) AS VARCHAR) AS k_cat,
                  CASE WHEN event_type = 'purchase' THEN value END AS revenue,
                  CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|1989'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold
           FROM events WHERE day(ts) <= 20),
g AS (SELECT avg(revenue) AS g FROM e)
SELECT e1.event_id, round(coalesce(
  (SELECT (sum(e2.revenue) + g.g * 5) / (count(e2.revenue) + 5) FROM e e2
   WHERE e2.k_cat = e1.k_cat AND e2.fold <> e1.fold AND e2.revenue IS NOT NULL), g.g), 6) AS mean_k_fold_k_cat
FROM e e1, g
""", ("ENC-9", "SPL-4"))
def enc09_target_encoding_oof(spark, base):
    e = _enc_frame(spark, base).where(~F.col("is_test")).withColumn("fold", kfold("event_id", 5, 1989))
    out = enc.target_mean_oof(e, "k_cat", "revenue", "fold", alpha=5.0)
    return rounded(out.select("event_id", "mean_k_fold_k_cat"))


@query("scl07_interactions", """
WITH u AS (SELECT user_id, CAST(count(*) AS DOUBLE) AS n, sum(value) AS v,
                  avg(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)) AS k FROM events GROUP BY user_id)
SELECT user_id, round(n / nullif(v, 0), 6) AS n_div_v, round(n * v, 6) AS n_mul_v, round(n - v, 6) AS n_sub_v,
  round(v - n, 6) AS v_sub_n, round(n / nullif(k, 0), 6) AS n_div_k, round(n * k, 6) AS n_mul_k,
  round(n - k, 6) AS n_sub_k, round(k - n, 6) AS k_sub_n, round(v / nullif(k, 0), 6) AS v_div_k,
  round(v * k, 6) AS v_mul_k, round(v - k, 6) AS v_sub_k, round(k - v, 6) AS k_sub_v,
  round(v * v, 6) AS v_sq, round(1 / nullif(v, 0), 6) AS v_inv
FROM u
""", ("SCL-7", "SCL-3", "Q4"))
def scl07_interactions(spark, base):
    e = tables(spark, base).events
    u = e.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("value").alias("v"),
                                 F.avg(json_number("props", "k")).alias("k"))
    return rounded(u.select("user_id", *interaction_terms(["n", "v", "k"]),
                            (F.col("v") * F.col("v")).alias("v_sq"), safe_div(F.lit(1.0), "v").alias("v_inv")))


@query("str01_category_cross", """
SELECT lower(coalesce(lang, 'nan')) || '_' || source AS lang_source, count(*) AS n
FROM documents GROUP BY 1
""", ("STR-1", "STR-2"))
def str01_category_cross(spark, base):
    d = tables(spark, base).documents
    return d.groupBy(cross(lower_or_nan("lang"), "source").alias("lang_source")).agg(F.count(F.lit(1)).alias("n"))


_URL = "lower(coalesce(url, 'nan'))"


@query("str35_keyword_maps", f"""
SELECT page_id, {case_sql(_URL, kw.BROWSER_RULES, kw.BROWSER_EXACT)} AS browser,
  {case_sql(_URL, kw.ADCONTENT_RULES)} AS adcontent, {case_sql(_URL, kw.SOURCE_RULES)} AS source
FROM pages
""", ("STR-3", "STR-4", "STR-5"))
def str35_keyword_maps(spark, base):
    p = tables(spark, base).pages
    return p.select("page_id", kw.browser_family("url").alias("browser"),
                    kw.adcontent_group("url").alias("adcontent"), kw.source_group("url").alias("source"))


@query("dat01_epoch_parts", """
WITH s AS (SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS secs FROM events),
t AS (SELECT event_id, secs, strftime(to_timestamp(secs), '%Y%m%d') AS ymd FROM s)
SELECT event_id, secs, ymd, CAST(month(strptime(ymd, '%Y%m%d')) AS INTEGER) AS month,
  CAST(day(strptime(ymd, '%Y%m%d')) AS INTEGER) AS day, CAST(isodow(strptime(ymd, '%Y%m%d')) - 1 AS INTEGER) AS weekday
FROM t
""", ("DAT-1", "DAT-2", "DAT-4", "DAT-6", "PRJ-10"))
def dat01_epoch_parts(spark, base):
    e = tables(spark, base).events
    s = e.select("event_id", floor_div(ts_micros("ts"), 1_000_000).alias("secs"))
    t = s.withColumn("ymd", F.date_format(epoch_to_ts("secs"), "yyyyMMdd"))
    d = parse_yyyymmdd("ymd")
    return t.select("event_id", "secs", "ymd", F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
                    weekday_mon0(d).alias("weekday"))


@query("jsn03_flatten", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.browser') AS browser,
  coalesce(TRY_CAST(json_extract_string(props, '$.hits') AS DOUBLE), 0.0) AS hits
FROM events
""", ("JSN-2", "JSN-3", "JSN-1", "STR-7"))
def jsn03_flatten(spark, base):
    e = tables(spark, base).events
    s = e.select("event_id", json_struct("props", "k BIGINT, browser STRING").alias("s"),
                 json_number("props", "hits").alias("hits"), json_text("props", "browser").alias("__b"))
    return s.select("event_id", "s.k", "s.browser", "hits")


@query("arr01_row_stats", f"""
WITH m AS ({DAY_MATRIX_SQL}),
l AS (SELECT user_id, unnest([{', '.join(f'd{d}' for d in DAYS)}]) AS x FROM m),
s AS (SELECT user_id, count(*) FILTER (WHERE x IS NULL OR x = 0) AS nb_nans,
        avg(x) FILTER (WHERE x <> 0) AS mean_nz, median(x) FILTER (WHERE x <> 0) AS med_nz,
        sum(x) FILTER (WHERE x <> 0) AS sum_nz, stddev_samp(x) FILTER (WHERE x <> 0) AS std_nz,
        kurtosis(x) FILTER (WHERE x <> 0) AS kur_nz, count(*) FILTER (WHERE x <> 0) AS n_nz,
        avg(ln(1 + x)) FILTER (WHERE x <> 0) AS mlog_nz
      FROM l GROUP BY user_id)
SELECT user_id, round(ln(1 + mean_nz), 6) AS log_of_mean, round(mlog_nz, 6) AS mean_of_log,
  round(ln(1 + med_nz), 6) AS log_of_median, nb_nans, round(ln(1 + coalesce(sum_nz, 0)), 6) AS the_sum,
  round(std_nz, 6) AS the_std,
  round(CASE WHEN n_nz < 4 THEN NULL WHEN std_nz = 0 THEN 0 ELSE kur_nz END, 6) AS the_kur,
  round(exp(mlog_nz) - 1, 6) AS nonzero_mean
FROM s
""", ("ARR-1", "ARR-2", "ARR-3", "NUL-3"))
def arr01_row_stats(spark, base):
    m = day_matrix(spark, base)
    a = pack([f"d{d}" for d in DAYS])
    st = row_stats(a)
    return rounded(m.select("user_id", *[c.alias(n) for n, c in st.items()],
                            nonzero_row_mean(a).alias("nonzero_mean")))


@query("agg14_log_rollup", """
WITH p AS (SELECT user_id, ln(1 + value) AS p FROM events WHERE event_type = 'purchase')
SELECT user_id, round(ln(1 + sum(exp(p) - 1)), 6) AS user_log_revenue, count(*) AS n_purchases FROM p GROUP BY user_id
""", ("AGG-14", "SCL-1"))
def agg14_log_rollup(spark, base):
    e = tables(spark, base).events.where(F.col("event_type") == "purchase").select("user_id", F.log1p("value").alias("p"))
    return rounded(e.groupBy("user_id").agg(log_sum_exp1p("p").alias("user_log_revenue"),
                                            F.count(F.lit(1)).alias("n_purchases")))


@query("spl05_group_folds", """
SELECT CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|7'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold,
  count(DISTINCT user_id) AS n_users, count(*) AS n_events
FROM events GROUP BY 1
""", ("SPL-5", "SPL-4"))
def spl05_group_folds(spark, base):
    e = tables(spark, base).events.withColumn("fold", group_kfold("user_id", 5, 7))
    return e.groupBy("fold").agg(F.count_distinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n_events"))
