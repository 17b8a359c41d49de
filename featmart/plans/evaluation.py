"""Evaluation, drift, per-feature scoring, lag-key leak search and blending queries.

Surrogates (FIXTURES F4/F6): ``labels`` joined to ``documents`` with ``n_chars`` as the score and
``toxic`` / ``quality`` as classes; ``orders`` vs the sum of their lines as target / prediction;
the user x day matrix of ``events`` as the anonymous wide table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featmart.functions.rows import nonzero_row_mean, pack
from featmart.functions.scalar import argmax_index, one_hot_vector, threshold
from featmart.operators import evaluate as ev
from featmart.operators import leak as lk
from featmart.operators.split import kfold
from featmart.plans.registry import query, r, rounded
from featmart.plans.sessions import DAY_MATRIX_SQL, DAYS, day_matrix
from featmart.session import materialize
from featmart.sources import tables

LEAK_COLS = [f"d{d}" for d in reversed(DAYS)]  # newest first
N_LAGS = len(LEAK_COLS) - 2


def _scored(spark, base):
    t = tables(spark, base)
    return t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")


_SCORED_SQL = "SELECT l.doc_id, quality, toxic, n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id"


@query("evl01_accuracy", f"""
WITH s AS ({_SCORED_SQL})
SELECT round(avg(CASE WHEN quality = CAST(n_chars > 2000 AS INTEGER) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM s
""", ("EVL-1", "SCL-9"))
def evl01_accuracy(spark, base):
    s = _scored(spark, base).withColumn("pred", threshold("n_chars", 2000))
    return rounded(ev.accuracy(s, "quality", "pred"))


@query("evl02_confusion", f"""
WITH s AS ({_SCORED_SQL})
SELECT quality AS actual, CAST(n_chars > 2000 AS INTEGER) AS predicted, count(*) AS count FROM s GROUP BY 1, 2
""", ("EVL-2",))
def evl02_confusion(spark, base):
    s = _scored(spark, base).withColumn("pred", threshold("n_chars", 2000))
    return ev.confusion(s, "quality", "pred")


@query("evl03_roc_points", f"""
WITH s AS ({_SCORED_SQL}),
c AS (SELECT CAST(n_chars AS DOUBLE) AS score, count(*) FILTER (WHERE toxic = 1) AS pos,
             count(*) FILTER (WHERE toxic <> 1) AS neg FROM s GROUP BY 1),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM c)
SELECT score, round(sum(pos) OVER w / P, 6) AS tpr, round(sum(neg) OVER w / N, 6) AS fpr
FROM c, t WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""", ("EVL-3",))
def evl03_roc_points(spark, base):
    return rounded(ev.roc_points(_scored(spark, base), "toxic", "n_chars"))


_AUC_SQL = """
c AS (SELECT {grp} CAST({score} AS DOUBLE) AS score, count(*) FILTER (WHERE {label} = 1) AS pos,
             count(*) FILTER (WHERE {label} <> 1) AS neg FROM {src} GROUP BY {grp} 2 {grp_n}),
w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {part} ORDER BY score
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)"""


@query("evl04_roc_auc", f"""
WITH s AS ({_SCORED_SQL}),
ct AS (SELECT CAST(n_chars AS DOUBLE) AS score, count(*) FILTER (WHERE toxic = 1) AS pos, count(*) FILTER (WHERE toxic <> 1) AS neg
       FROM s GROUP BY 1),
wt AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ct),
cq AS (SELECT CAST(n_chars AS DOUBLE) AS score, count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality <> 1) AS neg
       FROM s GROUP BY 1),
wq AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM cq)
SELECT 'toxic' AS label, round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM wt
UNION ALL
SELECT 'quality', round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) FROM wq
""", ("EVL-4",))
def evl04_roc_auc(spark, base):
    s = _scored(spark, base)
    a = ev.auc(s, "toxic", "n_chars").select(F.lit("toxic").alias("label"), "auc")
    b = ev.auc(s, "quality", "n_chars").select(F.lit("quality").alias("label"), "auc")
    return rounded(a.unionByName(b))


def _order_pred(spark, base):
    t = tables(spark, base)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("pred"))
    return t.orders.select("o_orderkey", F.col("o_totalprice").alias("y")).join(lines, "o_orderkey")


_ORDER_PRED_SQL = """SELECT o_orderkey, o_totalprice AS y, pred FROM orders JOIN (
  SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS pred FROM lineitem GROUP BY l_orderkey
) ON o_orderkey = l_orderkey"""


@query("evl05_rmse", f"""
WITH p AS ({_ORDER_PRED_SQL})
SELECT round(sqrt(avg(pow(y - pred, 2))), 4) AS rmse, round(sqrt(avg(pow(ln(1 + y) - ln(1 + pred), 2))), 6) AS rmse_log FROM p
""", ("EVL-5", "SCL-1"))
def evl05_rmse(spark, base):
    p = _order_pred(spark, base)
    return p.agg(r(ev.rmse_expr("y", "pred"), 4).alias("rmse"), r(ev.rmse_expr("y", "pred", log_space=True)).alias("rmse_log"))


@query("evl06_r2", f"""
WITH p AS ({_ORDER_PRED_SQL}), m AS (SELECT avg(y) AS m FROM p)
SELECT round(1 - sum(pow(y - pred, 2)) / sum(pow(y - m, 2)), 6) AS r2 FROM p, m
""", ("EVL-6",))
def evl06_r2(spark, base):
    return rounded(ev.r2(_order_pred(spark, base), "y", "pred"))


@query("evl10_fold_report", f"""
WITH p AS ({_ORDER_PRED_SQL}),
f AS (SELECT CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|5'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold,
             sqrt(avg(pow(y - pred, 2))) AS v FROM p GROUP BY 1)
SELECT CAST(fold AS VARCHAR) AS fold, 'rmse' AS metric, round(v, 4) AS value FROM f
UNION ALL SELECT 'all', 'rmse_mean', round(avg(v), 4) FROM f
UNION ALL SELECT 'all', 'rmse_std', round(stddev_pop(v), 4) FROM f
""", ("EVL-10", "SPL-4"))
def evl10_fold_report(spark, base):
    p = _order_pred(spark, base).withColumn("fold", kfold("o_orderkey", 5, 5))
    return ev.fold_report(p, "fold", "y", "pred").withColumn("value", r("value", 4))


@query("evl07_micro_f1", """
WITH c AS (SELECT max(label) + 1 AS k FROM embeddings),
e AS (SELECT vec_id, label, k, embedding[1:k] AS s FROM embeddings, c),
p AS (SELECT label, k, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS pred FROM e),
t AS (SELECT unnest(range(0, k)) AS class FROM c),
f AS (SELECT class, count(*) FILTER (WHERE label = class AND pred = class) AS tp, count(*) FILTER (WHERE label <> class AND pred = class) AS fp,
             count(*) FILTER (WHERE label = class AND pred <> class) AS fn FROM p, t GROUP BY class)
SELECT round(2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS micro_f1,
  (SELECT round(avg(CASE WHEN list_transform(range(k), lambda i: CAST(i = label AS INTEGER))
                   = list_transform(range(k), lambda i: CAST(i = pred AS INTEGER)) THEN 1.0 ELSE 0.0 END), 6) FROM p) AS onehot_accuracy,
  count(*) AS n_classes
FROM f
""", ("EVL-7", "ENC-6", "SCL-10"))
def evl07_micro_f1(spark, base):
    e = tables(spark, base).embeddings
    # a class is a label value; the first scores of the vector, as many as there are classes, are its scores
    k = e.agg(F.max("label")).first()[0] + 1
    p = e.select("label", argmax_index(F.slice("embedding", 1, k)).alias("pred"))
    p = p.select("label", "pred", one_hot_vector("label", k).alias("y1"), one_hot_vector("pred", k).alias("p1"))
    return rounded(p.agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("micro_f1"),
                         F.avg((F.col("y1") == F.col("p1")).cast("double")).alias("onehot_accuracy"),
                         F.lit(k).cast("bigint").alias("n_classes")))


_DRIFT_FEATURES = ["o_totalprice", "o_custkey", "mid_day", "late_day"]
_FOLD4 = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|3'), 1, 8))::BIGINT % 4 AS INTEGER)"


def _drift_input(spark, base):
    """Orders from 1998 on play the test set. ``late_day`` moves with the date; ``mid_day`` puts test rows in the
    middle of train's range, which only a non-monotone score can see, beside a few outliers."""
    o = tables(spark, base).orders
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    test = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return o.select("o_orderkey", "o_totalprice", "o_custkey", day.cast("double").alias("late_day"),
                    F.when(test, 1000.0 + F.col("o_orderkey") % 50).when(F.col("o_orderkey") % 777 == 1, 1e12)
                    .otherwise((F.col("o_orderkey") % 2000).cast("double")).alias("mid_day"),
                    test.alias("is_test"))


def _cuts_sql(source: str, keys: str, bins: int) -> str:
    """For ``keys`` the ascending equal-count cuts of the non-null ``value`` of ``source``."""
    return f"""SELECT {keys}, list_sort(list(DISTINCT value)) AS cuts FROM (
      SELECT {keys}, value, row_number() OVER (PARTITION BY {keys} ORDER BY value) AS rn, count(*) OVER (PARTITION BY {keys}) AS n,
        max(value) OVER (PARTITION BY {keys}) AS hi FROM {source} WHERE value IS NOT NULL)
      WHERE value < hi AND list_contains(list_transform(range(1, {bins}), lambda j: (j * n + {bins - 1}) // {bins}), rn) GROUP BY {keys}"""


_BIN_SQL = "CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(coalesce(cuts, []), lambda x: x < value)) END"


def _splits_sql(hist: str, keys: str, l2: float, min_rows: int, scale: str, ties: str = "b, ml") -> tuple[str, str]:
    """Two selects: all splits of ``hist`` (``keys, b, r, n``; b = -1 missing), and, of a CTE ``tried`` with these, the best."""
    part = f"PARTITION BY {keys}"
    tried = f"""SELECT {keys}, b, ml, tr, tn, ur + CASE WHEN ml THEN mr ELSE 0 END AS lr, un + CASE WHEN ml THEN mn ELSE 0 END AS ln FROM (
      SELECT {keys}, b, sum(r) OVER ({part}) AS tr, sum(n) OVER ({part}) AS tn, coalesce(sum(r) FILTER (WHERE b < 0) OVER ({part}), 0) AS mr,
        coalesce(sum(n) FILTER (WHERE b < 0) OVER ({part}), 0) AS mn, sum(CASE WHEN b >= 0 THEN r ELSE 0 END) OVER ({part} ORDER BY b) AS ur,
        sum(CASE WHEN b >= 0 THEN n ELSE 0 END) OVER ({part} ORDER BY b) AS un FROM {hist} WHERE n > 0), (VALUES (FALSE), (TRUE)) t(ml)
      WHERE b >= 0 AND (NOT ml OR mn > 0)"""
    worth = f"round((lr * lr / (ln + {l2}) + (tr - lr) * (tr - lr) / (tn - ln + {l2}) - tr * tr / (tn + {l2})) / {scale}, 12)"
    group = ", ".join(k for k in keys.split(", ") if k != "axis")
    best = f"""SELECT *, lr / (ln + {l2}) AS lv, (tr - lr) / (tn - ln + {l2}) AS rv FROM (SELECT *, {worth} AS worth FROM {{tried}} JOIN {{scales}} USING ({{on}})
      WHERE ln >= {min_rows} AND tn - ln >= {min_rows}) WHERE worth > 0 QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY worth DESC, {ties}) = 1"""
    return tried, best


def _drift_sql(rows: str, features: list[str], bins: int = 32, depth: int = 5, min_rows: int = 5) -> str:
    """CTEs over ``rows`` (``fold, origin`` and the features) that end in ``drift (feature, auc)``."""
    ctes = [("l", f"SELECT fold, origin, feature, value FROM {rows} UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(features)}))"),
            ("c", _cuts_sql("l", "feature", bins)),
            ("h", f"SELECT feature, fold, {_BIN_SQL} AS b, sum(origin) AS pos, count(*) AS n FROM l LEFT JOIN c USING (feature) GROUP BY ALL"),
            ("k", "SELECT DISTINCT h.feature, f.fold AS k, h.b FROM h, (SELECT DISTINCT fold FROM h) f"),
            ("tc", """SELECT k.feature, k.k, k.b, coalesce(sum(h.pos), 0) AS r, coalesce(sum(h.n), 0) AS n
                      FROM k LEFT JOIN h ON h.feature = k.feature AND h.b = k.b AND h.fold <> k.k GROUP BY ALL"""),
            ("sc", "SELECT feature, k, sum(r) * (1 - sum(r) / sum(n)) AS scale, sum(r) / sum(n) AS m FROM tc GROUP BY ALL"),
            ("t0", "SELECT feature, k, b, 1 AS node, r, n, m AS v FROM tc JOIN sc USING (feature, k)")]
    for d in range(depth):
        tried, best = _splits_sql(f"(SELECT * FROM t{d} WHERE node >= {2 ** d})", "feature, k, node", 0.0, min_rows, "scale")
        left = "(t.b BETWEEN 0 AND s.b OR (t.b = -1 AND s.ml))"
        ctes += [(f"y{d}", tried), (f"s{d}", best.format(tried=f"y{d}", scales="sc", on="feature, k")),
                 (f"t{d + 1}", f"""SELECT t.feature, t.k, t.b, CASE WHEN s.node IS NULL THEN t.node WHEN {left} THEN 2 * t.node ELSE 2 * t.node + 1 END AS node,
                    t.r, t.n, CASE WHEN s.node IS NULL THEN t.v WHEN {left} THEN s.lv ELSE s.rv END AS v
                    FROM t{d} t LEFT JOIN s{d} s ON s.feature = t.feature AND s.k = t.k AND s.node = t.node""")]
    ctes += [("g", f"""SELECT t.feature, k, v, sum(h.pos) AS pos, sum(h.n - h.pos) AS neg FROM t{depth} t JOIN h ON h.feature = t.feature AND h.b = t.b AND h.fold = t.k GROUP BY ALL"""),
             ("w", "SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature, k ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g"),
             ("a", "SELECT feature, k, sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0) AS auc FROM w GROUP BY ALL"),
             ("drift", "SELECT feature, avg(auc) AS auc FROM a GROUP BY feature")]
    return ", ".join(f"{n} AS MATERIALIZED ({s})" for n, s in ctes)


@query("evl08_drift_report", f"""
WITH u AS (SELECT {_FOLD4} AS fold, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey,
    CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS late_day,
    CAST(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 1000 + o_orderkey % 50 WHEN o_orderkey % 777 = 1 THEN 1e12 ELSE o_orderkey % 2000 END AS DOUBLE) AS mid_day,
    CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS origin FROM orders),
{_drift_sql('u', _DRIFT_FEATURES)}
SELECT feature, round(auc, 6) AS drift_score, auc > 0.8 AS drifted FROM drift ORDER BY auc DESC, feature LIMIT 30
""", ("EVL-8", "SRT-2", "SRT-3", "PRJ-7", "SET-2"))
def evl08_drift_report(spark, base):
    o = _drift_input(spark, base)
    return rounded(ev.drift_report(o.where(~F.col("is_test")), o.where("is_test"), _DRIFT_FEATURES, "o_orderkey", 0.8, top=30, seed=3))


_SF_BASE, _SF_FEATURES = "l_quantity", ["l_discount", "l_tax", "big", "price_like"]
_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_SF_SQL = f"""
WITH b AS (SELECT l_extendedprice AS y, l_quantity AS b, CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax,
                  1600000000.0 + l_partkey % 97 AS big, l_extendedprice / l_quantity + l_linenumber AS price_like,
                  CAST(('0x' || substr(md5({_LINE_ID} || '|4'), 1, 8))::BIGINT % 4 AS INTEGER) AS fold FROM lineitem),
l AS (SELECT feature, y, b, fold, x FROM b UNPIVOT (x FOR feature IN (l_discount, l_tax, big, price_like))),
st AS (SELECT l.feature, f.fold, avg(b) AS mb, avg(x) AS mx, avg(y) AS my, var_pop(b) AS bb, var_pop(x) AS xx, covar_pop(b, x) AS bx,
              covar_pop(b, y) AS cby, covar_pop(x, y) AS cxy
       FROM l, (SELECT DISTINCT fold FROM b) f WHERE l.fold <> f.fold GROUP BY ALL),
k AS (SELECT *, (cby * xx - cxy * bx) / (bb * xx - bx * bx) AS kb, (cxy * bb - cby * bx) / (bb * xx - bx * bx) AS kx FROM st),
r AS (SELECT l.feature, l.fold, sqrt(avg(pow(y - (my + kb * (b - mb) + kx * (x - mx)), 2))) AS rmse
      FROM l JOIN k ON l.feature = k.feature AND l.fold = k.fold GROUP BY ALL),
s AS (SELECT feature, avg(rmse) AS cv_rmse FROM r GROUP BY feature),
c AS (SELECT feature, count(*) FILTER (WHERE x = 0) AS n_zero, count(DISTINCT x) AS n_distinct FROM l GROUP BY feature)"""


def _feature_report(spark, base):
    li = tables(spark, base).lineitem.select(
        F.col("l_extendedprice").alias("y"), _SF_BASE, "l_discount", "l_tax", (F.lit(1.6e9) + F.col("l_partkey") % 97).alias("big"),
        (F.col("l_extendedprice") / F.col("l_quantity") + F.col("l_linenumber")).alias("price_like"),
        kfold(F.expr(_LINE_ID), 4, 4).alias("fold"))
    return li, ev.single_feature_report(li, "y", _SF_BASE, "fold", _SF_FEATURES)


@query("evl09_single_feature_report", _SF_SQL + """
SELECT feature, round(cv_rmse, 3) AS cv_rmse, n_zero, n_distinct FROM s JOIN c USING (feature) ORDER BY cv_rmse, feature
""", ("EVL-9", "AGG-17", "AGG-18", "SPL-4", "SRT-2"))
def evl09_single_feature_report(spark, base):
    return _feature_report(spark, base)[1].select("feature", r("cv_rmse", 3).alias("cv_rmse"), "n_zero", F.col("n_distinct").cast("bigint"))


_BOOST = {"rounds": 6, "rate": 0.5, "l2": 1.0, "patience": 2, "bins": 16}
_BOOST_FEATURES = ["l_discount", "l_tax", "ship_day", "unit_price"]
_DAYS_SQL = "date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))"


def _boost_sql(rows: str, features: list[str], rounds: int, rate: float, l2: float, patience: int, bins: int) -> str:
    """CTEs over ``rows`` (``fold, y, base`` and the features) that end in ``report (feature, cv_rmse, rounds)``."""
    ctes = [("l", f"SELECT * FROM {rows} UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(features)}))"),
            ("c", _cuts_sql("l", "feature", bins)), ("bl", f"SELECT 0 AS one, base AS value FROM {rows}"), ("bc", _cuts_sql("bl", "one", bins)),
            ("h", f"""SELECT feature, fold, bb, {_BIN_SQL} AS bx, count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM (
               SELECT feature, fold, y, value, {_BIN_SQL.replace('value', 'base').replace('cuts', '(SELECT cuts FROM bc)')} AS bb FROM l) LEFT JOIN c USING (feature) GROUP BY ALL"""),
            ("t", """SELECT z.feature, z.k, z.bb, z.bx, coalesce(sum(h.n), 0) AS n, coalesce(sum(h.s), 0) AS s FROM
               (SELECT DISTINCT h.feature, f.fold AS k, bb, bx FROM h, (SELECT DISTINCT fold FROM h) f) z
               LEFT JOIN h ON h.feature = z.feature AND h.bb = z.bb AND h.bx = z.bx AND h.fold <> z.k GROUP BY ALL"""),
            ("sc", """SELECT f.feature, f.fold AS k, sum(h.ss) - sum(h.s) * sum(h.s) / sum(h.n) AS scale, sum(h.s) / sum(h.n) AS m
                      FROM h JOIN (SELECT DISTINCT feature, fold FROM h) f ON h.feature = f.feature AND h.fold <> f.fold GROUP BY ALL"""),
            ("p0", "SELECT feature, k, bb, bx, n, s, m AS pred FROM t JOIN sc USING (feature, k)")]
    for d in range(rounds):
        hist = f"""(SELECT feature, k, 0 AS axis, bb AS b, sum(s - n * pred) AS r, sum(n) AS n FROM p{d} GROUP BY ALL
                    UNION ALL SELECT feature, k, 1, bx, sum(s - n * pred), sum(n) FROM p{d} GROUP BY ALL)"""
        tried, best = _splits_sql(hist, "feature, k, axis", l2, 1, "scale", "axis, b, ml")
        at = "CASE WHEN s.axis = 0 THEN p.bb ELSE p.bx END"
        ctes += [(f"y{d}", tried), (f"s{d}", best.format(tried=f"y{d}", scales="sc", on="feature, k")),
                 (f"p{d + 1}", f"""SELECT p.feature, p.k, p.bb, p.bx, p.n, p.s, p.pred + coalesce({rate} * CASE WHEN ({at} BETWEEN 0 AND s.b) OR ({at} = -1 AND s.ml)
                    THEN s.lv ELSE s.rv END, 0) AS pred FROM p{d} p LEFT JOIN s{d} s ON s.feature = p.feature AND s.k = p.k""")]
    losses = " UNION ALL ".join(f"""SELECT p.feature, p.k, {d} AS rd, round(sum(h.ss - 2 * pred * h.s + h.n * pred * pred) / sum(h.n), 12) AS loss
        FROM p{d} p JOIN h ON h.feature = p.feature AND h.bb = p.bb AND h.bx = p.bx AND h.fold = p.k GROUP BY ALL""" for d in range(rounds + 1))
    ctes += [("lo", losses),
             ("fo", "SELECT a.feature, a.k, a.rd, arg_min(b.rd, (b.loss, b.rd)) AS best FROM lo a JOIN lo b ON a.feature = b.feature AND a.k = b.k AND b.rd <= a.rd GROUP BY ALL"),
             ("ke", f"SELECT feature, k, coalesce(min(best) FILTER (WHERE rd - best >= {patience}), max(best) FILTER (WHERE rd = {rounds})) AS rd FROM fo GROUP BY ALL"),
             ("report", "SELECT feature, avg(sqrt(greatest(loss, 0))) AS cv_rmse, CAST(avg(rd) AS DOUBLE) AS rounds FROM ke JOIN lo USING (feature, k, rd) GROUP BY feature")]
    return ", ".join(f"{n} AS MATERIALIZED ({s})" for n, s in ctes)


@query("evl09_boosted_features", f"""
WITH u AS (SELECT l_extendedprice AS y, l_quantity AS base, CAST(l_discount AS DOUBLE) AS l_discount, CAST(nullif(l_tax, 0.03) AS DOUBLE) AS l_tax,
    CAST({_DAYS_SQL} AS DOUBLE) AS ship_day, CAST(round(l_extendedprice / l_quantity, 6) AS DOUBLE) AS unit_price,
    CAST(('0x' || substr(md5({_LINE_ID} || '|4'), 1, 8))::BIGINT % 4 AS INTEGER) AS fold FROM lineitem),
{_boost_sql('u', _BOOST_FEATURES, **_BOOST)}
SELECT r.feature, round(cv_rmse, 3) AS cv_rmse, round(rounds, 3) AS rounds, n_zero, n_distinct FROM report r JOIN (
  SELECT feature, count(*) FILTER (WHERE value = 0) AS n_zero, count(DISTINCT value) + max(CAST(value IS NULL AS INTEGER)) AS n_distinct FROM l GROUP BY feature) USING (feature)
ORDER BY cv_rmse, feature
""", ("EVL-9", "AGG-17", "AGG-18", "SPL-4", "SRT-2"))
def evl09_boosted_features(spark, base):
    """How well the price is told by quantity and one more column, each by boosted stumps over four folds."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    li = tables(spark, base).lineitem.select(
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("base"), "l_discount", F.nullif("l_tax", F.lit(0.03)).alias("l_tax"),
        day.cast("double").alias("ship_day"), F.round(F.col("l_extendedprice") / F.col("l_quantity"), 6).alias("unit_price"), kfold(F.expr(_LINE_ID), 4, 4).alias("fold"))
    rep = ev.boosted_feature_report(li, "y", "base", "fold", _BOOST_FEATURES, **_BOOST)
    return rep.select("feature", r("cv_rmse", 3).alias("cv_rmse"), r("rounds", 3).alias("rounds"), "n_zero", F.col("n_distinct").cast("bigint"))


@query("flt06_good_features", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / l_quantity + l_linenumber + 1e-9, 6) AS price_like FROM lineitem
""", ("FLT-6",))
def flt06_good_features(spark, base):
    """The table cut down to the features whose score beats a limit, here 97 % of the worst feature's RMSE."""
    li, report = _feature_report(spark, base)
    worst = report.agg(F.max("cv_rmse")).first()[0]
    good = ev.good_features(report, 0.97 * worst)
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    t = tables(spark, base).lineitem.withColumn("big", F.lit(1.6e9) + F.col("l_partkey") % 97) \
        .withColumn("price_like", F.col("l_extendedprice") / F.col("l_quantity") + F.col("l_linenumber"))
    return rounded(t.select(*key, *[(F.col(c) + 1e-9).alias(c) for c in good]))  # off rounding ties, as in the SQL


# ---------------------------------------------------------------- lag-key leak (LEK-*)
_ARR_SQL = "[" + ", ".join(LEAK_COLS) + "]"
_LEAK_BASE_SQL = f"""m AS ({DAY_MATRIX_SQL}),
a AS (SELECT user_id, target, {_ARR_SQL} AS arr FROM m),
lags AS (SELECT unnest(range(0, {N_LAGS})) AS "lag"),
lk AS (SELECT user_id, "lag", arr[1:{len(LEAK_COLS)} - "lag" - 2] AS key FROM a, lags),
rk AS (SELECT "lag", arr["lag" + 3:{len(LEAK_COLS)}] AS key, arr["lag" + 1] AS pred FROM a, lags),
ru AS (SELECT "lag", key, min(pred) AS pred FROM rk GROUP BY "lag", key HAVING count(*) = 1),
mt AS (SELECT user_id, "lag", pred FROM lk JOIN ru USING ("lag", key))"""


@query("lek01_lag_matches", f"WITH {_LEAK_BASE_SQL} SELECT user_id, CAST(\"lag\" AS INTEGER) AS lag, pred FROM mt",
       ("LEK-1", "JN-7", "WIN-8", "ARR-3"))
def lek01_lag_matches(spark, base):
    return rounded(lk.lag_matches(day_matrix(spark, base), "user_id", LEAK_COLS))


_LEAK_ROWS_SQL = f"""{_LEAK_BASE_SQL},
f AS (SELECT user_id, min("lag") AS first_lag, arg_min(pred, "lag") AS leak FROM mt WHERE pred <> 0 GROUP BY user_id),
nz AS (SELECT user_id, exp(avg(ln(1 + x)) FILTER (WHERE x <> 0)) - 1 AS nzm FROM (SELECT user_id, unnest(arr) AS x FROM a) GROUP BY user_id),
rw AS (SELECT a.user_id, target, coalesce(first_lag, {N_LAGS}) AS f, leak, nzm FROM a LEFT JOIN f USING (user_id) JOIN nz USING (user_id))"""


@query("lek02_leak_lag_stats", f"""WITH {_LEAK_ROWS_SQL}
SELECT CAST(l."lag" AS INTEGER) AS lag, count(*) FILTER (WHERE f <= l."lag" AND leak > 0) AS leaky_count,
  round((count(*) FILTER (WHERE f <= l."lag" AND leak = target) + count(*) FILTER (WHERE f > l."lag" AND target = 0))
        / nullif(count(*) FILTER (WHERE f <= l."lag" AND leak > 0), 0), 6) AS leaky_correct,
  round(sqrt(avg(pow(ln(1 + target) - CASE WHEN f < l."lag" THEN coalesce(ln(1 + leak), 14.49)
                                          ELSE coalesce(ln(1 + nzm), 14.49) END, 2))), 6) AS score
FROM rw, lags l GROUP BY l."lag"
""", ("LEK-2", "Q9", "ARR-2", "EVL-5", "FLT-7"))
def lek02_leak_lag_stats(spark, base):
    return rounded(lk.leak_lag_stats(day_matrix(spark, base), "user_id", "target", LEAK_COLS))


@query("lek03_best_lag_rewrite", f"""WITH {_LEAK_ROWS_SQL},
st AS (SELECT l."lag" AS lg, sqrt(avg(pow(ln(1 + target) - CASE WHEN f < l."lag" THEN coalesce(ln(1 + leak), 14.49)
                                          ELSE coalesce(ln(1 + nzm), 14.49) END, 2))) AS score FROM rw, lags l GROUP BY l."lag"),
b AS (SELECT arg_min(lg, (score, lg)) AS best FROM st)
SELECT user_id, CAST(best AS INTEGER) AS best_lag, round(CASE WHEN f < best THEN nullif(leak, 0) END, 6) AS compiled_leak,
  round(coalesce(CASE WHEN f < best THEN nullif(leak, 0) END, nzm), 6) AS final_estimate
FROM rw, b
""", ("LEK-3", "LEK-4", "SRT-6"))
def lek03_best_lag_rewrite(spark, base):
    m = materialize(day_matrix(spark, base))
    rows = materialize(lk.compile_leak(m, "user_id", LEAK_COLS))  # matched once, for the statistics and the rewrite
    best = lk.best_lag(lk.leak_lag_stats(rows, "user_id", "target", LEAK_COLS, compiled=True)).first()["best_lag"]  # one row
    comp = lk.rewrite_leak(rows, "user_id", LEAK_COLS, best, compiled=True, keep=[nonzero_row_mean(pack(LEAK_COLS)).alias("nzm")])
    return rounded(comp.select("user_id", F.lit(best).cast("int").alias("best_lag"), "compiled_leak",
                               lk.override("nzm", "compiled_leak").alias("final_estimate")))


@query("mdl07_novelty", f"""
WITH s AS ({_SCORED_SQL}),
n AS (SELECT avg(n_chars) AS m1, stddev_samp(n_chars) AS s1, avg(quality) AS m2, stddev_samp(quality) AS s2 FROM s WHERE toxic = 0),
d AS (SELECT toxic, pow((n_chars - m1) / s1, 2) + pow((quality - m2) / s2, 2) AS dist FROM s, n),
t AS (SELECT quantile_cont(dist, 0.9) AS thr FROM d WHERE toxic = 0)
SELECT toxic, count(*) AS n, count(*) FILTER (WHERE dist > thr) AS n_flagged FROM d, t GROUP BY toxic
""", ("MDL-7", "SPL-8", "FLT-7"))
def mdl07_novelty(spark, base):
    s = _scored(spark, base)
    scored = ev.novelty_score(s, s.where(F.col("toxic") == 0), ["n_chars", "quality"], 0.9)
    return scored.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("flagged") == 1).alias("n_flagged"))


@query("mdl12_blend", """
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount AS s1 FROM lineitem),
b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax AS s2 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(0.2 * s1 + 0.8 * s2, 6) AS blended
FROM a JOIN b USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
""", ("MDL-12", "SCL-6", "JN-10", "SNK-2"))
def mdl12_blend(spark, base):
    li = tables(spark, base).lineitem
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    a = li.select(*key, F.col("l_discount").alias("s1"))
    b = li.select(*key, F.col("l_tax").alias("s2"))
    return rounded(a.join(b, key).select(*key, ev.blend(["s1", "s2"], [0.2, 0.8]).alias("blended")))
