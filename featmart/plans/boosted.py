"""Queries over boosted trees (MDL-1, 2, 9, 10, 11). They return predictions; the oracles grow the same trees in SQL."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from featmart.operators import boosting
from featmart.operators.split import BUCKETS, group_kfold, kfold, split_flag
from featmart.plans.registry import query, rounded
from featmart.session import materialize
from featmart.sources import tables


# ---- the oracle ---------------------------------------------------------------------------------
def boosted_sql(name: str, rows: str, features: list[str], objective: str = "squared", rounds: int = 20, depth: int = 3, rate: float = 0.1,
                l2: float = 1.0, min_rows: int = 1, bins: int = 64, train: str = "TRUE", held: str = "FALSE", patience: int | None = None) -> str:
    """CTEs that boost over ``rows`` (a CTE with ``id``, ``y`` and the features) and end in ``<name>`` with ``id`` and
    ``score`` for all its rows; ``train`` and ``held`` are conditions over its columns."""
    n = itertools.count()
    ctes = []

    def cte(sql: str) -> str:
        ctes.append((f"{name}_{next(n)}", sql))
        return ctes[-1][0]

    d = cte(f"SELECT id, y, ({train}) AND NOT ({held}) AS fits, ({train}) AND ({held}) AS stops, {', '.join(features)} FROM {rows}")
    cells = cte(" UNION ALL ".join(f"SELECT id, fits, {i} AS f, CAST({c} AS DOUBLE) AS v FROM {d}" for i, c in enumerate(features)))
    ranked = cte(f"""SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS rn, count(*) OVER (PARTITION BY f) AS n,
                       max(v) OVER (PARTITION BY f) AS hi FROM {cells} WHERE v IS NOT NULL AND fits""")
    cuts = cte(f"""SELECT f, list_sort(list(DISTINCT v)) AS cuts FROM {ranked}
                   WHERE v < hi AND list_contains(list_transform(range(1, {bins}), lambda j: (j * n + {bins - 1}) // {bins}), rn) GROUP BY f""")
    binned = cte(f"""SELECT id, c.f, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(coalesce(cuts, []), lambda x: x < v)) END AS b
                     FROM {cells} c LEFT JOIN {cuts} k ON c.f = k.f""")
    base = cte(f"SELECT avg(y) AS m, var_pop(y) * count(*) AS scale FROM {d} WHERE fits")
    start = "ln(m / (1 - m))" if objective == "logistic" else "m"
    score = cte(f"SELECT id, y, fits, stops, {start} AS score FROM {d}, {base}")
    scores = [score]
    p = "1 / (1 + exp(-score))"
    g, h = (f"({p}) - y", f"({p}) * (1 - {p})") if objective == "logistic" else ("score - y", "1.0")
    for _ in range(rounds):
        graded = cte(f"SELECT id, fits, {g} AS g, {h} AS h FROM {score}")
        node = cte(f"SELECT id, 1 AS node, CAST(0 AS DOUBLE) AS value FROM {graded}")
        for level in range(depth):
            hist = cte(f"""SELECT node, f, b, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {node} JOIN {graded} USING (id) JOIN {binned} USING (id)
                           WHERE fits AND node >= {2 ** level} GROUP BY ALL""")
            sums = cte("SELECT node, f, b, " + ", ".join(
                f"sum({c}) OVER (PARTITION BY node, f) AS a{c}, coalesce(sum({c}) FILTER (WHERE b < 0) OVER (PARTITION BY node, f), 0) AS m{c}, "
                f"sum(CASE WHEN b >= 0 THEN {c} ELSE 0 END) OVER (PARTITION BY node, f ORDER BY b) AS u{c}" for c in "ghn") + f" FROM {hist}")
            tried = cte("SELECT node, f, b, ml, ag, ah, " + ", ".join(
                f"u{c} + CASE WHEN ml THEN m{c} ELSE 0 END AS l{c}, a{c} - (u{c} + CASE WHEN ml THEN m{c} ELSE 0 END) AS r{c}" for c in "ghn")
                + f" FROM {sums}, (VALUES (FALSE), (TRUE)) t(ml) WHERE b >= 0 AND (NOT ml OR mn > 0)")
            worth = f"round((lg * lg / (lh + {l2}) + rg * rg / (rh + {l2}) - ag * ag / (ah + {l2})) / scale, 12)"
            best = cte(f"""SELECT * FROM (SELECT t.*, {worth} AS worth FROM {tried} t, {base} WHERE ln >= {min_rows} AND rn >= {min_rows}) WHERE worth > 0
                           QUALIFY row_number() OVER (PARTITION BY node ORDER BY worth DESC, f, b, ml) = 1""")
            left = "(k.b BETWEEN 0 AND s.b OR (k.b = -1 AND s.ml))"
            node = cte(f"""SELECT o.id, CASE WHEN s.node IS NULL THEN o.node WHEN {left} THEN 2 * o.node ELSE 2 * o.node + 1 END AS node,
                             CASE WHEN s.node IS NULL THEN o.value WHEN {left} THEN -{rate} * s.lg / (s.lh + {l2}) ELSE -{rate} * s.rg / (s.rh + {l2}) END AS value
                           FROM {node} o LEFT JOIN {best} s ON o.node = s.node LEFT JOIN {binned} k ON k.id = o.id AND k.f = s.f""")
        score = cte(f"SELECT s.id, y, fits, stops, score + value AS score FROM {score} s JOIN {node} v ON s.id = v.id")
        scores.append(score)
    if patience:
        loss = "ln(1 + exp(-abs(score))) + greatest(score, 0) - y * score" if objective == "logistic" else "(score - y) * (score - y)"
        losses = cte(" UNION ALL ".join(f"SELECT {r} AS r, round(avg({loss}), 12) AS loss FROM {s} WHERE stops" for r, s in enumerate(scores) if r))
        sofar = cte(f"SELECT a.r, arg_min(b.r, (b.loss, b.r)) AS best FROM {losses} a JOIN {losses} b ON b.r <= a.r GROUP BY a.r")
        # the first round that is too far behind its best ends the rounds
        kept = cte(f"SELECT coalesce(min(best) FILTER (WHERE r - best >= {patience}), max(best) FILTER (WHERE r = {rounds})) AS best FROM {sofar}")
        score = cte(" UNION ALL ".join(f"SELECT id, score FROM {s}, {kept} WHERE best = {r}" for r, s in enumerate(scores)))
    ctes.append((name, f"SELECT id, score FROM {score}"))
    return ", ".join(f"{c} AS MATERIALIZED ({sql})" for c, sql in ctes)


def _hash_sql(key: str, seed: int) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT"


def _share_sql(key: str, seed: int, share: float) -> str:
    return f"{_hash_sql(key, seed)} % {BUCKETS} < {share} * {BUCKETS}"


# ---- customers: branches that many customers do not have ----------------------------------------
_CUSTOMER_FEATURES = ["c_acctbal", "filled_mean", "filled_n", "open_mean", "open_n", "urgent_n"]
_CUSTOMERS_SQL = """rows AS MATERIALIZED (
  SELECT c_custkey AS id, c_acctbal, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS filled_mean,
    nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS filled_n, round(avg(o_totalprice) FILTER (WHERE o_orderstatus <> 'F'), 4) AS open_mean,
    nullif(count(*) FILTER (WHERE o_orderstatus <> 'F'), 0) AS open_n, nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS urgent_n,
    round(ln(1 + coalesce(sum(o_totalprice), 0)), 9) AS y
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal)"""


def _customers(spark, base):
    t = tables(spark, base)
    filled, price = F.col("o_orderstatus") == "F", F.col("o_totalprice")
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.avg(F.when(filled, price)), 4).alias("filled_mean"), F.nullif(F.count_if(filled), F.lit(0)).alias("filled_n"),
        F.round(F.avg(F.when(~filled, price)), 4).alias("open_mean"), F.nullif(F.count_if(~filled), F.lit(0)).alias("open_n"),
        F.nullif(F.count_if(F.col("o_orderpriority") == "1-URGENT"), F.lit(0)).alias("urgent_n"), F.sum(price).alias("total"))
    return t.customer.select("c_custkey", "c_acctbal").join(per, "c_custkey", "left") \
        .withColumn("y", F.round(F.log1p(F.coalesce("total", F.lit(0.0))), 9)).drop("total")


_MISSING = {"rounds": 4, "depth": 3, "rate": 0.5, "bins": 32}


@query("mdl01_gbt_missing", f"WITH {_CUSTOMERS_SQL}, {boosted_sql('m', 'rows', _CUSTOMER_FEATURES, **_MISSING)}"
       " SELECT id AS c_custkey, round(y, 6) AS y, round(score, 6) AS prediction FROM rows JOIN m USING (id)", ("MDL-1", "MDL-2", "MDL-14", "MDL-15"))
def mdl01_gbt_missing(spark, base):
    """Spending of customers, many of whom miss some branch of their orders: missing values learn their side."""
    rows = materialize(_customers(spark, base))
    return rounded(boosting.fit(rows, _CUSTOMER_FEATURES, "y", **_MISSING).predict(rows).select("c_custkey", "y", "prediction"))


_ORDER_FEATURES = [c for c in _CUSTOMER_FEATURES if c != "c_acctbal"]
_STOPPED = {"rounds": 4, "depth": 2, "rate": 0.9, "l2": 0.0, "bins": 64, "patience": 2}


@query("mdl09_patience", f"WITH {_CUSTOMERS_SQL}, balance AS MATERIALIZED (SELECT * REPLACE (c_acctbal AS y) FROM rows), "
       + boosted_sql("m", "balance", _ORDER_FEATURES, train=f"NOT ({_share_sql('id', 31, 0.25)})", held=_share_sql("id", 131, 0.3), **_STOPPED)
       + f" SELECT id AS c_custkey, round(y, 6) AS y, round(score, 6) AS prediction FROM balance JOIN m USING (id) WHERE {_share_sql('id', 31, 0.25)}",
       ("MDL-9", "SPL-2"))
def mdl09_patience(spark, base):
    """Balances, which orders hardly tell: a third split ends the rounds when its loss has not fallen for two of them.
    The rows scored are in neither part."""
    rows = _customers(spark, base).withColumn("y", F.col("c_acctbal"))
    rows = materialize(rows.withColumn("is_valid", split_flag("c_custkey", 0.25, 31)).withColumn("is_es", split_flag("c_custkey", 0.3, 131)))
    model = boosting.fit(rows.where(~F.col("is_valid")), _ORDER_FEATURES, "y", valid="is_es", **_STOPPED)
    return rounded(model.predict(rows.where("is_valid")).select("c_custkey", "y", "prediction"))


# ---- out-of-fold predictions and stacks ---------------------------------------------------------
def _folds_sql(rows: str, source: str, features: list[str], k: int, fit: str = "TRUE", **params) -> str:
    """``id, fold, p0..``: every row's score under each fold's model. ``source`` holds the CTEs that define ``rows``."""
    parts = [f"(WITH {source}, {boosted_sql('m', rows, features, train=f'({fit}) AND fold <> {f}', **params)} SELECT id, score AS p{f} FROM m) f{f}" for f in range(k)]
    return (f"SELECT r.*, {', '.join(f'p{f}' for f in range(k))} FROM (WITH {source} SELECT * FROM {rows}) r "
            + " ".join(f"JOIN {p} ON f{f}.id = r.id" for f, p in enumerate(parts)))


def _own_sql(k: int) -> str:
    return "CASE fold " + " ".join(f"WHEN {f} THEN p{f}" for f in range(k)) + " END"


_USER_FEATURES = ["n_events", "value_mean", "n_days", "n_purchases"]
_USERS_SQL = f"""rows AS MATERIALIZED (
  SELECT user_id AS id, count(*) AS n_events, round(avg(value), 6) AS value_mean, count(DISTINCT CAST(ts AS DATE)) AS n_days,
    nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS n_purchases,
    round(ln(1 + coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0.0)), 9) AS y, CAST({_hash_sql('user_id', 2)} % 3 AS INTEGER) AS fold
  FROM events GROUP BY user_id)"""


def _users(spark, base):
    buys = F.col("event_type") == "purchase"
    return tables(spark, base).events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.avg("value"), 6).alias("value_mean"), F.count_distinct(F.to_date("ts")).alias("n_days"),
        F.nullif(F.count_if(buys), F.lit(0)).alias("n_purchases"),
        F.round(F.log1p(F.coalesce(F.sum(F.when(buys, F.col("value"))), F.lit(0.0))), 9).alias("y"))


_OOF = {"rounds": 3, "depth": 2, "rate": 0.5, "bins": 32}


@query("mdl02_gbt_oof", f"""
SELECT id AS user_id, round(y, 6) AS y, CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS part, CASE WHEN id % 5 <> 0 THEN fold END AS fold,
  round(CASE WHEN id % 5 = 0 THEN (p0 + p1 + p2) / 3 ELSE {_own_sql(3)} END, 6) AS prediction
FROM ({_folds_sql('rows', _USERS_SQL, _USER_FEATURES, 3, 'id % 5 <> 0', **_OOF)})
""", ("MDL-2", "MDL-10", "SPL-5", "EVL-5"))
def mdl02_gbt_oof(spark, base):
    """Every training user is predicted once, by the model of the folds without it; test users get the mean of the
    folds' predictions."""
    df = materialize(_users(spark, base).withColumn("fold", kfold("user_id", 3, 2)).withColumn("is_test", F.col("user_id") % 5 == 0))
    out = boosting.out_of_fold(df, _USER_FEATURES, "y", "fold", 3, test="is_test", **_OOF)
    return rounded(out.select("user_id", "y", F.when(F.col("is_test"), "test").otherwise("train").alias("part"),
                              F.when(~F.col("is_test"), F.col("fold")).cast("int").alias("fold"), "prediction"))


_EVENT_FEATURES = ["hour", "weekday", "is_purchase"]
_EVENTS_SQL = f"""events_ AS MATERIALIZED (
  SELECT event_id AS id, user_id, hour(ts) AS hour, dayofweek(ts) + 1 AS weekday, CAST(event_type = 'purchase' AS INTEGER) AS is_purchase,
    CASE WHEN event_type = 'purchase' THEN round(ln(1 + value), 9) ELSE 0.0 END AS y, CAST({_hash_sql('user_id', 21)} % 3 AS INTEGER) AS fold FROM events)"""
_LEVEL1 = {"rounds": 2, "depth": 2, "rate": 0.7, "bins": 24}
_STACK_FEATURES = ["n_events", "value_mean", "n_days", "sum_of_logs", "log_of_sum", "mean_pred"]
#: The two models of the second level and their weights in the blend.
_PAIR = [({"rounds": 2, "depth": 2, "rate": 0.8, "bins": 32}, 0.6), ({"rounds": 3, "depth": 1, "rate": 0.5, "bins": 16}, 0.4)]
_STACK_SQL = f"""level1 AS MATERIALIZED (SELECT user_id, {_own_sql(3)} AS p FROM ({_folds_sql('events_', _EVENTS_SQL, _EVENT_FEATURES, 3, **_LEVEL1)})),
rolled AS MATERIALIZED (SELECT user_id, round(sum(p), 6) AS sum_of_logs, round(ln(1 + sum(exp(greatest(p, 0.0)) - 1)), 6) AS log_of_sum,
  round(avg(p), 6) AS mean_pred FROM level1 GROUP BY user_id),
{_USERS_SQL},
users AS MATERIALIZED (SELECT id, n_events, value_mean, n_days, sum_of_logs, log_of_sum, mean_pred, y, CAST({_hash_sql('id', 21)} % 3 AS INTEGER) AS fold
  FROM rows JOIN rolled ON id = user_id)"""


@query("mdl11_two_level_stack", f"""
SELECT a.id AS user_id, round(a.y, 6) AS y, a.fold, round(0.6 * a.p + 0.4 * b.p, 6) AS prediction FROM
  (SELECT id, y, fold, {_own_sql(3)} AS p FROM ({_folds_sql('users', _STACK_SQL, _STACK_FEATURES, 3, **_PAIR[0][0])})) a JOIN
  (SELECT id, {_own_sql(3)} AS p FROM ({_folds_sql('users', _STACK_SQL, _STACK_FEATURES, 3, **_PAIR[1][0])})) b ON a.id = b.id
""", ("MDL-11", "MDL-10", "MDL-12", "AGG-14", "AGG-15", "SPL-5"))
def mdl11_two_level_stack(spark, base):
    """Level one predicts each event's log revenue out of fold, folds grouped by user; its predictions, rolled up per
    user (sum of logs, log of sum, mean), join the user's own features for a pair of second-level models, again
    out of fold, that are blended 0.6 to 0.4."""
    buys = F.col("event_type") == "purchase"
    e = materialize(tables(spark, base).events.select(
        "user_id", F.hour("ts").alias("hour"), F.dayofweek("ts").alias("weekday"), buys.cast("int").alias("is_purchase"),
        F.when(buys, F.round(F.log1p("value"), 9)).otherwise(0.0).alias("y")).withColumn("fold", group_kfold("user_id", 3, 21)))
    p = F.col("prediction")
    rolled = boosting.out_of_fold(e, _EVENT_FEATURES, "y", "fold", 3, **_LEVEL1).groupBy("user_id").agg(
        F.round(F.sum(p), 6).alias("sum_of_logs"), F.round(F.log1p(F.sum(F.exp(F.greatest(p, F.lit(0.0))) - 1)), 6).alias("log_of_sum"),
        F.round(F.avg(p), 6).alias("mean_pred"))
    users = materialize(_users(spark, base).drop("n_purchases").join(rolled, "user_id").withColumn("fold", group_kfold("user_id", 3, 21)))
    out = users
    for i, (params, _) in enumerate(_PAIR):
        out = boosting.out_of_fold(out, _STACK_FEATURES, "y", "fold", 3, out=f"p{i}", **params)
    blended = sum((F.col(f"p{i}") * w for i, (_, w) in enumerate(_PAIR)), F.lit(0.0))
    return rounded(out.select("user_id", "y", F.col("fold").cast("int").alias("fold"), blended.alias("prediction")))


# ---- documents: a yes-or-no label ---------------------------------------------------------------
_DOC_FEATURES = ["n_chars", "upper_share", "digit_share", "n_lines", "lang_en"]
_DOCS_SQL = """rows AS MATERIALIZED (
  SELECT doc_id AS id, n_chars, round(length(regexp_replace(text, '[^A-Z]', '', 'g')) / greatest(length(text), 1), 9) AS upper_share,
    round(length(regexp_replace(text, '[^0-9]', '', 'g')) / greatest(length(text), 1), 9) AS digit_share,
    length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines, CAST(lang = 'en' AS INTEGER) AS lang_en, CAST(quality AS DOUBLE) AS y
  FROM labels JOIN documents USING (doc_id))"""
_NOT_HELD = f"NOT ({_share_sql('id', 11, 0.25)})"
_BINARY = {"objective": "logistic", "rounds": 3, "depth": 2, "rate": 0.5, "bins": 32, "min_rows": 5}


@query("mdl01_gbt_binary", f"WITH {_DOCS_SQL}, {boosted_sql('m', 'rows', _DOC_FEATURES, train=_NOT_HELD, **_BINARY)}"
       f" SELECT id AS doc_id, CAST(y AS BIGINT) AS quality, round(1 / (1 + exp(-score)), 6) AS p1, CAST(score > 0 AS INTEGER) AS prediction"
       f" FROM rows JOIN m USING (id) WHERE {_share_sql('id', 11, 0.25)}", ("MDL-1", "MDL-14", "MDL-15", "SPL-1", "SCL-9"))
def mdl01_gbt_binary(spark, base):
    """The probability of good quality for held-out documents, and the class it gives."""
    t = tables(spark, base)
    size = F.greatest(F.char_length("text"), F.lit(1))
    d = t.labels.select("doc_id", F.col("quality").cast("bigint").alias("quality")).join(t.documents.select(
        "doc_id", "n_chars", F.round(F.char_length(F.regexp_replace("text", "[^A-Z]", "")) / size, 9).alias("upper_share"),
        F.round(F.char_length(F.regexp_replace("text", "[^0-9]", "")) / size, 9).alias("digit_share"),
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        (F.col("lang") == "en").cast("int").alias("lang_en")), "doc_id").withColumn("is_valid", split_flag("doc_id", 0.25, 11))
    rows = materialize(d)
    model = boosting.fit(rows.where(~F.col("is_valid")), _DOC_FEATURES, "quality", **_BINARY)
    out = model.predict(rows.where("is_valid"), "p1")
    return rounded(out.select("doc_id", "quality", "p1", (F.col("p1") > 0.5).cast("int").alias("prediction")))
