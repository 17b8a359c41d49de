"""Column profiling, pruning, encodings, binning, scaling and splits on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from featmart.functions.scalar import argmax_index, one_hot_vector, threshold, zero_to_null
from featmart.operators import encode as enc
from featmart.operators import profile as prof
from featmart.operators import split as spl
from featmart.plans.registry import query, rounded
from featmart.sources import tables

_LI_PROFILE = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _lineitem_with_nulls(spark, base):
    li = tables(spark, base).lineitem
    return li.select("l_quantity", zero_to_null("l_discount").alias("l_discount"), zero_to_null("l_tax").alias("l_tax"),
                     "l_returnflag", "l_linestatus", "l_shipdate")


_LI_NULLS_SQL = ("SELECT l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, "
                 "l_returnflag, l_linestatus, l_shipdate FROM lineitem")


@query("agg19_null_zero_report", f"""
WITH t AS ({_LI_NULLS_SQL})
SELECT * FROM (
  SELECT 'l_quantity' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE l_quantity IS NULL) AS n_null,
    round(count(*) FILTER (WHERE l_quantity IS NULL) / count(*), 6) AS null_rate, count(*) FILTER (WHERE l_quantity = 0) AS n_zero FROM t
  UNION ALL SELECT 'l_discount', count(*), count(*) FILTER (WHERE l_discount IS NULL),
    round(count(*) FILTER (WHERE l_discount IS NULL) / count(*), 6), count(*) FILTER (WHERE l_discount = 0) FROM t
  UNION ALL SELECT 'l_tax', count(*), count(*) FILTER (WHERE l_tax IS NULL),
    round(count(*) FILTER (WHERE l_tax IS NULL) / count(*), 6), count(*) FILTER (WHERE l_tax = 0) FROM t
  UNION ALL SELECT 'l_returnflag', count(*), count(*) FILTER (WHERE l_returnflag IS NULL),
    round(count(*) FILTER (WHERE l_returnflag IS NULL) / count(*), 6), 0 FROM t
  UNION ALL SELECT 'l_linestatus', count(*), count(*) FILTER (WHERE l_linestatus IS NULL),
    round(count(*) FILTER (WHERE l_linestatus IS NULL) / count(*), 6), 0 FROM t
  UNION ALL SELECT 'l_shipdate', count(*), count(*) FILTER (WHERE l_shipdate IS NULL),
    round(count(*) FILTER (WHERE l_shipdate IS NULL) / count(*), 6), 0 FROM t)
""", ("AGG-18", "AGG-19", "NUL-3"))
def agg19_null_zero_report(spark, base):
    return rounded(prof.null_zero_report(_lineitem_with_nulls(spark, base), _LI_PROFILE))


@query("agg17_distinct_report", f"""
WITH t AS ({_LI_NULLS_SQL})
SELECT 'l_quantity' AS "column", count(DISTINCT l_quantity) + max(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM t
UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) + max(CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END) FROM t
UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) + max(CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END) FROM t
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) + max(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END) FROM t
UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) + max(CASE WHEN l_linestatus IS NULL THEN 1 ELSE 0 END) FROM t
UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) + max(CASE WHEN l_shipdate IS NULL THEN 1 ELSE 0 END) FROM t
""", ("AGG-17",))
def agg17_distinct_report(spark, base):
    rep = prof.distinct_report(_lineitem_with_nulls(spark, base), _LI_PROFILE)
    return rep.withColumn("n_distinct", F.col("n_distinct").cast("bigint"))


@query("prn_prune_report", f"""
WITH t AS ({_LI_NULLS_SQL}),
d AS (
  SELECT 'l_quantity' AS "column", count(DISTINCT l_quantity) + max(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END) AS nd,
         count(*) FILTER (WHERE l_quantity IS NULL) / count(*) AS nr, var_pop(l_quantity) AS vp FROM t
  UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) + max(CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END),
         count(*) FILTER (WHERE l_discount IS NULL) / count(*), var_pop(l_discount) FROM t
  UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) + max(CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END),
         count(*) FILTER (WHERE l_tax IS NULL) / count(*), var_pop(l_tax) FROM t
  UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) + max(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END),
         count(*) FILTER (WHERE l_returnflag IS NULL) / count(*), NULL FROM t
  UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) + max(CASE WHEN l_linestatus IS NULL THEN 1 ELSE 0 END),
         count(*) FILTER (WHERE l_linestatus IS NULL) / count(*), NULL FROM t
  UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) + max(CASE WHEN l_shipdate IS NULL THEN 1 ELSE 0 END),
         count(*) FILTER (WHERE l_shipdate IS NULL) / count(*), NULL FROM t)
SELECT "column", nd > 1 AS keep_not_constant, nr < 0.03 AS keep_null_rate,
       CASE WHEN vp IS NULL THEN NULL ELSE vp > 0.02 END AS keep_variance FROM d
""", ("PRN-1", "PRN-2", "PRN-3", "PRN-4", "PRJ-9", "PRJ-13"))
def prn_prune_report(spark, base):
    """Keep decisions of the three pruning rules for every column (null-rate limit 0.03 so the
    derived nulls of ``l_tax`` trip it). Every rule is one aggregate job over the table."""
    df = _lineitem_with_nulls(spark, base)
    numeric = ["l_quantity", "l_discount", "l_tax"]
    const = set(prof.constant_columns(df, _LI_PROFILE))
    keep_null = set(prof.null_rate_keep(df, _LI_PROFILE, 0.03))
    keep_var = set(prof.variance_keep(df, numeric, 0.02))
    rows = [(c, c not in const, c in keep_null, (c in keep_var) if c in numeric else None) for c in _LI_PROFILE]
    return spark.createDataFrame(rows, "column string, keep_not_constant boolean, keep_null_rate boolean, "
                                       "keep_variance boolean")


@query("agg21_mode", """
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS rn FROM c),
b AS (SELECT c_nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS b, count(*) AS n FROM customer GROUP BY 1, 2),
rb AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, b) AS rn FROM b)
SELECT r.c_nationkey, c_mktsegment AS c_mktsegment_mode, rb.b AS acctbal_k_mode
FROM r JOIN rb ON r.c_nationkey = rb.c_nationkey AND rb.rn = 1 WHERE r.rn = 1
""", ("AGG-21",))
def agg21_mode(spark, base):
    c = tables(spark, base).customer.withColumn("acctbal_k", F.floor(F.col("c_acctbal") / 1000).cast("bigint"))
    return prof.group_modes(c, ["c_nationkey"], ["c_mktsegment", "acctbal_k"])


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("agg22_corr_matrix", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _CORR_COLS for b in _CORR_COLS) + ")", ("AGG-22",))
def agg22_corr_matrix(spark, base):
    return rounded(prof.corr_matrix(tables(spark, base).lineitem, _CORR_COLS))


@query("agg23_histogram", """
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 25)) AS INTEGER), 24) AS bin FROM lineitem, mm),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(25))
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 25), 6) AS "left", round(lo + (g.bin + 1) * ((hi - lo) / 25), 6) AS "right",
  coalesce(n, 0) AS count,
  round(coalesce(n, 0) / ((SELECT count(*) FROM lineitem) * ((hi - lo) / 25)), 6) AS density
FROM g LEFT JOIN c ON g.bin = c.bin, mm
""", ("AGG-23",))
def agg23_histogram(spark, base):
    return rounded(prof.equal_width_histogram(tables(spark, base).lineitem, "l_extendedprice", 25, density=True))


def _bin_counts(df, col, edges):
    b = df.select(enc.bin_index(col, edges).alias("bin"))
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n_rows"))


def _bins_sql(probs: str) -> str:
    return f"""
WITH q AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice, {probs}))) AS e FROM lineitem),
b AS (SELECT CASE WHEN l_extendedprice = e[1] THEN 0
                  WHEN l_extendedprice < e[1] OR l_extendedprice > e[len(e)] THEN NULL
                  ELSE least(len(list_filter(e, lambda x: x < l_extendedprice)) - 1, len(e) - 2) END AS bin
      FROM lineitem, q)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n_rows FROM b GROUP BY bin
"""


@query("bin01_quantile_bins", _bins_sql("[0, 0.25, 0.5, 0.75, 1.0]"), ("BIN-1",))
def bin01_quantile_bins(spark, base):
    li = tables(spark, base).lineitem
    edges = enc.quantile_edges(li, "l_extendedprice", [0, .25, .5, .75, 1.])
    return _bin_counts(li, "l_extendedprice", edges)


@query("bin02_decile_bins", _bins_sql("[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.10]"), ("BIN-2", "Q5"))
def bin02_decile_bins(spark, base):
    li = tables(spark, base).lineitem
    edges = enc.quantile_edges(li, "l_extendedprice", [.1, .2, .3, .4, .5, .6, .7, .8, .9, .10])
    return _bin_counts(li, "l_extendedprice", edges)


@query("bin03_equal_width", """
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
e AS (SELECT [lo - (hi - lo) * 0.001, lo + (hi - lo) / 4, lo + 2 * (hi - lo) / 4, lo + 3 * (hi - lo) / 4, hi] AS e FROM mm),
b AS (SELECT CASE WHEN o_totalprice = e[1] THEN 0 WHEN o_totalprice < e[1] OR o_totalprice > e[5] THEN NULL
                  ELSE least(len(list_filter(e, lambda x: x < o_totalprice)) - 1, 3) END AS bin FROM orders, e)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n_rows FROM b GROUP BY bin
""", ("BIN-3",))
def bin03_equal_width(spark, base):
    o = tables(spark, base).orders
    return _bin_counts(o, "o_totalprice", enc.equal_width_edges(o, "o_totalprice", 4))


@query("enc01_label_codes", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY coalesce(p_type, 'nan')) - 1 AS BIGINT) AS p_type_code FROM part
""", ("ENC-1", "D11"))
def enc01_label_codes(spark, base):
    p = tables(spark, base).part.select("p_partkey", "p_type")
    d = enc.label_dictionary(p, "p_type")
    return enc.apply_dictionary(p, "p_type", d, "p_type_code").select("p_partkey", "p_type_code")


@query("enc02_label_codes_union", """
WITH u AS (SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
           UNION ALL SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
l AS (SELECT DISTINCT 'o_orderstatus' AS "column", coalesce(o_orderstatus, 'nan') AS value FROM u
      UNION SELECT DISTINCT 'o_orderpriority', coalesce(o_orderpriority, 'nan') FROM u)
SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS BIGINT) AS code FROM l
""", ("ENC-2", "SET-1", "SET-3"))
def enc02_label_codes_union(spark, base):
    o = tables(spark, base).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    cols = ["o_orderstatus", "o_orderpriority"]
    u = o.where(F.col("o_orderdate") < cut).select(*cols).unionByName(o.where(F.col("o_orderdate") >= cut).select(*cols))
    return enc.label_dictionaries(u, cols)


@query("enc03_factorize_codes", """
WITH o AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderpriority END AS pr
           FROM orders),
tr AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority_ok),
d AS (SELECT pr AS value, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS code
      FROM o WHERE o_orderdate < TIMESTAMP '1997-01-01' AND pr <> '1-URGENT' AND pr IS NOT NULL GROUP BY pr)
SELECT o_orderkey, CAST(coalesce(code, -1) AS BIGINT) AS pr_code FROM o LEFT JOIN d ON pr = value
WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""".replace("tr AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority_ok),\n", ""),
    ("ENC-3", "D9"))
def enc03_factorize_codes(spark, base):
    """Dictionary from the train part (one category withheld, so the test side has unseen values),
    codes by first appearance in key order; NULL and unseen -> -1."""
    o = tables(spark, base).orders.select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("pr"))
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    train = o.where((F.col("o_orderdate") < cut) & (F.col("pr") != "1-URGENT"))
    d = enc.factorize_dictionary(train, "pr", ["o_orderkey"])
    test = o.where(F.col("o_orderdate") >= cut)
    out = enc.apply_dictionary(test, "pr", d, "pr_code", null_text=None, unseen=-1)
    return out.select("o_orderkey", F.col("pr_code").cast("bigint").alias("pr_code"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@query("enc04_one_hot", """
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS seg FROM customer)
SELECT c_custkey, coalesce(CAST(seg = 'AUTOMOBILE' AS INTEGER), 0) AS seg_AUTOMOBILE,
  coalesce(CAST(seg = 'BUILDING' AS INTEGER), 0) AS seg_BUILDING, coalesce(CAST(seg = 'FURNITURE' AS INTEGER), 0) AS seg_FURNITURE,
  coalesce(CAST(seg = 'HOUSEHOLD' AS INTEGER), 0) AS seg_HOUSEHOLD, CAST(seg IS NULL AS INTEGER) AS seg_nan FROM c
""", ("ENC-4", "ENC-5"))
def enc04_one_hot(spark, base):
    c = tables(spark, base).customer.select(
        "c_custkey", F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    return enc.one_hot(c, ["seg"], dummy_na=True)


@query("enc06_onehot_target", """
WITH k AS (SELECT max(label) + 1 AS k FROM embeddings)
SELECT vec_id, list_transform(range(k), lambda i: CAST(i = label AS INTEGER)) AS label_onehot,
  CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax_dim,
  CAST(embedding[1] > 0.5 AS INTEGER) AS first_dim_flag
FROM embeddings, k
""", ("ENC-6", "SCL-10", "SCL-9"))
def enc06_onehot_target(spark, base):
    e = tables(spark, base).embeddings
    k = e.agg(F.max("label")).first()[0] + 1  # number of classes: one parameter job
    return e.select("vec_id", one_hot_vector("label", k).alias("label_onehot"),
                    argmax_index("embedding").alias("argmax_dim"),
                    threshold(F.element_at("embedding", 1), 0.5).alias("first_dim_flag"))


@query("sca01_minmax", """
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS o_totalprice_scaled FROM orders, mm
WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""", ("SCA-1",))
def sca01_minmax(spark, base):
    o = tables(spark, base).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    params = enc.minmax_fit(o.where(F.col("o_orderdate") < cut), ["o_totalprice"])
    test = o.where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice")
    return rounded(enc.minmax_apply(test, params, "_scaled").select("o_orderkey", "o_totalprice_scaled"))


@query("sca02_mean_range", """
WITH s AS (SELECT avg(l_extendedprice) AS m, max(l_extendedprice) - min(l_extendedprice) AS r FROM lineitem)
SELECT round(sum((l_extendedprice - m) / r), 6) AS sum_scaled, round(max((l_extendedprice - m) / r), 6) AS max_scaled,
  round(min((l_extendedprice - m) / r), 6) AS min_scaled, count(*) AS n FROM lineitem, s
""", ("SCA-2",))
def sca02_mean_range(spark, base):
    li = enc.mean_range_scale(tables(spark, base).lineitem.select("l_extendedprice"), ["l_extendedprice"], "_s")
    return rounded(li.agg(F.sum("l_extendedprice_s").alias("sum_scaled"), F.max("l_extendedprice_s").alias("max_scaled"),
                          F.min("l_extendedprice_s").alias("min_scaled"), F.count(F.lit(1)).alias("n")))


@query("nul02_impute", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal,
                  CASE WHEN c_nationkey < 3 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
st AS (SELECT avg(bal) AS m FROM c),
md AS (SELECT seg FROM c WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1)
SELECT c_custkey, round(coalesce(bal, m), 6) AS bal, coalesce(c.seg, md.seg) AS seg FROM c, st, md
""", ("NUL-2", "AGG-21", "NUL-1"))
def nul02_impute(spark, base):
    c = tables(spark, base).customer.select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_nationkey") < 3, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    return rounded(prof.impute_mean_mode(c, exclude=["c_custkey"]))


@query("spl01_hash_split", """
SELECT (CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) % 10000) < 2000 AS is_valid,
  (CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|42/inner'), 1, 8)) AS BIGINT) % 10000) < 1000 AS is_early_stop,
  count(*) AS n, round(avg(o_totalprice), 6) AS price_mean
FROM orders GROUP BY 1, 2
""", ("SPL-1", "SPL-2"))
def spl01_hash_split(spark, base):
    o = tables(spark, base).orders
    return rounded(o.groupBy(spl.split_flag("o_orderkey", 0.2, 42).alias("is_valid"),
                             spl.nested_split_flag("o_orderkey", 0.1, 42).alias("is_early_stop"))
                   .agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("price_mean")))


@query("spl06_fixed_sample", """
SELECT o_orderkey FROM orders
ORDER BY ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|3'), 1, 8))::BIGINT, o_orderkey LIMIT 500
""", ("SPL-6",))
def spl06_fixed_sample(spark, base):
    return spl.fixed_size_sample(tables(spark, base).orders.select("o_orderkey"), "o_orderkey", 500, 3)


@query("spl07_balance_classes", """
WITH p AS (SELECT count(*) AS n FROM labels WHERE toxic = 1),
neg AS (SELECT doc_id, toxic, row_number() OVER (ORDER BY doc_id) AS rn FROM labels WHERE toxic <> 1)
SELECT doc_id, toxic FROM labels WHERE toxic = 1
UNION ALL SELECT doc_id, toxic FROM neg, p WHERE rn <= p.n
""", ("SPL-7", "SPL-8"))
def spl07_balance_classes(spark, base):
    lab = tables(spark, base).labels.select("doc_id", "toxic")
    return spl.balance_classes(lab, "toxic", ["doc_id"])


@query("spl04_contiguous_folds", """
WITH n AS (SELECT count(*) AS n FROM orders),
f AS (SELECT o_orderkey, ntile(5) OVER (ORDER BY o_orderkey) - 1 AS fold FROM orders)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM f GROUP BY fold
""", ("SPL-4",))
def spl04_contiguous_folds(spark, base):
    o = spl.contiguous_folds(tables(spark, base).orders.select("o_orderkey"), ["o_orderkey"], 5)
    return o.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
                                 F.max("o_orderkey").alias("last_key"))
