"""Multi-table feature marts and relational operators on the star schema.

Surrogates (FIXTURES F1): customer = application, orders = bureau / previous applications,
lineitem = bureau balance / instalments.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featmart.functions.scalar import clip_low, prefix, safe_div, zero_to_null
from featmart.operators import relational as rel
from featmart.operators import windows as win
from featmart.plans.registry import query, r, rounded
from featmart.sources import tables

def customer_mart(spark, base):
    """E1: lineitem -> per-order roll-up (+ return-flag pivot) -> orders -> per-customer statistics
    -> customer, with a ratio feature. Three aggregation levels, each one ``agg``."""
    t = tables(spark, base)
    flags = rel.distinct_values(t.lineitem, "l_returnflag")["l_returnflag"]
    per_order = rel.agg_spec(
        t.lineitem, "l_orderkey", {"l_linenumber": ["min", "max"]},
        extra=[F.count(F.lit(1)).alias("n_lines"), *rel.pivot_count_exprs("l_returnflag", flags)])
    orders = t.orders.join(per_order.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    per_cust = rel.agg_spec(
        orders, "o_custkey",
        {"o_totalprice": ["size", "mean", "max", "min", "sum", "var", "std"],
         "n_lines": ["mean", "max"], "l_returnflag_R": ["mean"], "o_orderpriority": ["nunique"]},
        extra=[rel.count_where(F.col("o_orderstatus") == "F", "n_status_F"),
               rel.count_where(F.col("o_orderstatus") == "O", "n_status_O")])
    mart = t.customer.join(per_cust.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    mart = mart.withColumn("acctbal_to_spend", safe_div("c_acctbal", "o_totalprice_sum")) \
               .withColumn("orders_per_fulfilled", safe_div("o_totalprice_size", "n_status_F"))
    mart = mart.withColumn("o_totalprice_var", r("o_totalprice_var", -2))  # ~1e10: 8+ significant digits
    return rounded(mart.drop("c_name"))


CUSTOMER_MART_SQL = """
WITH l1 AS (
  SELECT l_orderkey, min(l_linenumber) AS l_linenumber_min, max(l_linenumber) AS l_linenumber_max,
         count(*) AS n_lines,
         nullif(count(*) FILTER (WHERE l_returnflag = 'A'), 0) AS l_returnflag_A,
         nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0) AS l_returnflag_N,
         nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0) AS l_returnflag_R
  FROM lineitem GROUP BY l_orderkey),
l2 AS (
  SELECT o_custkey, count(*) AS o_totalprice_size, avg(o_totalprice) AS o_totalprice_mean,
         max(o_totalprice) AS o_totalprice_max, min(o_totalprice) AS o_totalprice_min,
         coalesce(sum(o_totalprice), 0) AS o_totalprice_sum, var_samp(o_totalprice) AS o_totalprice_var,
         stddev_samp(o_totalprice) AS o_totalprice_std, avg(n_lines) AS n_lines_mean,
         max(n_lines) AS n_lines_max, avg(l_returnflag_R) AS l_returnflag_R_mean,
         count(DISTINCT o_orderpriority) AS o_orderpriority_nunique,
         nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS n_status_F,
         nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS n_status_O
  FROM orders LEFT JOIN l1 ON o_orderkey = l_orderkey
  WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment,
       o_totalprice_size, round(o_totalprice_mean, 6) AS o_totalprice_mean,
       round(o_totalprice_max, 6) AS o_totalprice_max, round(o_totalprice_min, 6) AS o_totalprice_min,
       round(o_totalprice_sum, 6) AS o_totalprice_sum, round(o_totalprice_var, -2) AS o_totalprice_var,
       round(o_totalprice_std, 6) AS o_totalprice_std, round(n_lines_mean, 6) AS n_lines_mean, n_lines_max,
       round(l_returnflag_R_mean, 6) AS l_returnflag_R_mean, o_orderpriority_nunique, n_status_F, n_status_O,
       round(c_acctbal / nullif(o_totalprice_sum, 0), 6) AS acctbal_to_spend,
       round(o_totalprice_size / nullif(n_status_F, 0), 6) AS orders_per_fulfilled
FROM customer LEFT JOIN l2 ON c_custkey = o_custkey
"""
query("customer_mart", CUSTOMER_MART_SQL,
      ("JN-1", "JN-4", "JN-5", "AGG-1", "AGG-2", "AGG-3", "AGG-4", "AGG-6", "AGG-7",
       "AGG-8", "AGG-11", "PRJ-1", "PRJ-4", "PRJ-5", "PRJ-6", "FLT-1", "SRC-9"))(customer_mart)


@query("agg10_category_share", """
SELECT o_custkey,
  round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderpriority_1-URGENT_mean",
  max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_1-URGENT_max",
  min(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_1-URGENT_min",
  round(avg(CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderpriority_2-HIGH_mean",
  max(CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_2-HIGH_max",
  min(CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_2-HIGH_min",
  round(avg(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderpriority_3-MEDIUM_mean",
  max(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_3-MEDIUM_max",
  min(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_3-MEDIUM_min",
  round(avg(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderpriority_4-NOT SPECIFIED_mean",
  max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_4-NOT SPECIFIED_max",
  min(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_4-NOT SPECIFIED_min",
  round(avg(CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END), 6) AS "o_orderpriority_5-LOW_mean",
  max(CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_5-LOW_max",
  min(CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END) AS "o_orderpriority_5-LOW_min",
  count(DISTINCT o_orderstatus) AS o_orderstatus_nunique
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
""", ("AGG-10", "AGG-6", "ENC-4"))
def agg10_category_share(spark, base):
    o = tables(spark, base).orders
    return rounded(o.where(F.col("o_custkey").isNotNull()).groupBy("o_custkey").agg(
        *rel.category_share_exprs("o_orderpriority", rel.distinct_values(o, "o_orderpriority")["o_orderpriority"]),
        F.count_distinct("o_orderstatus").alias("o_orderstatus_nunique")))


@query("agg09_numeric_means", """
SELECT l_suppkey,
  round(avg(l_quantity), 6) AS l_quantity_mean, round(max(l_quantity), 6) AS l_quantity_max,
  round(min(l_quantity), 6) AS l_quantity_min,
  round(avg(l_extendedprice), 6) AS l_extendedprice_mean, round(max(l_extendedprice), 6) AS l_extendedprice_max,
  round(min(l_extendedprice), 6) AS l_extendedprice_min,
  round(avg(l_discount), 6) AS l_discount_mean, round(max(l_discount), 6) AS l_discount_max,
  round(min(l_discount), 6) AS l_discount_min,
  round(avg(l_tax), 6) AS l_tax_mean, round(max(l_tax), 6) AS l_tax_max, round(min(l_tax), 6) AS l_tax_min
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey
""", ("AGG-9", "PRJ-9"))
def agg09_numeric_means(spark, base):
    li = tables(spark, base).lineitem.drop("l_orderkey", "l_partkey", "l_linenumber")
    return rounded(rel.agg_all_numeric(li, "l_suppkey", ("mean", "max", "min")))


@query("jn06_group_stat_rows", """
WITH s AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS cust_priorities,
                  avg(o_totalprice) AS cust_price_mean FROM orders GROUP BY o_custkey)
SELECT o_orderkey, o.o_custkey, cust_priorities, round(cust_price_mean, 6) AS cust_price_mean,
       round(o_totalprice / cust_price_mean, 6) AS price_vs_customer
FROM orders o LEFT JOIN s ON o.o_custkey = s.o_custkey
""", ("JN-6", "WIN-1", "AGG-6"))
def jn06_group_stat_rows(spark, base):
    o = tables(spark, base).orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    out = rel.group_stat_on_rows(o, "o_custkey", [F.count_distinct("o_orderpriority").alias("cust_priorities"),
                                                  F.avg("o_totalprice").alias("cust_price_mean")])
    out = out.withColumn("price_vs_customer", safe_div("o_totalprice", "cust_price_mean"))
    return rounded(out.select("o_orderkey", "o_custkey", "cust_priorities", "cust_price_mean", "price_vs_customer"))


@query("jn07_unique_key_join", """
WITH once AS (SELECT s_nationkey, count(*) AS n, min(s_acctbal) AS pred FROM supplier GROUP BY s_nationkey)
SELECT c_custkey, c_nationkey, round(coalesce(CASE WHEN n = 1 THEN pred END, 0.0), 6) AS pred
FROM customer LEFT JOIN once ON c_nationkey = s_nationkey
""", ("JN-7", "WIN-8", "NUL-1"))
def jn07_unique_key_join(spark, base):
    t = tables(spark, base)
    right = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_acctbal")
    out = rel.unique_key_join(t.customer.select("c_custkey", "c_nationkey"), right, ["c_nationkey"],
                              "s_acctbal", default=0.0, name="pred")
    return rounded(out)


@query("jn08_lookup_last_wins", """
WITH m AS (SELECT l_suppkey, arg_max(l_partkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS last_part
           FROM lineitem GROUP BY l_suppkey)
SELECT s_suppkey, last_part, substr(p_name, 1, 20) AS part_name_prefix
FROM supplier LEFT JOIN m ON s_suppkey = l_suppkey LEFT JOIN part ON last_part = p_partkey
""", ("JN-8", "STR-6", "FLT-2"))
def jn08_lookup_last_wins(spark, base):
    t = tables(spark, base)
    li = t.lineitem.withColumn("__ord", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"))
    s = rel.lookup(t.supplier.select("s_suppkey"), li.select("l_suppkey", "l_partkey", "__ord"),
                   "l_suppkey", "l_partkey", "__ord", out="last_part", left_key="s_suppkey")
    p = t.part.select(F.col("p_partkey").alias("last_part"), prefix("p_name", 20).alias("part_name_prefix"))
    return s.join(p, "last_part", "left").select("s_suppkey", "last_part", "part_name_prefix")


@query("jn09_semi_join", """
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""", ("JN-9", "FLT-1"))
def jn09_semi_join(spark, base):
    t = tables(spark, base)
    keep = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return rounded(t.orders.join(keep, "o_custkey", "left_semi").select("o_orderkey", "o_custkey", "o_totalprice"))


@query("set01_union_split", """
WITH u AS (
  SELECT o_orderstatus, o_totalprice, false AS is_test FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT o_orderstatus, o_totalprice, true AS is_test FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT is_test, o_orderstatus, count(*) AS n, round(avg(o_totalprice), 6) AS price_mean
FROM u GROUP BY is_test, o_orderstatus
""", ("SET-1", "SET-2", "SET-6", "PRJ-12"))
def set01_union_split(spark, base):
    o = tables(spark, base).orders.select("o_orderstatus", "o_totalprice", "o_orderdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    train = o.where(F.col("o_orderdate") < cut).drop("o_orderdate")
    test = o.where(F.col("o_orderdate") >= cut).drop("o_orderdate")
    u = rel.union_tagged(train, test)
    return rounded(u.groupBy("is_test", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                                             F.avg("o_totalprice").alias("price_mean")))


@query("set05_align_columns", """
SELECT c_custkey AS id, round(c_acctbal, 6) AS acctbal, c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey AS id, round(s_acctbal, 6) AS acctbal, CAST(NULL AS VARCHAR) AS segment, 'supplier' AS kind FROM supplier
""", ("SET-5", "SET-2", "PRJ-3", "PRJ-7"))
def set05_align_columns(spark, base):
    t = tables(spark, base)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"),
                          F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"),
                          F.lit("supplier").alias("kind"))
    cols = ["id", "acctbal", "segment", "kind"]
    s = rel.align_columns(s, cols, dtype="string").withColumn("id", F.col("id").cast("bigint")) \
        .withColumn("acctbal", F.col("acctbal").cast("double"))
    return rounded(c.unionByName(s))


@query("agg25_card_features", """
WITH b AS (SELECT o_custkey, o_orderkey, o_totalprice, l_extendedprice, l_discount, l_quantity, l_returnflag
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
load AS (SELECT o_custkey, avg(x) AS credit_load FROM (
  SELECT o_custkey, max(l_extendedprice) / nullif(max(o_totalprice), 0) AS x FROM b GROUP BY o_custkey, o_orderkey, o_totalprice) GROUP BY o_custkey),
dpd AS (SELECT o_custkey, avg(c) AS dpd_count FROM (
  SELECT o_custkey, count(*) FILTER (WHERE l_discount <> 0) AS c FROM b GROUP BY o_custkey, o_orderkey) GROUP BY o_custkey)
SELECT o_custkey, count(DISTINCT o_orderkey) AS n_loans, round(count(*) / count(DISTINCT o_orderkey) + 1e-9, 4) AS installments_per_loan,
  round(any_value(credit_load) + 1e-9, 4) AS credit_load, round(any_value(dpd_count) + 1e-9, 4) AS dpd_count, round(avg(l_discount) + 1e-9, 5) AS avg_dpd,
  round(100.0 * count(*) FILTER (WHERE l_quantity < 10) / count(*) + 1e-9, 4) AS pct_missed,
  round(100.0 * coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 0) / nullif(sum(l_extendedprice), 0) + 1e-9, 4) AS cash_card_ratio,
  round(100.0 * sum(l_extendedprice) / nullif(sum(l_quantity), 0) + 1e-9, 2) AS drawings_ratio
FROM b JOIN load USING (o_custkey) JOIN dpd USING (o_custkey) GROUP BY o_custkey
""", ("AGG-25", "AGG-6", "AGG-11", "PRJ-5"))
def agg25_card_features(spark, base):
    """The eight card features: loans, instalments per loan, mean load per limit (the order's total plays the
    limit), mean number of rows past due per loan, mean days past due over the customer's rows, percentage of
    payments missed, cash share of drawings, drawings amount by drawings count x 100. Lines are added up per
    order before the join; sums and counts are carried, so no mean of means arises."""
    t = tables(spark, base)
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("balance"), F.count_if(F.col("l_discount") != 0).alias("n_due"),
        F.sum("l_discount").alias("due"), F.count("l_discount").alias("n_discount"), F.count_if(F.col("l_quantity") < 10).alias("n_missed"),
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("cash"),
        F.sum("l_extendedprice").alias("amount"), F.sum("l_quantity").alias("times"))
    def off(x, decimals):  # off rounding ties, as in the SQL
        return F.round(x + 1e-9, decimals)

    loans = t.orders.select("o_custkey", "o_orderkey", "o_totalprice").join(per_order, "o_orderkey")
    out = loans.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_loans"), off(F.sum("n") / F.count(F.lit(1)), 4).alias("installments_per_loan"),
        off(F.avg(safe_div("balance", "o_totalprice")), 4).alias("credit_load"), off(F.avg("n_due"), 4).alias("dpd_count"),
        off(F.sum("due") / F.sum("n_discount"), 5).alias("avg_dpd"), off(100.0 * F.sum("n_missed") / F.sum("n"), 4).alias("pct_missed"),
        off(100.0 * safe_div(F.coalesce(F.sum("cash"), F.lit(0.0)), F.sum("amount")), 4).alias("cash_card_ratio"),
        off(100.0 * safe_div(F.sum("amount"), F.sum("times")), 2).alias("drawings_ratio"))
    return out


@query("agg12_ordered_list", """
WITH o AS (SELECT o_custkey, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos
           FROM orders),
w AS (SELECT max(pos) + 1 AS width FROM o),
l AS (SELECT o_custkey, avg(o_totalprice) AS mean, median(o_totalprice) AS med, sum(ln(1 + o_totalprice)) AS logs,
             sum(o_totalprice) AS total, count(*) AS n FROM o GROUP BY o_custkey)
SELECT o_custkey, CAST(pos AS BIGINT) AS pos, round(o_totalprice, 6) AS value, round(ln(1 + mean), 6) AS log_of_mean,
       round(ln(1 + med), 6) AS log_of_median, round(logs, 6) AS sum_of_logs, round(ln(1 + total), 6) AS log_of_sum,
       n AS n_sessions, width - n AS n_missing_slots
FROM o JOIN l USING (o_custkey), w
""", ("AGG-12", "AGG-13", "WIN-9", "SRT-1"))
def agg12_ordered_list(spark, base):
    """Every position of every customer's list as a row ``(o_custkey, pos, value)`` with the statistics over the
    list; slot ``pos`` of the wide form is ``pred_<pos>``. The median comes from the two middle ranks."""
    o = tables(spark, base).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    long = win.ordered_values(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice")
    ranked = win.ordered_values(o, ["o_custkey"], ["o_totalprice", "o_orderkey"], "o_totalprice", "rank")
    size = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    middle = (F.col("rank") == F.floor((F.col("n") - 1) / 2)) | (F.col("rank") == F.floor(F.col("n") / 2))
    stats = ranked.join(size, "o_custkey").groupBy("o_custkey").agg(
        F.log1p(F.avg("value")).alias("log_of_mean"), F.log1p(F.avg(F.when(middle, F.col("value")))).alias("log_of_median"),
        F.sum(F.log1p("value")).alias("sum_of_logs"), F.log1p(F.sum("value")).alias("log_of_sum"), F.count(F.lit(1)).alias("n_sessions"))
    width = size.agg(F.max("n").alias("width"))  # one row
    out = long.join(stats, "o_custkey").join(F.broadcast(width))
    return rounded(out.withColumn("n_missing_slots", F.col("width") - F.col("n_sessions")).drop("width"))


@query("prj08_global_mean_column", """
WITH g AS (SELECT avg(o_totalprice) AS m FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')
SELECT o_orderkey, round(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN m ELSE o_totalprice END, 6) AS target
FROM orders, g
""", ("PRJ-8", "FLT-4"))
def prj08_global_mean_column(spark, base):
    o = tables(spark, base).orders
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    m = o.where(F.col("o_orderdate") < cut).agg(F.avg("o_totalprice")).first()[0]  # one-row parameter
    return rounded(o.select("o_orderkey", F.when(F.col("o_orderdate") >= cut, F.lit(m))
                            .otherwise(F.col("o_totalprice")).alias("target")))


@query("flt04_conditional_fill", """
SELECT l_returnflag,
  count(*) FILTER (WHERE l_discount = 0) AS n_zero_discount,
  round(avg(nullif(l_discount, 0)), 6) AS discount_nonzero_mean,
  round(sum(CASE WHEN l_tax - 0.04 < 0 THEN 0 ELSE l_tax - 0.04 END), 6) AS tax_excess_clipped,
  round(sum(CASE WHEN l_quantity > 45 THEN 45 ELSE l_quantity END), 6) AS quantity_capped,
  count(*) FILTER (WHERE coalesce(nullif(l_discount, 0), -1) = -1) AS n_filled
FROM lineitem GROUP BY l_returnflag
""", ("FLT-4", "FLT-5", "FLT-7", "NUL-1", "NUL-3"))
def flt04_conditional_fill(spark, base):
    li = tables(spark, base).lineitem
    return rounded(li.groupBy("l_returnflag").agg(
        F.count_if(F.col("l_discount") == 0).alias("n_zero_discount"),
        F.avg(zero_to_null("l_discount")).alias("discount_nonzero_mean"),
        F.sum(clip_low(F.col("l_tax") - 0.04, 0.0)).alias("tax_excess_clipped"),
        F.sum(F.when(F.col("l_quantity") > 45, F.lit(45.0)).otherwise(F.col("l_quantity"))).alias("quantity_capped"),
        F.count_if(F.coalesce(zero_to_null("l_discount"), F.lit(-1.0)) == -1).alias("n_filled")))


@query("win07_global_forward_fill", """
SELECT o_orderkey,
  round(last_value(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END IGNORE NULLS)
        OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS o_totalprice
FROM orders
""", ("WIN-7",))
def win07_global_forward_fill(spark, base):
    o = tables(spark, base).orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"))
    return rounded(win.global_forward_fill(o, ["o_totalprice"], ["o_orderkey"]))


@query("win07_group_forward_fill", """
SELECT event_id, user_id,
  round(last_value(CASE WHEN event_type = 'error' THEN NULL ELSE value END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
FROM events
""", ("WIN-7",))
def win07_group_forward_fill(spark, base):
    e = tables(spark, base).events.select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"))
    return rounded(win.forward_fill(e, ["value"], ["user_id"], ["ts", "event_id"]).drop("ts"))


@query("flt03_dropna", """
SELECT count(*) AS n_rows FROM (
  SELECT nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS t FROM lineitem) WHERE d IS NOT NULL AND t IS NOT NULL
""", ("FLT-3",))
def flt03_dropna(spark, base):
    li = tables(spark, base).lineitem.select(zero_to_null("l_discount").alias("d"), zero_to_null("l_tax").alias("t"))
    return li.na.drop("any").agg(F.count(F.lit(1)).alias("n_rows"))


@query("spl03_range_split", """
WITH n AS (SELECT count(*) AS n FROM orders)
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS part
FROM orders, n
""", ("SPL-3", "PRJ-11", "SRT-8"))
def spl03_range_split(spark, base):
    o = tables(spark, base).orders.select("o_orderkey")
    n = o.count()
    num = rel.with_global_row_number(o, ["o_orderkey"], "__rn")
    return num.select("o_orderkey", F.when(F.col("__rn") <= int(0.8 * n), "train").otherwise("test").alias("part"))


@query("scl_misc_transforms", """
SELECT l_returnflag, round(sum(ln(l_extendedprice)), 6) AS sum_log_price, round(sum(exp(l_discount)), 6) AS sum_exp_discount,
  sum(CAST(floor(l_quantity / 7) AS BIGINT)) AS sum_quantity_weeks, sum(CAST(l_linenumber <> l_suppkey AS INTEGER)) AS n_line_ne_supp,
  round(sum(l_tax / 255.0), 6) AS sum_tax_scaled, count(*) AS n
FROM lineitem GROUP BY l_returnflag
""", ("SCL-2", "SCL-4", "SCL-8", "SCL-11", "PRJ-2", "PRJ-10"))
def scl_misc_transforms(spark, base):
    li = tables(spark, base).lineitem
    li = li.select(*li.columns[2:])  # PRJ-2: drop the two leading columns by position
    return rounded(li.groupBy("l_returnflag").agg(
        F.sum(F.log("l_extendedprice")).alias("sum_log_price"), F.sum(F.exp("l_discount")).alias("sum_exp_discount"),
        F.sum(F.floor(F.col("l_quantity") / 7).cast("bigint")).alias("sum_quantity_weeks"),
        F.sum((F.col("l_linenumber") != F.col("l_suppkey")).cast("int")).alias("n_line_ne_supp"),
        F.sum(F.col("l_tax") / 255.0).alias("sum_tax_scaled"), F.count(F.lit(1)).alias("n")))


@query("srt05_preview", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5
""", ("SRT-5", "SRC-5"))
def srt05_preview(spark, base):
    """``head()`` / ``nrows=n``: the first rows in key order (the limit is the operator)."""
    return tables(spark, base).orders.select("o_orderkey", "o_custkey", "o_orderstatus").orderBy("o_orderkey").limit(5)


@query("src12_label_dictionary", """
WITH p AS (SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/') AS parts FROM pages),
l AS (SELECT page_id, parts[len(parts) - 1] AS label FROM p),
d AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT label FROM l))
SELECT page_id, l.label, label_id FROM l JOIN d ON l.label = d.label
""", ("SRC-11", "SRC-12", "ENC-1"))
def src12_label_dictionary(spark, base):
    """Files under ``<root>/<label>/<file>``: label = parent folder of the path (here the page URLs
    stand in for file paths), then a sorted label dictionary joined back."""
    from featmart.operators import encode as enc
    from featmart.sources.files import label_from_path
    p = tables(spark, base).pages.select("page_id", label_from_path(F.regexp_replace("url", "[?#].*$", "")).alias("label"))
    d = enc.label_dictionary(p, "label", null_text=None).withColumnRenamed("value", "label").withColumnRenamed("code", "label_id")
    return p.join(d, "label").select("page_id", "label", "label_id")


_WIDTH = 16


@query("agg12_wide_list", f"""
WITH o AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
SELECT o_custkey, {', '.join(f'round(max(o_totalprice) FILTER (WHERE pos = {i}), 6) AS pred_{i}' for i in range(_WIDTH))}, count(*) AS n_values
FROM o GROUP BY o_custkey
""", ("AGG-12", "WIN-9"))
def agg12_wide_list(spark, base):
    """A customer's first orders side by side, and how many there are."""
    o = tables(spark, base).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return rounded(win.wide_values(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", _WIDTH))
