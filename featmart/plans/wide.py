"""Wide marts: many branches joined with clashing names, pruning learned on train and applied to both
parts, documents flattened into columns, keyword rules with every branch present."""

from __future__ import annotations

from pyspark.sql import functions as F

from featmart.functions import keywords as kw
from featmart.functions.scalar import json_struct
from featmart.operators import evaluate as ev
from featmart.operators import profile as prof
from featmart.operators import relational as rel
from featmart.plans.registry import case_sql, query, rounded
from featmart.sources import tables
from featmart.sources.bucketed import BucketedCache, bucketed_mart

_MMM = ("mean", "max", "min")


#: Added before rounding on both sides: means of prices often end exactly on a rounding tie.
_OFF_TIE = 1e-9


def _mmm_sql(cols, prefix=""):
    return ", ".join(f"round(avg({c}) + 1e-9, 4) AS {prefix}{c}_mean, round(max({c}), 4) AS {prefix}{c}_max, round(min({c}), 4) AS {prefix}{c}_min"
                     for c in cols)


_CLASH = ", ".join(f"{p}.o_totalprice_{f} AS {p}_o_totalprice_{f}" for p in ("filled", "open") for f in _MMM)


_FULL_MART_SQL = f"""
WITH filled AS (SELECT o_custkey AS k, {_mmm_sql(['o_totalprice'])}, count(*) AS n_filled FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
open AS (SELECT o_custkey AS k, {_mmm_sql(['o_totalprice'])}, count(*) AS n_open FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
prio AS (SELECT o_custkey AS k, nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS "o_orderpriority_1-URGENT",
  nullif(count(*) FILTER (WHERE o_orderpriority = '2-HIGH'), 0) AS "o_orderpriority_2-HIGH",
  nullif(count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM'), 0) AS "o_orderpriority_3-MEDIUM",
  nullif(count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED'), 0) AS "o_orderpriority_4-NOT SPECIFIED",
  nullif(count(*) FILTER (WHERE o_orderpriority = '5-LOW'), 0) AS "o_orderpriority_5-LOW" FROM orders GROUP BY 1),
j AS (SELECT o_custkey AS k, lineitem.*, p_size, p_retailprice, s_acctbal FROM orders JOIN lineitem ON o_orderkey = l_orderkey
      LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey),
lines AS (SELECT k, {_mmm_sql(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax'])}, count(*) AS n_rows FROM j GROUP BY 1),
parts AS (SELECT k, {_mmm_sql(['p_size', 'p_retailprice'])}, count(DISTINCT l_partkey) AS n_distinct FROM j GROUP BY 1),
supp AS (SELECT k, {_mmm_sql(['s_acctbal'])}, count(DISTINCT l_suppkey) AS n_distinct FROM j GROUP BY 1)
SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment, {_CLASH}, n_filled, n_open,
  prio.* EXCLUDE (k), lines.* EXCLUDE (k), parts.* EXCLUDE (k, n_distinct), supp.* EXCLUDE (k, n_distinct),
  parts.n_distinct AS parts_n_distinct, supp.n_distinct AS supp_n_distinct
FROM customer LEFT JOIN filled ON c_custkey = filled.k LEFT JOIN open ON c_custkey = open.k LEFT JOIN prio ON c_custkey = prio.k
LEFT JOIN lines ON c_custkey = lines.k LEFT JOIN parts ON c_custkey = parts.k LEFT JOIN supp ON c_custkey = supp.k
"""


@query("customer_full_mart", _FULL_MART_SQL, ("JN-1", "JN-3", "JN-11", "AGG-2", "AGG-8", "AGG-9", "FLT-1"))
def customer_full_mart(spark, base):
    """Six branches per customer: filled and other orders (the same statistics under the same names), orders by
    priority, lines, parts and suppliers. The three line branches come from one joined, column-pruned table; a
    line's part and supplier are looked up before any aggregate."""
    return rel.left_mart(*_full_mart_parts(spark, base), "c_custkey")


@query("jn03_bucketed_mart", _FULL_MART_SQL, ("JN-3", "SRC-9", "JN-1", "JN-11"))
def jn03_bucketed_mart(spark, base):
    """The same mart over feature tables that are cached in buckets of the customer's key: the joins move no rows."""
    customers, parts = _full_mart_parts(spark, base)
    return bucketed_mart(BucketedCache.sized_for(customers, "c_custkey"), customers, parts)


def _full_mart_parts(spark, base):
    t = tables(spark, base)
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")

    def mmm(df, *cols, extra=()):
        stats = rel.agg_spec(df, "c_custkey", {c: list(_MMM) for c in cols}, extra=extra)
        return stats.select(*[F.round(F.col(c) + (_OFF_TIE if c.endswith("_mean") else 0), 4).alias(c) if c.endswith(_MMM) else F.col(c)
                              for c in stats.columns])

    lines = (o.select("c_custkey", "o_orderkey")
             .join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                     "l_discount", "l_tax"), "o_orderkey")
             .join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice"), "l_partkey", "left")
             .join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal"), "l_suppkey", "left"))
    values = rel.distinct_values(o, "o_orderpriority")["o_orderpriority"]
    parts = {
        "filled": mmm(o.where("o_orderstatus = 'F'"), "o_totalprice", extra=[F.count(F.lit(1)).alias("n_filled")]),
        "open": mmm(o.where("o_orderstatus <> 'F'"), "o_totalprice", extra=[F.count(F.lit(1)).alias("n_open")]),
        "prio": rel.pivot_counts(o, "c_custkey", "o_orderpriority", values),
        "lines": mmm(lines, "l_quantity", "l_extendedprice", "l_discount", "l_tax", extra=[F.count(F.lit(1)).alias("n_rows")]),
        "parts": mmm(lines, "p_size", "p_retailprice", extra=[F.count_distinct("l_partkey").alias("n_distinct")]),
        "supp": mmm(lines, "s_acctbal", extra=[F.count_distinct("l_suppkey").alias("n_distinct")]),
    }
    c = t.customer.select("c_custkey", "c_nationkey", F.round("c_acctbal", 6).alias("c_acctbal"), "c_mktsegment")
    return c, parts


@query("agg10_category_long", """
SELECT o_custkey, o_orderpriority AS category, count(*) AS n, round(count(*) / any_value(total), 6) AS share
FROM orders JOIN (SELECT o_custkey, count(*) AS total FROM orders GROUP BY 1) USING (o_custkey)
WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2
""", ("AGG-8", "AGG-10"))
def agg10_category_long(spark, base):
    return rounded(rel.category_counts(tables(spark, base).orders, "o_custkey", "o_orderpriority"))


@query("prn_apply", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'test' ELSE 'train' END AS part,
  round(o_totalprice, 6) AS o_totalprice, o_custkey
FROM orders
""", ("PRN-1", "PRN-2", "PRN-3", "PRN-4", "PRJ-9", "PRJ-13", "SET-6", "FLT-6"))
def prn_apply(spark, base):
    """Columns are pruned on what train shows (constant, mostly null, low variance; drifted against test), and the
    list that is left is applied to both parts. The input has one column of each kind, and a text column with one
    value in train only; ``no_such_column`` is dropped although it is not there."""
    o = tables(spark, base).orders
    test = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    df = o.select("o_orderkey", F.when(test, "test").otherwise("train").alias("part"), "o_totalprice", "o_custkey",
                  F.lit(7).alias("constant"), F.when(test, "new").otherwise("old").alias("constant_in_train"),
                  F.when(F.col("o_orderkey") % 20 == 0, F.col("o_totalprice")).alias("mostly_null"),
                  ((F.col("o_orderkey") % 5) / 100.0).alias("low_variance"), day.cast("double").alias("drifted"))
    train, other = df.where("part = 'train'"), df.where("part = 'test'")
    keep = prof.prune_columns(train, [c for c in df.columns if c not in ("o_orderkey", "part")], max_null_rate=0.8, min_variance=0.02)
    drift = ev.drift_report(train, other, [c for c in keep if c in rel.numeric_columns(df)], "o_orderkey", 0.8)
    flagged = {r["feature"] for r in drift.where("drifted").collect()}  # one row per column
    keep = ["o_orderkey", "part", *[c for c in keep if c not in flagged]]
    return rounded(train.drop("no_such_column").select(*keep).unionByName(other.select(*keep)))


# ---- JSON documents -----------------------------------------------------------------------------
_NUMBERS = ("transactionRevenue", "visits", "hits", "pageviews", "bounces", "newVisits")
_DOCS = {"geoNetwork": ("continent", "subContinent", "country", "region", "metro", "city", "networkDomain"),
         "device": ("browser", "operatingSystem", "isMobile", "deviceCategory"), "trafficSource": ("source", "medium")}
_ALL_TEXTS = [c for v in _DOCS.values() for c in v]


@query("jsn19_flatten", "SELECT o_orderkey, " + ", ".join(
    f"coalesce(CASE WHEN (o_orderkey + {i}) % 3 <> 0 THEN CAST((o_orderkey * {i + 1}) % 100 AS DOUBLE) END, 0.0) AS {c}" for i, c in enumerate(_NUMBERS))
    + ", " + ", ".join(f"CASE WHEN (o_orderkey + {i}) % 4 <> 0 THEN '{c} ' || o_orderpriority || ' \"' || (o_orderkey % {i + 3}) || '\"' END AS {c}"
                       for i, c in enumerate(_ALL_TEXTS)) + " FROM orders", ("JSN-1", "JSN-2", "JSN-3"))
def jsn19_flatten(spark, base):
    """Four JSON texts per row with 19 keys, each missing from a share of the rows, flattened again: every document
    is parsed once; a missing number is 0.0, a missing text NULL."""
    o, key = tables(spark, base).orders, F.col("o_orderkey")
    numbers = F.struct(*[F.when((key + i) % 3 != 0, (key * (i + 1)) % 100).alias(c) for i, c in enumerate(_NUMBERS)])
    text = {c: F.when((key + i) % 4 != 0, F.concat(F.lit(f"{c} "), "o_orderpriority", F.lit(' "'), (key % (i + 3)).cast("string"), F.lit('"')))
            for i, c in enumerate(_ALL_TEXTS)}
    docs = o.select("o_orderkey", F.to_json(numbers).alias("totals"),
                    *[F.to_json(F.struct(*[text[c].alias(c) for c in cols])).alias(d) for d, cols in _DOCS.items()])
    parsed = docs.select("o_orderkey", json_struct("totals", ", ".join(f"{c} DOUBLE" for c in _NUMBERS)).alias("totals"),
                         *[json_struct(d, ", ".join(f"{c} STRING" for c in cols)).alias(d) for d, cols in _DOCS.items()])
    return parsed.select("o_orderkey", *[F.coalesce(F.col("totals").getField(c), F.lit(0.0)).alias(c) for c in _NUMBERS],
                         *[F.col(d).getField(c).alias(c) for d, cols in _DOCS.items() for c in cols])


# ---- keyword rules ------------------------------------------------------------------------------
#: Inputs that reach every rule, shadowed branches (two needles in one text), exact names and the default.
_SAMPLES = [
    None, "", "Chrome", "SAFARI", "Internet Explorer", "edge", "iron", "Chrome Mobile", "Android Webview", "Samsung Internet", "Opera Mini",
    "iPhone", "Safari (in-app)", "PlayStation 4", "Mozilla Compatible", "BlackBerry9700", "Nokia Browser", "Amazon Silk", "Lunascape",
    "Netscape", "Konqueror", "Puffin", "(not set)", "Something", "Google Merchandise", "placement 4", "placememnt", "ad one", "google ad",
    "nan ad", "Full auto ad IMAGE ONLY", "plain", "youtube.com", "google youtube", "yahoo", "facebook.com", "reddit.com", "bing", "quora",
    "outlook.live", "linkedin", "pinterest", "ask.com", "siliconvalley.about", "lunametrics.com", "mysearch", "qiita.com", "messenger",
    "twitter", "t.co", "vk.com", "search.results", "umich.edu", "mail.ru", "adroll", "golang.org", "(direct)", "dealspotr", "sashihara",
    "phandroid", "baidu", "mdn", "duckduckgo", "seroundtable", "analytics metrics", "sogou", "businessinsider", "github.io", "gophergala",
    "yandex", "msn.com", "dfa", "feedly", "arstechnica", "squishable", "flipboard", "t-online.de", "sm.cn", "wow.com", "partners", "basket mail",
]
_SAMPLE_SQL = ", ".join("NULL" if s is None else f"'{s}'" for s in _SAMPLES)


@query("str345_keyword_rules", f"""
WITH s AS (SELECT page_id, [{_SAMPLE_SQL}][1 + page_id % {len(_SAMPLES)}] AS raw FROM pages), t AS (SELECT page_id, coalesce(lower(raw), 'nan') AS x FROM s)
SELECT page_id, x, {case_sql('x', kw.BROWSER_RULES, kw.BROWSER_EXACT)} AS browser, {case_sql('x', kw.ADCONTENT_RULES)} AS adcontent,
  {case_sql('x', kw.SOURCE_RULES)} AS source FROM t
""", ("STR-2", "STR-3", "STR-4", "STR-5"))
def str345_keyword_rules(spark, base):
    """The page's number picks one of the texts, so that every rule and every shadowed branch occurs."""
    raw = F.get(F.array(*[F.lit(s) for s in _SAMPLES]), (F.col("page_id") % len(_SAMPLES)).cast("int"))
    p = tables(spark, base).pages.select("page_id", raw.alias("raw"))
    return p.select("page_id", F.coalesce(F.lower("raw"), F.lit("nan")).alias("x"), kw.browser_family("raw").alias("browser"),
                    kw.adcontent_group("raw").alias("adcontent"), kw.source_group("raw").alias("source"))


# ---- joins to an index, type census -------------------------------------------------------------
@query("jn02_index_join", """
SELECT s_suppkey, n_lines, round(quantity, 4) AS quantity FROM supplier LEFT JOIN (
  SELECT l_suppkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey
""", ("JN-2", "JN-1"))
def jn02_index_join(spark, base):
    """A key column joined to another table's index: the grouped table is named by its group key, not by the column."""
    t = tables(spark, base)
    grouped = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 4).alias("quantity"))
    return rel.join_on_index(t.supplier.select("s_suppkey"), grouped, "s_suppkey", "l_suppkey")


@query("agg20_type_census", """
SELECT kind, count(*) AS n_columns, CAST(sum(n) AS BIGINT) AS n_values FROM (
  SELECT 'whole' AS kind, count(o_orderkey) AS n FROM orders UNION ALL SELECT 'whole', count(o_custkey) FROM orders
  UNION ALL SELECT 'text', count(o_orderstatus) FROM orders UNION ALL SELECT 'real', count(o_totalprice) FROM orders
  UNION ALL SELECT 'time', count(o_orderdate) FROM orders UNION ALL SELECT 'text', count(o_orderpriority) FROM orders) GROUP BY kind
""", ("AGG-20",))
def agg20_type_census(spark, base):
    return prof.type_counts(tables(spark, base).orders)
