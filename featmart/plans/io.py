"""Source / sink queries: a table written as gzip CSV and TSV to the shared checkpoint folder and
read back through the typed readers (SRC-1/2/3/6/7/8, SNK-1/2/4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from featmart.plans.registry import query, rounded
from featmart.session import checkpoint_dir
from featmart.sources import files as io
from featmart.sources import positions, word_vectors
from featmart.sources import tables

CUSTOMER_CSV_SCHEMA = "c_custkey STRING, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def _scratch(spark, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/featmart-io/{what}-{uuid.uuid4().hex}"


@query("src01_csv_roundtrip", """
SELECT c_mktsegment, count(*) AS n, count(DISTINCT CAST(c_custkey AS VARCHAR)) AS n_ids,
  count(*) FILTER (WHERE c_nationkey = 0) AS n_null_nation, round(sum(c_acctbal), 6) AS acctbal_sum,
  max(length(CAST(c_custkey AS VARCHAR))) AS max_id_len
FROM customer GROUP BY c_mktsegment
""", ("SRC-1", "SRC-2", "SRC-3", "SRC-6", "SRC-7", "SRC-8", "SRC-10", "SNK-1", "SNK-2"))
def src01_csv_roundtrip(spark, base):
    c = tables(spark, base).customer
    path = _scratch(spark, "customer_csv")
    c.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
    tsv = _scratch(spark, "customer_tsv")
    c.write.mode("overwrite").option("header", True).option("sep", "\t").csv(tsv)
    df = io.read_csv(spark, path, CUSTOMER_CSV_SCHEMA, drop_malformed=True,
                     min_partitions=spark.sparkContext.defaultParallelism)
    df = io.null_sentinels(df, [0], columns=["c_nationkey"])
    t = io.read_tsv(spark, tsv, CUSTOMER_CSV_SCHEMA, drop_malformed=True)
    both = df.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal").join(
        t.select("c_custkey", F.col("c_acctbal").alias("acctbal_tsv")), "c_custkey")
    return rounded(both.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("n_ids"),
        F.count_if(F.col("c_nationkey").isNull()).alias("n_null_nation"), F.sum("acctbal_tsv").alias("acctbal_sum"),
        F.max(F.length("c_custkey")).alias("max_id_len")))


_QUOTED_SQL = """'He said "hi, ' || c_name || '" now'"""


@query("src08_malformed_rows", f"""
SELECT CAST(c_custkey AS BIGINT) AS id, {_QUOTED_SQL} AS text, round(c_acctbal, 6) AS amount
FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
""", ("SRC-1", "SRC-2", "SRC-8"))
def src08_malformed_rows(spark, base):
    """Quoted fields with separators and doubled quotes; every seventh row has text for a number, every
    eleventh lacks a field. Only the id is read at first, so dropping must not depend on it."""
    quoted = F.concat(F.lit('"He said ""hi, '), F.col("c_name"), F.lit('"" now"'))
    line = F.concat_ws(",", F.col("c_custkey"), quoted, F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a"))
                       .otherwise(F.col("c_acctbal").cast("string")))
    line = F.when(F.col("c_custkey") % 11 == 0, F.concat_ws(",", F.col("c_custkey"), quoted)).otherwise(line)
    path = _scratch(spark, "malformed")
    rows = tables(spark, base).customer.select(line.alias("value"))
    rows.write.text(f"{path}/part=rows")
    spark.createDataFrame([("id,text,amount",)], "value string").coalesce(1).write.text(f"{path}/part=header")
    df = io.read_csv(spark, f"{path}/*", "id BIGINT, text STRING, amount DOUBLE", header=False, drop_malformed=True)
    ids = df.select("id")
    return rounded(df.join(ids, "id", "left_semi"))


@query("snk01_csv_sink", """
SELECT CAST(c_custkey AS BIGINT) AS id, c_name || '"' || chr(10) || ', ' || c_mktsegment AS note, printf('%.2f', c_acctbal) AS amount
FROM customer
""", ("SNK-1", "SNK-2", "SNK-3", "SRC-1"))
def snk01_csv_sink(spark, base):
    """Fixed-decimal text and notes with quotes and line breaks, written and read back."""
    c = tables(spark, base).customer
    out = c.select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit('"\n, '), "c_mktsegment").alias("note"),
                   io.format_fixed("c_acctbal").alias("amount"))
    path = _scratch(spark, "sink")
    io.write_csv(out, path)
    return io.read_csv(spark, path, "id BIGINT, note STRING, amount STRING", multi_line=True)


@query("snk04_fill_template", """
SELECT c_custkey, c_name, n AS target FROM customer LEFT JOIN (
  SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
) ON c_custkey = o_custkey
""", ("SNK-4", "JN-1"))
def snk04_fill_template(spark, base):
    t = tables(spark, base)
    template = t.customer.select("c_custkey", "c_name", F.lit(None).cast("bigint").alias("target"))
    preds = (t.orders.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.count(F.lit(1)).alias("target")))
    return io.fill_template(template, preds, "c_custkey", "target")


# ---- rows by position -----------------------------------------------------------------------------
@query("jn10_positional_join", """
WITH o AS (SELECT row_number() OVER () - 1 AS position, o_orderkey, o_totalprice FROM orders),
p AS (SELECT row_number() OVER () - 1 AS position, p_partkey, p_retailprice FROM part)
SELECT position, o_orderkey, p_partkey, round(0.25 * o_totalprice + 0.75 * p_retailprice, 6) AS blended FROM o JOIN p USING (position)
""", ("JN-10", "SRT-8"))
def jn10_positional_join(spark, base):
    """Two tables without a common key, row by row in file order, as prediction files are blended."""
    o = positions.parquet_positions(spark, f"{base}/orders.parquet").select("position", "o_orderkey", "o_totalprice")
    p = positions.parquet_positions(spark, f"{base}/part.parquet").select("position", "p_partkey", "p_retailprice")
    blended = (0.25 * F.col("o_totalprice") + 0.75 * F.col("p_retailprice")).alias("blended")
    return rounded(positions.positional_join(o, p).select("position", "o_orderkey", "p_partkey", blended))


@query("prj11_positional_slice", """
SELECT * FROM (SELECT row_number() OVER () - 1 AS position, l_orderkey, l_linenumber, l_partkey FROM lineitem) WHERE position >= 1000 AND position < 5000
""", ("PRJ-11", "SRT-8"))
def prj11_positional_slice(spark, base):
    """A stretch of the file's rows, as they stand."""
    li = positions.parquet_positions(spark, f"{base}/lineitem.parquet")
    return positions.positional_slice(li, 1000, 5000).select("position", "l_orderkey", "l_linenumber", "l_partkey")


@query("snk04_fill_by_position", """
WITH o AS (SELECT row_number() OVER () - 1 AS position, o_orderkey FROM orders), l AS (SELECT row_number() OVER () - 1 AS position, l_extendedprice FROM lineitem)
SELECT position, o_orderkey, round(l_extendedprice, 6) AS target FROM o LEFT JOIN l USING (position)
""", ("SNK-4", "JN-10"))
def snk04_fill_by_position(spark, base):
    """A template's column filled from predictions that were written without ids: both go through CSV files."""
    root = _scratch(spark, "by_position")
    o = positions.parquet_positions(spark, f"{base}/orders.parquet").orderBy("position").select("o_orderkey", F.lit(0.0).alias("target"))
    li = positions.parquet_positions(spark, f"{base}/lineitem.parquet").orderBy("position").select("l_extendedprice")
    o.write.csv(f"{root}/template", header=True)
    li.write.csv(f"{root}/predictions", header=True)
    template = positions.csv_positions(spark, f"{root}/template", "o_orderkey long, target double")
    predicted = positions.csv_positions(spark, f"{root}/predictions", "l_extendedprice double")
    return rounded(positions.positional_join(template.drop("target"), predicted.withColumnRenamed("l_extendedprice", "target"), how="left"))


@query("src13_word_vectors", """
SELECT 'w' || vec_id AS word, len(embedding) AS dim, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings
""", ("SRC-13", "TXT-10"))
def src13_word_vectors(spark, base):
    """The embeddings written as a word-vector file and read back by byte ranges."""
    path = _scratch(spark, "word_vectors")
    e = tables(spark, base).embeddings
    word_vectors.write_word_vectors(e.select(F.concat(F.lit("w"), "vec_id").alias("word"), F.col("embedding").cast("array<float>").alias("vector")), path)
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return word_vectors.read_word_vectors(spark, path, rangebytes=4 << 20).select("word", F.size("vector").cast("bigint").alias("dim"), F.round(total, 4).alias("total"))


@query("src11_labelled_bytes", """
SELECT lang AS label, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_lines
FROM documents GROUP BY lang
""", ("SRC-11", "SRC-12"))
def src11_labelled_bytes(spark, base):
    """The texts written into a folder for each language and read back as files, bytes and all, labelled by their folder."""
    root = _scratch(spark, "labelled")
    tables(spark, base).documents.select("lang", F.coalesce("text", F.lit("")).alias("text")).write.partitionBy("lang").option(
        "maxRecordsPerFile", 2000).text(root)  # bounded files: each is read as one value
    read = io.read_labelled_files(spark, root, "*.txt")
    lines = F.regexp_count(F.col("content").cast("string"), F.lit("\n"))
    return read.groupBy(F.regexp_replace("label", "^lang=", "").alias("label")).agg(
        F.sum(F.length("content")).alias("n_bytes"), F.sum(lines).cast("bigint").alias("n_lines"))
