"""Registered queries over the corpus operators; each reads whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featmart.llm import bpe, decontaminate, language, lm, neardup, phrases, pii, quality, repeats, ring, secret_scan, spelling, token_files
from featmart.llm.common import tokenizer_file
from featmart.llm.spans import listing
from featmart.sources.tables import read_table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort("items"), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(listed, 256).alias("items_sha256"), "contaminated")


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 13) AS n,
       unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS p
      FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM q),
g AS (SELECT d.r, n.n, unnest(range(1, len(d.w) - n.n + 2)) AS i, d.w FROM d JOIN n ON len(d.w) >= n.n),
m AS (SELECT g.r, g.i, g.n, q.item FROM
        (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM g) g JOIN q ON g.p = q.p AND g.n = q.n),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS x FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = language.predict(docs, language.fit(docs))
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *(_number(k) for k in secret_scan.BASE),
                      F.sha2(listing(F.col("base")), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"), round_trip=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "copy_id", F.col("first").alias("kept"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.repeated_bytes(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.score(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("per_word", 6).alias("per_word"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, i, w[i] AS w3, CASE WHEN i > 1 THEN w[i - 1] END AS w2, CASE WHEN i > 2 THEN w[i - 2] END AS w1, len(w) AS own
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
c1 AS (SELECT w3, count(*) AS n FROM t GROUP BY ALL),
c2 AS (SELECT w2, w3, count(*) AS n FROM t WHERE w2 IS NOT NULL GROUP BY ALL),
c3 AS (SELECT w1, w2, w3, count(*) AS n FROM t WHERE w1 IS NOT NULL GROUP BY ALL),
o1 AS (SELECT r, w3, count(*) AS n FROM t GROUP BY ALL),
o2 AS (SELECT r, w2, w3, count(*) AS n FROM t WHERE w2 IS NOT NULL GROUP BY ALL),
o3 AS (SELECT r, w1, w2, w3, count(*) AS n FROM t WHERE w1 IS NOT NULL GROUP BY ALL),
s AS (SELECT t.r, t.i, (SELECT count(*) FROM t) - t.own AS total,
        c1.n - o1.n AS n1, coalesce(c2.n - o2.n, 0) AS n2, coalesce(c3.n - o3.n, 0) AS n3,
        coalesce(p1.n - q1.n, 0) AS m1, coalesce(p2.n - q2.n, 0) AS m2
      FROM t JOIN c1 ON t.w3 = c1.w3 JOIN o1 ON t.r = o1.r AND t.w3 = o1.w3
      LEFT JOIN c2 ON t.w2 = c2.w2 AND t.w3 = c2.w3 LEFT JOIN o2 ON t.r = o2.r AND t.w2 = o2.w2 AND t.w3 = o2.w3
      LEFT JOIN c3 ON t.w1 = c3.w1 AND t.w2 = c3.w2 AND t.w3 = c3.w3
      LEFT JOIN o3 ON t.r = o3.r AND t.w1 = o3.w1 AND t.w2 = o3.w2 AND t.w3 = o3.w3
      LEFT JOIN c1 p1 ON t.w2 = p1.w3 LEFT JOIN o1 q1 ON t.r = q1.r AND t.w2 = q1.w3
      LEFT JOIN c2 p2 ON t.w1 = p2.w2 AND t.w2 = p2.w3 LEFT JOIN o2 q2 ON t.r = q2.r AND t.w1 = q2.w2 AND t.w2 = q2.w3),
l AS (SELECT r, CASE
        WHEN i > 2 AND n3 > 0 THEN log10(n3 / m2)
        WHEN i > 1 AND n2 > 0 THEN (CASE WHEN i > 2 THEN log10(0.4) ELSE 0 END) + log10(n2 / m1)
        ELSE (least(i, 3) - 1) * log10(0.4) + CASE WHEN n1 > 0 THEN log10(n1 / total) ELSE log10(0.4) - log10(greatest(total, 1)) END
      END AS x FROM s),
z AS (SELECT r, sum(x) AS x FROM l GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(x, 0), 4) AS log_score,
       round(CASE WHEN len(w) > 0 THEN x / len(w) END, 6) AS per_word
FROM d LEFT JOIN z USING (r)
"""


def _number(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_files.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *(_number(k) for k in pii.BASE), F.sha2(listing(F.col("base")), 256).alias("base_sha256"),
                      listing(F.col("spans")).alias("spans"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = quality.judge(docs, quality.fit(docs, labels))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "llr")


def op11_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards whose counts are at most one apart; ``home`` is the shard that the ring alone would give."""
    out = ring.place(read_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "home")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM
        (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
x AS (SELECT f.lang, f.phrase, f.a, c.j, array_to_string(string_split(f.phrase, ' ')[1:c.j], ' ') AS lp,
        array_to_string(string_split(f.phrase, ' ')[c.j + 1:f.k], ' ') AS rp
      FROM f JOIN (SELECT unnest(range(1, 5)) AS j) c ON c.j < f.k),
s AS (SELECT x.lang, x.phrase, x.a, x.j, l.a AS l, r.a AS r, t.n,
        CAST((CAST(1000 AS HUGEINT) * x.a * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.lp JOIN f r ON r.lang = x.lang AND r.phrase = x.rp JOIN t ON t.lang = x.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT f.lang, f.a, array_to_string(string_split(f.phrase, ' ')[z.s:z.s + z.m - 1], ' ') AS phrase
      FROM f JOIN (SELECT m, s FROM (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS s)) z ON z.m < f.k AND z.s + z.m - 1 <= f.k),
d AS (SELECT lang, phrase, max(a) AS more FROM i GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE more IS NULL OR more < a) WHERE rank <= 2000
"""


QUERIES = {f.__name__: f for f in (op1_benchmark_decontamination, op2_language_id, op3_secret_scan, op4_byte_bpe, op5_minhash_near_dedup, op6_suffix_dedup, op7_lm_scoring, op8_token_files, op9_personal_data,
                                    op10_quality_rules, op11_ring_shards, op12_spelling_variants,
                                    op13_collocations)}
#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {"op1_benchmark_decontamination": OP1_SQL, "op7_lm_scoring": OP7_SQL, "op13_collocations": OP13_SQL}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
