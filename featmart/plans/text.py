"""Text preparation queries (FIXTURES F5): ``conversations`` plays the phrase table (user turns =
train, assistant turns = test), ``documents`` the excerpt table, ``embeddings`` the word vectors
keyed by word rank. Every query reads whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from featmart.operators import text as tx
from featmart.operators import treebank as tb
from featmart.plans.registry import query, rounded
from featmart.sources import tables

PAT = tx.WORD_PATTERN
_STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in tx.ENGLISH_STOP_WORDS + tx.VOCAB_PUNCTUATION)
_KERAS_CLASS = tx._regex_class(tx.KERAS_FILTERS)

MSG_KEY = ["conv_id", "turn"]


def _conv_tokens(spark, base):
    c = tables(spark, base).conversations
    return c.select(*MSG_KEY, "role", tx.tokens("text").alias("toks"))


_CONV_TOKENS_SQL = f"SELECT conv_id, turn, role, coalesce(regexp_extract_all(text, '{PAT}'), []) AS toks FROM conversations"


@query("txt01_token_counts", f"""
SELECT doc_id, len(regexp_extract_all(text, '{PAT}')) AS n_tokens,
  len(list_filter(regexp_extract_all(text, '{PAT}'), lambda t: regexp_matches(t, '^[\\p{{L}}\\p{{N}}_]+$'))) AS n_words
FROM documents
""", ("TXT-1", "TXT-12"))
def txt01_token_counts(spark, base):
    d = tables(spark, base).documents.select("doc_id", tx.tokens("text").alias("toks"))
    return d.select("doc_id", F.size("toks").cast("bigint").alias("n_tokens"),
                    F.size(F.filter("toks", lambda t: t.rlike(r"^[\p{L}\p{N}_]+$"))).cast("bigint").alias("n_words"))


@query("txt02_sorted_vocab", f"""
WITH t AS ({_CONV_TOKENS_SQL}), v AS (SELECT DISTINCT unnest(toks) AS token FROM t)
SELECT token, row_number() OVER (ORDER BY token) AS id FROM v
""", ("TXT-2", "SET-3", "SRT-9", "ARR-4"))
def txt02_sorted_vocab(spark, base):
    t = _conv_tokens(spark, base)
    u = t.where(F.col("role") == "user").unionByName(t.where(F.col("role") != "user"))  # train + test
    return tx.sorted_vocabulary(u, "toks")


_VOCAB_SQL = f"""WITH t AS ({_CONV_TOKENS_SQL}),
v AS (SELECT DISTINCT unnest(toks) AS token FROM t),
vs AS (SELECT token, row_number() OVER (ORDER BY token) AS id FROM v WHERE token NOT IN ({_STOP_SQL}))"""


@query("txt03_vocab_minus_stop", _VOCAB_SQL + " SELECT token, id FROM vs", ("TXT-3", "SET-4"))
def txt03_vocab_minus_stop(spark, base):
    return _vocab_minus_stop(spark, base)


def _vocab_minus_stop(spark, base):
    t = _conv_tokens(spark, base)
    stop = spark.createDataFrame([(w,) for w in tx.ENGLISH_STOP_WORDS + tx.VOCAB_PUNCTUATION], "token string")
    return tx.sorted_vocabulary(t, "toks", exclude=stop)


@query("txt05_token_ids_post", _VOCAB_SQL + """,
e AS (SELECT conv_id, turn, unnest(toks) AS token, unnest(generate_series(1, len(toks))) AS pos FROM t),
s AS (SELECT conv_id, turn, list(CAST(coalesce(id, 0) AS INTEGER) ORDER BY pos) AS ids
      FROM e LEFT JOIN vs USING (token) GROUP BY conv_id, turn)
SELECT t.conv_id, t.turn, coalesce(ids, []) AS ids,
  (coalesce(ids, []) || list_transform(range(50), lambda x: 0))[1:50] AS ids_50
FROM t LEFT JOIN s ON t.conv_id = s.conv_id AND t.turn = s.turn
""", ("TXT-5", "TXT-7", "Q6"))
def txt05_token_ids_post(spark, base):
    t = _conv_tokens(spark, base)
    seq = tx.to_ids(t, MSG_KEY, "toks", _vocab_minus_stop(spark, base), out="ids", oov=0)
    return seq.select(*MSG_KEY, "ids", tx.pad_post("ids", 50).alias("ids_50"))


def _doc_tokens(spark, base):
    d = tables(spark, base).documents
    return d.select("doc_id", tx.tokens("text", lower=True).alias("toks"))


_TOP_SQL = f"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{PAT}') AS toks FROM documents),
c AS (SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM t) GROUP BY token),
tv AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS id FROM c ORDER BY n DESC, token LIMIT 19999)"""


@query("txt04_top_vocab", _TOP_SQL + " SELECT token, n, id FROM tv", ("TXT-4", "SRT-4", "STR-2"))
def txt04_top_vocab(spark, base):
    return tx.top_vocabulary(_doc_tokens(spark, base), "toks", 19999)


@query("txt08_pad_pre", _TOP_SQL + """,
e AS (SELECT doc_id, unnest(toks) AS token, unnest(generate_series(1, len(toks))) AS pos FROM t),
s AS (SELECT doc_id, list(CAST(coalesce(id, 0) AS INTEGER) ORDER BY pos) AS ids FROM e LEFT JOIN tv USING (token) GROUP BY doc_id),
p AS (SELECT t.doc_id, (list_transform(range(30), lambda x: 0) || coalesce(ids, []))[-30:] AS ids_30
      FROM t LEFT JOIN s ON t.doc_id = s.doc_id)
SELECT doc_id, ids_30, ids_30[1:29] || ids_30[31:] AS ids_29 FROM p
""", ("TXT-8", "TXT-9", "TXT-5"))
def txt08_pad_pre(spark, base):
    d = _doc_tokens(spark, base)
    # unknown tokens keep their place, so only the last 30 tokens of a document can reach the padded row
    last = d.select("doc_id", tx.last_tokens("toks", 30).alias("toks"))
    seq = tx.to_ids(last, "doc_id", "toks", tx.top_vocabulary(d, "toks", 19999), out="ids", oov=0, vocab_rows=19999)
    seq = seq.select("doc_id", tx.pad_pre("ids", 30).alias("ids_30"))
    return seq.select("doc_id", "ids_30", tx.drop_position("ids_30", 29).alias("ids_29"))


_KERAS_SQL = f"""WITH w AS (SELECT conv_id, turn,
    list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '{_KERAS_CLASS}', ' ', 'g'), ' '), lambda x: x <> '') AS words
  FROM conversations),
e AS (SELECT conv_id, turn, unnest(words) AS token, unnest(generate_series(0, len(words) - 1)) AS pos FROM w),
f AS (SELECT token, count(*) AS n, min((conv_id, turn, pos)) AS first FROM e GROUP BY token),
idx AS (SELECT token, row_number() OVER (ORDER BY n DESC, first) AS id FROM f ORDER BY n DESC, first LIMIT 9999)"""


@query("txt06_keras_tokenizer", _KERAS_SQL + """,
s AS (SELECT conv_id, turn, list(CAST(id AS INTEGER) ORDER BY pos) AS seq FROM e JOIN idx USING (token) GROUP BY conv_id, turn),
p AS (SELECT w.conv_id, w.turn, coalesce(seq, []) AS seq FROM w LEFT JOIN s ON w.conv_id = s.conv_id AND w.turn = s.turn)
SELECT conv_id, turn, len(seq) AS seq_len, (list_transform(range(30), lambda x: 0) || seq)[-30:] AS padded FROM p
""", ("TXT-6", "TXT-8", "SRT-7", "SET-1"))
def txt06_keras_tokenizer(spark, base):
    c = tables(spark, base).conversations.select(*MSG_KEY, tx.keras_words("text").alias("words"))
    idx = tx.frequency_index(c, MSG_KEY, "words", 10000)
    seq = tx.to_ids(c, MSG_KEY, "words", idx, out="seq", oov=None, vocab_rows=10000)
    return seq.select(*MSG_KEY, F.size("seq").cast("bigint").alias("seq_len"), tx.pad_pre("seq", 30).alias("padded"))


@query("txt10_embedding_matrix", _TOP_SQL + """
SELECT id, token, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 6)) AS vector
FROM tv JOIN embeddings ON id = vec_id WHERE id < 13000
""", ("TXT-10", "SRC-13", "Q8"))
def txt10_embedding_matrix(spark, base):
    vocab = tx.top_vocabulary(_doc_tokens(spark, base), "toks", 19999)
    vec = tables(spark, base).embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return rounded(tx.embedding_matrix(vocab, vec, 13000, on="id"))


@query("txt11_bag_of_words", f"""
WITH t AS ({_CONV_TOKENS_SQL})
SELECT conv_id, turn, token, count(*) AS count FROM (SELECT conv_id, turn, unnest(toks) AS token FROM t)
GROUP BY conv_id, turn, token
""", ("TXT-11",))
def txt11_bag_of_words(spark, base):
    return tx.bag_of_words(_conv_tokens(spark, base), MSG_KEY, "toks")


@query("txt12_corpus_stats", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{PAT}') AS toks FROM documents)
SELECT (SELECT count(DISTINCT token) FROM (SELECT unnest(toks) AS token FROM t)) AS vocab_size,
  max(len(toks)) AS longest, sum(len(toks)) AS n_tokens, count(*) AS n_docs FROM t
""", ("TXT-12", "SRT-7"))
def txt12_corpus_stats(spark, base):
    d = _doc_tokens(spark, base)
    # lengths need no exploded tokens; only the vocabulary does, and its rows shrink to distinct tokens per task
    size = F.size("toks").cast("bigint")
    lengths = d.agg(F.max(size).alias("longest"), F.sum(size).alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"))
    vocab = d.select(F.explode("toks").alias("t")).distinct().agg(F.count("t").alias("vocab_size"))
    return vocab.join(F.broadcast(lengths)).select("vocab_size", "longest", "n_tokens", "n_docs")  # one row each


@query("txt01_treebank_tokens", f"""
WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array({tb.rewritten_sql('text')}, '[ \\n\\t\\r\\x0b\\x0c]+'), lambda x: x <> '')) AS token FROM documents)
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM t GROUP BY token
""", ("TXT-1",))
def txt01_treebank_tokens(spark, base):
    """How often each Treebank token occurs, and in how many texts."""
    d = tables(spark, base).documents.select("doc_id", F.explode(tb.treebank_tokens("text")).alias("token"))
    per = d.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("n"))  # pre-aggregated: a frequent token is a row a text
    return per.groupBy("token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs"))
