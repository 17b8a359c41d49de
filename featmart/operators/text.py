"""Text preparation (TXT-*): tokens, vocabularies, id sequences, padding.

Documents are processed whole. Tokenising is a JVM regex (``regexp_extract_all``); vocabularies are
``explode -> groupBy`` jobs; mapping tokens to ids is ``posexplode -> join -> ordered re-collect`` per
document, so the vocabulary never goes through the driver and a frequent token is handled by partial
aggregation / AQE skew-join splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.operators.relational import with_global_row_number

# --- fixed values -------------------------------------------------------------------------------
# word or single non-space symbol; Unicode letter/number classes so accented words stay whole
WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
# punctuation removed by the frequency tokenizer (its default filter set, then split on ' ')
KERAS_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'
# punctuation marks removed from the vocabulary together with the stop words (TXT-3)
VOCAB_PUNCTUATION = [".", ",", '"', "'", "?", "!", ":", ";", "(", ")", "[", "]", "{", "}"]
# English stop-word list used for vocabulary filtering (the common 179-word list)
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's",
    "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did",
    "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same",
    "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've",
    "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't",
    "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn",
    "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]
# -------------------------------------------------------------------------------------------------


def tokens(text: Column | str, lower: bool = False) -> Column:
    """TXT-1: words and single punctuation marks, in order (``array<string>``); NULL text -> []."""
    t = F.col(text) if isinstance(text, str) else text
    if lower:
        t = F.lower(t)
    return F.coalesce(F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0), F.array().cast("array<string>"))


def _regex_class(chars: str) -> str:
    return "[" + "".join("\\" + ch if not ch.isalnum() else ch for ch in chars) + "]"


def keras_words(text: Column | str, filters: str = KERAS_FILTERS, lower: bool = True) -> Column:
    """TXT-6 word split: lower-case, every filter character -> ' ', split on ' ', drop empties."""
    t = F.col(text) if isinstance(text, str) else text
    if lower:
        t = F.lower(t)
    t = F.regexp_replace(F.coalesce(t, F.lit("")), _regex_class(filters), " ")
    return F.filter(F.split(t, " "), lambda w: w != F.lit(""))


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def explode_tokens(df: DataFrame, key, tokens_col: str) -> DataFrame:
    """ARR-4: one row per ``(key..., pos, token)``; ``key`` is a column name or a list of names."""
    return df.select(*_keys(key), F.posexplode(tokens_col).alias("pos", "token"))


def sorted_vocabulary(df: DataFrame, tokens_col: str, start_id: int = 1,
                      exclude: DataFrame | None = None) -> DataFrame:
    """TXT-2/3, SET-3/4, SRT-9: distinct tokens in sorted order with ids from ``start_id``.

    ``exclude`` (one column ``token``) is removed first with an anti join (stop words etc.).
    """
    voc = df.select(F.explode(tokens_col).alias("token")).distinct()
    if exclude is not None:
        voc = voc.join(exclude.select("token"), "token", "left_anti")
    num = with_global_row_number(voc, ["token"], "id")
    return num.select("token", (F.col("id") + (start_id - 1)).alias("id"))


def token_counts(df: DataFrame, tokens_col: str) -> DataFrame:
    """Corpus frequency per token (partial aggregation first)."""
    return df.select(F.explode(tokens_col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def top_vocabulary(df: DataFrame, tokens_col: str, n: int, start_id: int = 1) -> DataFrame:
    """TXT-4 / SRT-4: the ``n`` most frequent tokens (ties: smaller token first), id = rank.

    ``orderBy().limit(n)`` is the top-k operator; each partition keeps its own top n.
    """
    top = token_counts(df, tokens_col).orderBy(F.desc("n"), F.asc("token")).limit(n)
    # at most n rows (the limit is the operator), so numbering them in one window is bounded work
    w = Window.orderBy(F.desc("n"), F.asc("token"))
    return top.select("token", "n", (F.row_number().over(w) + (start_id - 1)).alias("id"))


def frequency_index(df: DataFrame, key, words_col: str, num_words: int | None) -> DataFrame:
    """TXT-6 fit: word index ranked by frequency, ties by first appearance (document ``key`` order,
    then position); keeps indices ``< num_words`` (index 0 is reserved)."""
    ks = _keys(key)
    ex = explode_tokens(df, ks, words_col)
    stats = ex.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*ks, "pos")).alias("__first"))
    stats = stats.select("token", "n", (-F.col("n")).alias("__neg"),
                         *[F.col(f"__first.{k}").alias(f"__k{i}") for i, k in enumerate(ks)],
                         F.col("__first.pos").alias("__p"))
    order = ["__neg", *[f"__k{i}" for i in range(len(ks))], "__p"]
    if num_words is not None:
        # bounded by num_words rows: number them with one window
        stats = stats.orderBy(*order).limit(max(num_words - 1, 0))
        return stats.select("token", "n", F.row_number().over(Window.orderBy(*order)).alias("id"))
    num = with_global_row_number(stats, order, "id")
    return num.select("token", "n", "id")


def to_ids(df: DataFrame, key, tokens_col: str, vocab: DataFrame, out: str = "ids",
           oov: int | None = 0, vocab_rows: int | None = None) -> DataFrame:
    """TXT-5 / TXT-6 apply: tokens -> ids in order. ``oov=0`` maps unknown tokens to 0 (TXT-5);
    ``oov=None`` drops them (TXT-6). Documents without tokens get ``[]``. Returns ``(key..., out)``.

    ``vocab_rows``: the vocabulary's size where it is an operator's parameter; up to a million rows it
    is broadcast, so that tokens stay with their document until the regroup."""
    ks = _keys(key)
    ex = df.select(*ks, F.posexplode_outer(tokens_col).alias("pos", "token"))  # keeps empty documents
    v = vocab.select("token", "id")
    j = ex.join(F.broadcast(v) if vocab_rows is not None and vocab_rows <= 1_000_000 else v, "token", "left")
    wanted = F.col("pos").isNotNull() & (F.col("id").isNotNull() if oov is None else F.lit(True))
    entry = F.when(wanted, F.struct("pos", F.coalesce(F.col("id"), F.lit(oov if oov is not None else 0)).cast("int").alias("id")))
    seqs = j.groupBy(*ks).agg(F.array_sort(F.collect_list(entry)).alias("__s"))  # NULL entries are not collected
    return seqs.select(*ks, F.transform("__s", lambda s: s["id"]).alias(out))


def last_tokens(tokens_col: Column | str, n: int) -> Column:
    """The last ``n`` tokens, for ids that are padded and cut on the left anyway (TXT-8 with ``oov=0``)."""
    a = F.col(tokens_col) if isinstance(tokens_col, str) else tokens_col
    return F.slice(a, F.greatest(F.size(a) - n + 1, F.lit(1)), n)


def pad_post(arr: Column | str, n: int, value: int = 0) -> Column:
    """TXT-7: keep the first ``n`` ids, pad on the right."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.slice(F.concat(a, F.array_repeat(F.lit(value), n)), 1, n)


def pad_pre(arr: Column | str, n: int, value: int = 0) -> Column:
    """TXT-8 (``pad_sequences`` defaults): keep the last ``n`` ids, pad on the left."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.slice(F.concat(F.array_repeat(F.lit(value), n), a), -n, n)


def drop_position(arr: Column | str, i: int) -> Column:
    """TXT-9: remove the element at 0-based position ``i`` (``np.delete(x, i, 1)``)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.concat(F.slice(a, 1, i), F.slice(a, i + 2, F.greatest(F.size(a) - i - 1, F.lit(0))))


def bag_of_words(df: DataFrame, key, tokens_col: str) -> DataFrame:
    """TXT-11: ``(key..., token, count)`` -- the sparse document-term matrix."""
    ks = _keys(key)
    return (df.select(*ks, F.explode(tokens_col).alias("token"))
            .groupBy(*ks, "token").agg(F.count(F.lit(1)).alias("count")))


def embedding_matrix(vocab: DataFrame, vectors: DataFrame, max_words: int, on: str = "token",
                     vector_col: str = "vector") -> DataFrame:
    """TXT-10: ``(id, token, vector)`` for vocabulary words with a vector and ``id < max_words``.

    ``on`` names the vocabulary column the vector table is keyed by (``token``, or ``id`` for
    vectors keyed by word rank). Q8 fixed: the matrix row is the word id, not a running counter.
    """
    v = vocab.where(F.col("id") < max_words)
    return v.join(vectors.select(on, F.col(vector_col).alias("vector")), on).select("id", "token", "vector")
