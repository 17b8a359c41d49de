"""Language identification: averaged hashed subword embeddings and a linear softmax.

Features of a text are its byte n-grams of 2 to 4 bytes inside words (ASCII letters lower-cased, a
separator may stand at either end as the word's border), hashed into buckets. The text's vector is the
mean of the buckets' embeddings; a linear softmax gives the languages. Embeddings and softmax are
trained together by stochastic gradient descent in numpy on the driver, on a bounded sample: about
``rows`` labelled documents, as many of each language as there are, chosen by a hash of the id. A fifth
of the sample is kept out of training and sets the softmax temperature and the rejection score, the
least at which accepted predictions are right often enough.

Since mean and softmax input are linear, prediction only sums one number for each n-gram and language;
these are held in fixed point, so results do not depend on partitioning. It is one pass over whole texts.

Bounds: at most ``rows`` rows of at most ``BUCKETS`` counts reach the driver, and one number for each
distinct language value.

Defined edge cases: a null text or one without a letter is ``und`` with score 1.0 and not accepted;
without any labelled row every text is ``und`` with score 0.0; rows without a language or id are not
learned from; repeated rows are predicted each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.llm.common import LOWER, Block, blocks, byte_set

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
DIM = 16
ROWS = 2400
EPOCHS = 12
PER_STEP = 384  # n-grams drawn from a text at a training step
PRECISION = 0.99
FIXED = 1 << 24
NONE = "und"
SEPARATOR = byte_set((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (buckets, languages), fixed point
    bias: np.ndarray
    temperature: float
    least_score: float


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def _grams(block: Block):
    """Yield the bucket of the n-gram at each place and whether there is one, for each n."""
    d = LOWER[block.data]
    sep = SEPARATOR[d]
    edge = np.zeros(len(d) + 1, dtype=bool)
    edge[block.offsets] = True
    for n in SIZES:
        m = len(d) - n + 1
        if m <= 0:
            continue
        g = np.full(m, n * 0x3C6EF372 & 0xFFFFFFFF, dtype=np.uint32)
        ok = ~(sep[:m] & sep[n - 1:n - 1 + m])
        for k in range(n):
            g = (g ^ np.where(sep[k:k + m], 0x20, d[k:k + m]).astype(np.uint32)) * np.uint32(0x01000193)
            if 0 < k < n - 1:
                ok &= ~sep[k:k + m]
            if k:
                ok &= ~edge[k:k + m]
        g ^= g >> np.uint32(15)
        g *= np.uint32(0x2C1B3C6D)
        yield (g >> np.uint32(17)).astype(np.int64), ok


def _sample(docs: DataFrame, rows: int) -> list:
    """``(lang, buckets, counts)`` of about ``rows`` documents that may be learned from."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    count = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row a language
    if not count:
        return []
    each = -(-rows // len(count))
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).cast("double") / (1 << 30)
    share = docs.sparkSession.createDataFrame([(k, min(1.0, each / n)) for k, n in sorted(count.items())], "lang string, share double")
    chosen = usable.join(F.broadcast(share), "lang").where(unit < F.col("share")).select("doc_id", "lang", "text")

    def features(batches):
        for b in blocks(batches):
            found = [[] for _ in range(len(b))]
            for g, ok in _grams(b):
                for i in range(len(b)):
                    a, z = b.offsets[i], b.offsets[i + 1]
                    found[i].append(g[a:z][ok[a:z]])
            pairs = [np.unique(np.concatenate(f), return_counts=True) if f else (np.zeros(0, int),) * 2 for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.rows.column(0), b.rows.column(1), *(pa.array([p[k].astype("<i4").tobytes() for p in pairs], pa.binary()) for k in (0, 1))],
                ["doc_id", "lang", "buckets", "counts"])

    return (chosen.mapInArrow(features, "doc_id long, lang string, buckets binary, counts binary")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(2 * rows).collect())


def fit(docs: DataFrame, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Train on a bounded sample of ``docs`` and calibrate on the part of it kept out."""
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    data = [(r.lang, np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.counts, "<i4")) for r in _sample(plain, rows)]
    data = [x for x in data if len(x[1])]
    languages = sorted({x[0] for x in data})
    k = len(languages)
    if not k:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.int64), np.zeros(0), 1.0, 1.0)
    label = np.array([languages.index(x[0]) for x in data])
    train = [i for i in range(len(data)) if i % 5] or list(range(len(data)))
    check = [i for i in range(len(data)) if not i % 5]
    rng = np.random.default_rng(17)
    emb = rng.normal(0, 1 / DIM, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, k)), np.zeros(k)
    cdf = {i: np.cumsum(data[i][2]) for i in train}
    steps, total = 0, EPOCHS * len(train)
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            rate = 0.5 * (1 - steps / total)
            steps += 1
            at = data[i][1][np.searchsorted(cdf[i], rng.integers(0, cdf[i][-1], PER_STEP), side="right")]
            v = emb[at].mean(axis=0)
            z = v @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = out @ p
            out -= rate * np.outer(v, p)
            bias -= 0.1 * rate * p
            np.add.at(emb, at, -rate * 10 * back / PER_STEP)
    weight = emb @ out
    logits = np.array([data[i][2] @ weight[data[i][1]] / data[i][2].sum() + bias for i in check])
    truth = label[check]
    best = min(np.geomspace(0.05, 20, 120), key=lambda t: (_nll(logits / t, truth), t))
    score = _softmax(logits / best)
    top, right = score.max(axis=1), score.argmax(axis=1) == truth
    order = np.argsort(-top, kind="stable")
    good = np.cumsum(right[order]) >= PRECISION * np.arange(1, len(order) + 1)
    least = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return LanguageModel(languages, np.round(weight * FIXED).astype(np.int64), bias, float(best), least)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _nll(z: np.ndarray, truth: np.ndarray) -> float:
    return float(-np.log(np.maximum(_softmax(z)[np.arange(len(truth)), truth], 1e-12)).mean())


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (calibrated probability of it) and ``accepted`` (the score
    reaches the model's rejection score)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    k = len(model.languages)
    ascii_letter = ~SEPARATOR & (np.arange(256) < 0x80)

    def run(batches):
        for b in blocks(batches):
            sums, n = np.zeros((len(b), k)), np.zeros(len(b), dtype=np.int64)
            for g, ok in _grams(b):
                per_byte = np.zeros(len(b.data), dtype=np.int64)
                per_byte[:len(g)] = ok
                n += b.sums(per_byte)
                for c in range(k):
                    per_byte[:len(g)] = np.where(ok, model.table[g, c], 0)
                    sums[:, c] += b.sums(per_byte)
            letter = b.sums(ascii_letter[b.data]) > 0
            for i in np.flatnonzero(~letter & (b.sums(b.data >= 0x80) > 0)):
                letter[i] = bool(_LETTER.search(bytes(b.data[b.offsets[i]:b.offsets[i + 1]]).decode(errors="replace")))
            if k:
                p = _softmax((sums / FIXED / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
                name, score = np.array(model.languages, dtype=object)[p.argmax(axis=1)], p.max(axis=1)
            else:
                name, score = np.full(len(b), NONE, dtype=object), np.zeros(len(b))
            name[~letter] = NONE
            score = np.where(letter, score, 1.0 if k else 0.0)
            yield pa.RecordBatch.from_arrays([b.rows.column(0), pa.array(list(name), pa.string()), pa.array(score),
                                              pa.array(letter & (score >= model.least_score))],
                                             ["doc_id", "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")
