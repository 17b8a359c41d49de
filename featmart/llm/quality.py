"""Quality rules: word statistics of whole texts and a hashed n-gram log-likelihood ratio.

Every text is described by hashed byte n-grams. Two multinomials are estimated: the *target* from
the texts of trusted labelled documents, the *raw* one from every document. A text's score is the
mean over its n-grams of ``log(p_target / p_raw)``; a document is kept if it passes the base rules
and its score reaches a threshold chosen on the labelled rows. All sums are integers (the ratio is
held in fixed point), so scores and verdicts do not depend on partitioning or task order.

Bounds: the labelled sample has at most ``label_rows`` rows (it is broadcast); the count table has
``buckets`` rows; the threshold is chosen from a histogram of ``label_rows`` rows at most. Counts and
scores themselves cover every document and whole texts.

Defined edge cases: a null or empty text has no words, fails the base rules and has a null score; a
text without n-grams is judged by the base rules alone; repeated rows are judged each by itself and
all count for the raw multinomial; without labels of both kinds there is no threshold and the base
rules decide; conflicting labels of one document count as not trusted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featmart.llm.common import (SPACE, Block, blocks, byte_set, gram_hash, id_text, inside, let_go,
                                 prefix_hash, range_hash, repeated)

GRAM = 4
BUCKETS = 1 << 16
LABEL_ROWS = 20_000
TEXT_AT_ONCE = 1 << 18  # bytes of text handled at once in a task: every measure has several numbers for each byte
FIXED = 1 << 16  # fixed-point unit of the log ratio
BIN = FIXED >> 8  # width of a threshold bin
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = byte_set(*((ord(c), ord(c)) for c in "#*$%&|<>"))
NEWLINE = byte_set((0x0A, 0x0A))


@dataclass(frozen=True)
class QualityModel:
    """``ratio`` fixed-point log ratio per bucket; ``threshold`` in the same unit (None: no model)."""
    ratio: np.ndarray
    threshold: int | None


def _buckets(block: Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every byte start, and whether the n-gram lies inside one text."""
    d = block.data
    m = max(0, len(d) - GRAM + 1)
    g = np.zeros(m, dtype=np.uint32)
    for k in range(GRAM):
        g |= d[k:k + m].astype(np.uint32) << np.uint32(8 * k)
    g *= np.uint32(2654435761)
    g ^= g >> np.uint32(15)
    ok = inside(np.diff(block.offsets), block.offsets, GRAM, len(d))
    return (g & np.uint32(buckets - 1)).astype(np.int64), ok


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, raw, target, other)``: n-gram counts over all rows, over trusted and over untrusted
    rows. ``docs`` has ``text`` and ``trusted`` (1, 0 or null). Each task sums its rows before the
    shuffle, which then carries at most ``buckets`` rows from a task."""

    def count(batches):
        let_go()
        total = np.zeros((3, buckets), dtype=np.int64)
        for b in blocks(batches, limit=TEXT_AT_ONCE):
            g, ok = _buckets(b, buckets)
            label = b.rows.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            which = np.repeat(label, np.diff(b.offsets))[:len(g)]
            total[0] += np.bincount(g[ok], minlength=buckets)
            for row, value in ((1, 1), (2, 0)):
                if (label == value).any():
                    total[row] += np.bincount(g[ok & (which == value)], minlength=buckets)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(t[at]) for t in total)],
                                         ["bucket", "raw", "target", "other"])

    rows = docs.select("text", "trusted").mapInArrow(count, "bucket long, raw long, target long, other long")
    return rows.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "target", "other")))


def _scores(block: Block, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-point score (floor of the mean) and number of n-grams of each text."""
    g, ok = _buckets(block, len(ratio))
    value = np.zeros(len(block.data), dtype=np.int64)
    value[:len(g)] = np.where(ok, ratio[g], 0)
    n = np.maximum(np.diff(block.offsets) - GRAM + 1, 0)
    return block.sums(value) // np.maximum(n, 1), n


def label_sample(labels: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents, the first by a hash of their id: ``(doc_id, trusted)``."""
    one = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
           .agg(F.min(F.col("quality").cast("int")).alias("trusted")))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, label_rows: int = LABEL_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Estimate both multinomials and choose the threshold.

    The threshold is the lowest of the bin edges that best separate labelled rows (greatest sum of
    the share of trusted rows kept and of untrusted rows rejected).
    """
    plain = id_text(docs, id_col, text_col)
    sample = F.broadcast(label_sample(labels, label_rows))  # bounded by label_rows
    counts = np.zeros((3, buckets), dtype=np.int64)
    for r in gram_counts(plain.join(sample, "doc_id", "left"), buckets).collect():  # <= buckets rows
        counts[:, r.bucket] = (r.raw, r.target, r.other)
    log_p = [np.log((c + 1.0) / (c.sum() + buckets)) for c in counts]
    ratio = np.round((log_p[1] - log_p[0]) * FIXED).astype(np.int64)
    if not (counts[1].any() and counts[2].any()):
        return QualityModel(ratio, None)

    def score(batches):
        let_go()
        for b in blocks(batches, limit=TEXT_AT_ONCE):
            s, n = _scores(b, ratio)
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(s[some] // BIN), b.rows.column(1).filter(pa.array(some))],
                                             ["bin", "trusted"])

    bins = (plain.join(sample, "doc_id").select("text", "trusted").mapInArrow(score, "bin long, trusted int")
            .groupBy("bin").agg(F.sum("trusted").alias("good"), F.sum(1 - F.col("trusted")).alias("bad"))
            .orderBy("bin").collect())
    good, bad = (sum(r[k] for r in bins) for k in ("good", "bad"))
    if not good or not bad:
        return QualityModel(ratio, None)
    best, threshold, lost, caught = -1.0, None, 0, 0
    for r in bins:
        value = (good - lost) / good + caught / bad
        if value > best:
            best, threshold = value, r.bin * BIN
        lost, caught = lost + r.good, caught + r.bad
    return QualityModel(ratio, threshold)


def _measures(block: Block) -> list[np.ndarray]:
    starts, ends = block.words(SPACE)
    per_text, first = block.counts(starts)
    prefix = prefix_hash(block.data)
    in_word = ~SPACE[block.data] & ((block.data & 0xC0) != 0x80)
    # lines: cut at newlines and text ends
    cut = np.flatnonzero(NEWLINE[block.data])
    line_start = np.union1d(cut + 1, block.offsets[:-1])
    owner = np.searchsorted(block.offsets, line_start, side="right") - 1
    limit = block.offsets[np.minimum(owner + 1, len(block))]
    next_cut = np.append(cut, len(block.data))[np.searchsorted(cut, line_start)]
    line_end = np.minimum(next_cut, limit)
    n_words = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
    full = (n_words > 0) & (line_end > line_start)
    owner = owner[full]
    keys = np.stack([owner.astype(np.uint64), range_hash(prefix, line_start[full], line_end[full])])
    order = np.lexsort(keys[::-1])
    same = (np.diff(keys[:, order], axis=1) == 0).all(axis=0) if len(order) else np.zeros(0, bool)
    dup_lines = np.bincount(owner[order][1:][same], minlength=len(block))
    # three-word windows found twice in the same text
    h = range_hash(prefix, starts, ends)
    tri = gram_hash(h, 3)
    ok = inside(per_text, first, 3, len(h))
    text_of = np.repeat(np.arange(len(block)), per_text)
    at = np.flatnonzero(ok)
    twice = at[repeated(tri[at] ^ (text_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))]
    hit = np.zeros(len(h) + 1, dtype=bool)
    for k in range(3):
        hit[twice + k] = True
    repeat = np.bincount(text_of[hit[:-1]], minlength=len(block))
    return [per_text, block.sums(in_word), block.sums(SYMBOLS[block.data]), dup_lines, repeat]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the five measures, ``base_failed``, ``llr`` (null without n-grams)
    and ``kept``; columns named in ``keep`` are passed through, but for those named like a result.
    A text that is kept goes to the workers once. A single pass without a shuffle."""
    results = ("doc_id", "__text", *MEASURES, "base_failed", "llr", "kept")
    names = ["doc_id", *(c for c in keep if c.lower() not in results)]
    judged = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"), F.col(f"`{id_col}`").alias("doc_id"),
                         *(F.col(f"`{c}`") for c in names[1:]))
    fields = judged.schema.fields[1:]
    once = [c == text_col and f.dataType == T.StringType() for c, f in zip(names, fields)]
    rows = judged.select("__text", *(f"`{c}`" for c, same in zip(names, once) if not same))
    place = [0 if same else k + 1 - sum(once[:k]) for k, same in enumerate(once)]  # of each name's column in a batch
    schema = T.StructType([*fields, *(T.StructField(m, T.LongType()) for m in MEASURES), T.StructField("base_failed", T.BooleanType()),
                           T.StructField("llr", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        let_go()
        for b in blocks(batches, "__text", TEXT_AT_ONCE):
            m = _measures(b)
            n_words, n_repeat = m[0], m[4]
            failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
            s, n = _scores(b, model.ratio)
            good = np.ones(len(b), bool) if model.threshold is None else (n == 0) | (s >= model.threshold)
            yield pa.RecordBatch.from_arrays(
                [*(b.rows.column(k) for k in place), *(pa.array(x.astype(np.int64)) for x in m),
                 pa.array(failed), pa.array(s / FIXED, mask=n == 0), pa.array(~failed & good)],
                [*names, *MEASURES, "base_failed", "llr", "kept"])

    return rows.mapInArrow(run, schema)
