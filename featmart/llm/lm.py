"""Language-model scores of documents by stupid backoff over corpus n-gram counts.

The texts are kept as *segments*: some whole documents as numbers into the segment's own vocabulary.
Every segment explodes its n-grams of each order, adds up equal ones and sends them, as packed sorted
hashes with counts, to the count table's partition that their hash belongs to. A partition adds the
counts of all segments and joins the totals back to the n-grams that asked for them; the replies are
grouped by segment, where each document's score is summed. A frequent n-gram is one entry from a
segment, so no partition gets more than its share; partitions are as many as the words need.

``S(w | context) = c(context w) / c(context)`` if that n-gram was seen, else ``ALPHA`` times the score
with the context shortened by its first word; for a single word the context count is the number of
words, and a word never seen counts as ``ALPHA`` occurrences. By default a document is scored by all
*other* documents: its own counts are taken off. Scores are sums of ``log10``. N-grams of three words
or more are asked for only where both shorter n-grams inside them occur elsewhere (others cannot).

Bounds: ``SEGMENT_BYTES`` of text, or one longer text, in a segment; about ``PARTITION_WORDS`` distinct
n-grams in a count partition. n-grams are identified by 64-bit hashes.

Defined edge cases: a null, empty or wordless text has no words and the score 0.0, and a null mean;
n-grams do not cross documents; repeated rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.llm.common import LOWER, NON_WORD, blocks, gram_hash, id_text, inside, prefix_hash, range_hash, stored
from featmart.llm.packed import Items, answers, bits_for, squeeze, totals, unsqueeze

ORDER = 3
ALPHA = 0.4
SEGMENT_BYTES = 7 << 19
PARTITION_WORDS = 1 << 19

_SCORE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64())])


def segments(docs: DataFrame, scored: bool, counted: bool, id_col: str, text_col: str) -> DataFrame:
    """Texts as segments: ``scored`` ones get a score, ``counted`` ones are part of the corpus."""

    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            words = np.concatenate([h[1] for h in held])
            vocab, token = np.unique(words, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + number]), pa.array([len(words)]), pa.array([[i for h in held for i in h[0]]], pa.list_(pa.int64())),
                 pa.array([np.concatenate([h[2] for h in held]).astype("<i4").tobytes()]), pa.array([vocab.astype("<u8").tobytes()]),
                 pa.array([squeeze(token.astype("<u4"))])], ["segment", "n_words", "doc_ids", "lengths", "vocabulary", "tokens"])

        for b in blocks(batches):
            if held and size + len(b.data) > SEGMENT_BYTES:
                yield flush()
                number, held, size = number + 1, [], 0
            starts, ends = b.words(NON_WORD)
            held.append((b.rows.column(0).to_pylist(), range_hash(prefix_hash(b.data, LOWER), starts, ends), b.counts(starts)[0]))
            size += len(b.data)
        if held:
            yield flush()

    plain = id_text(docs, id_col, text_col).mapInArrow(
        run, "segment long, n_words long, doc_ids array<long>, lengths binary, vocabulary binary, tokens binary")
    return plain.withColumns({"scored": F.lit(scored), "counted": F.lit(counted)})


class _Segment:
    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        vocab = np.frombuffer(row["vocabulary"], "<u8")
        self.words = vocab[unsqueeze(row["tokens"], row["n_words"], "<u4")]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word's place of every n-gram inside a document."""
        at = np.flatnonzero(inside(self.lengths, self.first, n, len(self.words)))
        return gram_hash(self.words, n)[at], at


class _Counts:
    """Corpus counts of a segment's n-grams, order by order, as the count tables know them.

    ``seen[k]`` has, for the last word of every n-gram of order ``k``, its count (less the document's own
    ones if ``leave_out``). An n-gram of three words or more occurs elsewhere only if both n-grams inside
    it do, so no others are asked for; they have the count 0.
    """

    def __init__(self, seg: _Segment, totals_by_order: dict[int, np.ndarray], upto: int, leave_out: bool):
        n = len(seg.words)
        doc = np.repeat(np.arange(len(seg.lengths)), seg.lengths)
        self.seg, self.seen = seg, np.zeros((upto + 1, n))
        for k in range(1, upto + 1):
            h, at = self.wanted(k)
            uniq, place = np.unique(h, return_inverse=True)
            del h
            total = totals_by_order[k][place] if len(at) else np.zeros(0, np.int64)
            if leave_out:
                place += doc[at] * np.int64(len(uniq) + 1)
                _, same, count = np.unique(place, return_inverse=True, return_counts=True)
                total -= count[same]
                del same, count
            self.seen[k, at + k - 1] = total

    def wanted(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of the n-grams of order ``k`` that can occur elsewhere."""
        h, at = self.seg.grams(k)
        if k > 2:
            before = self.seen[k - 1]
            some = (before[at + k - 2] > 0) & (before[at + k - 1] > 0)
            h, at = h[some], at[some]
        return h, at


def _short_grams(order: int):
    """Distinct words and pairs of a segment, with counts if the segment is part of the corpus."""

    def items(row: dict) -> Items:
        seg = _Segment(row)
        for n in range(1, min(order, 2) + 1):
            yield n, *_distinct(seg.grams(n)[0], row["counted"])

    return items


def _distinct(hashes: np.ndarray, counted: bool) -> tuple[np.ndarray, np.ndarray]:
    uniq, count = np.unique(hashes, return_counts=True)
    return uniq, count if counted else np.zeros_like(count)


_ASK = "segment long, wanted boolean, space int, hashes binary, counts binary"
_ASK_ARROW = pa.schema([("segment", pa.int64()), ("wanted", pa.bool_()), ("space", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _long_grams(order: int, leave_out: bool):
    """N-grams of one order that a segment asks for, from what is known of the order below; a segment that
    is not scored knows nothing and sends all."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, known = [], answers(right.to_pylist())
        for row in left.to_pylist():
            seg = _Segment(row)
            hashes = _Counts(seg, known, order - 1, leave_out).wanted(order)[0] if row["scored"] else seg.grams(order)[0]
            uniq, count = _distinct(hashes, row["counted"])
            out.append(dict(zip(_ASK_ARROW.names, (row["segment"], row["scored"], order, uniq.astype("<u8").tobytes(), count.astype("<u4").tobytes()))))
        return pa.Table.from_pylist(out, _ASK_ARROW)

    return run


def _asked(row: dict) -> Items:
    yield row["space"], np.frombuffer(row["hashes"], "<u8"), np.frombuffer(row["counts"], "<u4")


def _scores(order: int, alpha: float, n_total: int, leave_out: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        replies = answers(right.to_pylist())
        for row in left.to_pylist():
            seg = _Segment(row)
            n = len(seg.words)
            doc = np.repeat(np.arange(len(seg.lengths)), seg.lengths)
            inner = np.arange(n) - seg.first[:-1][doc] if n else np.zeros(0, np.int64)
            own = seg.lengths[doc] if leave_out else np.zeros(n, np.int64)
            context = (n_total - own).astype(np.float64)  # count of the empty context
            score = np.zeros(n)
            seen = _Counts(seg, replies, order, leave_out).seen
            log_alpha = np.log10(alpha)
            done = np.zeros(n, dtype=bool)
            back = np.zeros(n)
            for k in range(order, 0, -1):
                room = inner >= k - 1
                hit = ~done & room & (seen[k] > 0)
                before = np.concatenate([[0.0], seen[k - 1][:-1]]) if k > 1 else context
                score[hit] = back[hit] + np.log10(seen[k][hit] / before[hit])
                done |= hit
                if k > 1:
                    back[room & ~done] += log_alpha
            score[~done] = back[~done] + log_alpha - np.log10(np.maximum(context[~done], 1))
            sums = np.bincount(doc, weights=score, minlength=len(seg.lengths)) if n else np.zeros(len(seg.lengths))
            out.append(pa.Table.from_arrays([pa.array(seg.doc_ids, pa.int64()), pa.array(seg.lengths), pa.array(sums)], schema=_SCORE))
        return pa.concat_tables(out) if out else _SCORE.empty_table()
    return run


def score(docs: DataFrame, corpus: DataFrame | None = None, order: int = ORDER, alpha: float = ALPHA,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document of ``docs``: ``doc_id``, ``n_words``, ``log_score`` (sum over its words) and
    ``per_word``. Counts come from ``corpus``, or from the other rows of ``docs``."""
    segs = segments(docs, True, corpus is None, id_col, text_col)
    if corpus is not None:
        other = segments(corpus, False, True, id_col, text_col)
        segs = segs.unionByName(other.withColumn("segment", -1 - F.col("segment")))
    segs = stored(segs, "segments")
    size = segs.agg(F.sum("n_words").alias("all"), F.sum(F.when(F.col("counted"), F.col("n_words"))).alias("corpus")).first()
    bits = bits_for(size["all"] or 0, PARTITION_WORDS)
    leave_out = corpus is None
    replies = stored(totals(segs.withColumn("wanted", F.col("scored")), _short_grams(order), bits), "counts")
    for n in range(3, order + 1):
        asked = segs.groupBy("segment").cogroup(replies.groupBy("segment")).applyInArrow(_long_grams(n, leave_out), _ASK)
        replies = replies.unionByName(stored(totals(asked, _asked, bits), "counts"))
    out = segs.where("scored").groupBy("segment").cogroup(replies.groupBy("segment")).applyInArrow(
        _scores(order, alpha, size["corpus"] or 0, leave_out), "doc_id long, n_words long, log_score double")
    return out.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
