"""Benchmark decontamination over a positional inverted index of the training texts.

The index is a table of *segments*. A segment holds some whole documents: the sorted distinct terms
(64-bit hashes of lower-cased words), how often each occurs, and the word positions of each term in
ascending order. Documents never cross segments, so a phrase is answered inside one segment and a
query needs no shuffle; the segments are spread over the executors and stored in the shared folder.

A phrase starts from the posting list of its rarest term in the segment. Those positions, less the
term's offset in the phrase, are the candidate starts; the offset-adjusted lists of the other terms,
rarer ones first, are intersected with them. Proximity queries start from the rarest term too.

Bounds: a segment holds ``BLOCK_BYTES`` of text or a single longer one. Queries travel to the
segments in blocks of at most ``QUERY_BLOCK`` phrases, however many there are; every block meets
every segment.

Defined edge cases: a null or empty text has no words and is never contaminated; an item without
words or id has no window; an item of fewer than ``n`` words is one window of all of them; repeated
documents give a row each; repeated items count once; without items nothing is contaminated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.llm.common import LOWER, NON_WORD, blocks, id_text, prefix_hash, range_hash, stored

WINDOW = 13
QUERY_BLOCK = 50_000
CANDIDATES = 1 << 21  # candidate positions handled at once inside a segment

SEGMENT_SCHEMA = ("segment long, doc_ids array<long>, lengths binary, terms binary, freqs binary, "
                  "positions binary")
MATCH_SCHEMA = "segment long, doc_no int, doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _words(block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = block.words(NON_WORD)
    return starts, range_hash(prefix_hash(block.data, LOWER), starts, ends)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index every word of every text; stored, one row per segment."""

    def segments(batches):
        base, n = TaskContext.get().partitionId() << 32, 0
        for b in blocks(batches):
            starts, terms = _words(b)
            order = np.argsort(terms, kind="stable")  # by term, then position: the posting lists
            uniq, first = np.unique(terms[order], return_index=True)
            freqs = np.diff(np.append(first, len(terms))).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + n]), pa.array([b.rows.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([b.counts(starts)[0].astype("<i4").tobytes()]), pa.array([uniq.astype("<u8").tobytes()]),
                 pa.array([freqs.tobytes()]), pa.array([order.astype("<i4").tobytes()])],
                ["segment", "doc_ids", "lengths", "terms", "freqs", "positions"])
            n += 1

    return stored(id_text(docs, id_col, text_col).mapInArrow(segments, SEGMENT_SCHEMA), "postings")


class Segment:
    """One segment of the index, unpacked."""

    def __init__(self, row: dict):
        self.number, self.doc_ids = row["segment"], row["doc_ids"]
        self.lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
        self.doc_start = np.concatenate([[0], np.cumsum(self.lengths)])
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.freqs = np.frombuffer(row["freqs"], "<i4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.freqs)])
        self.positions = np.frombuffer(row["positions"], "<i4").astype(np.int64)
        # term number and position in one ascending key: any posting list is a range of it
        self.keys = np.repeat(np.arange(len(self.terms)) << 32, self.freqs) | self.positions

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and frequency (0: absent) of each term."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at, np.where(self.terms[at] == terms, self.freqs[at], 0)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_start, position, side="right") - 1

    def phrases(self, queries: "Phrases"):
        """Yield ``(phrase number, start position)`` arrays of every exact occurrence."""
        at, freq = self.find(queries.terms)
        slot_freq = freq[queries.slot_term]
        possible = np.minimum.reduceat(slot_freq, queries.first[:-1]) > 0 if len(queries) else np.zeros(0, bool)
        # slots of each phrase, rarest term first
        order = np.lexsort((slot_freq, queries.slot_phrase))
        numbers = np.flatnonzero(possible)
        rarest = order[queries.first[numbers]]
        sizes = slot_freq[rarest]
        ends = np.cumsum(sizes)
        i = 0
        while i < len(numbers):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CANDIDATES, side="right")))
            size, slot = sizes[i:j], rarest[i:j]
            phrase = np.repeat(numbers[i:j], size)
            inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            start = (self.positions[np.repeat(self.first[at[queries.slot_term[slot]]], size) + inner]
                     - np.repeat(slot - queries.first[numbers[i:j]], size))
            doc = self.doc_of(start)
            ok = (start >= 0) & (start + queries.length[phrase] <= self.doc_start[np.minimum(doc + 1, len(self.lengths))])
            phrase, start = phrase[ok], start[ok]
            for k in range(1, int(queries.length.max(initial=0))):
                if not len(phrase):
                    break
                more = queries.length[phrase] > k
                slot = order[np.minimum(queries.first[phrase] + k, len(order) - 1)]
                key = (at[queries.slot_term[slot]] << 32) | (start + slot - queries.first[phrase])
                found = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key
                phrase, start = phrase[found | ~more], start[found | ~more]
            yield phrase, start
            i = j

    def near(self, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the shortest span of at most ``within`` words that holds every term
        around each occurrence of the rarest one (at the leftmost, if several are as short)."""
        at, freq = self.find(np.unique(terms))
        if not len(freq) or not freq.min():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = at[np.argsort(freq, kind="stable")]
        lists = [self.positions[self.first[t]:self.first[t + 1]] for t in at]
        here = lists[0]
        doc = self.doc_of(here)
        low, high = self.doc_start[doc], self.doc_start[doc + 1]
        best_start, best_end = here * 0, np.full(len(here), np.iinfo(np.int64).max >> 1)
        # a shortest span begins at some term's last occurrence at or before the rarest term
        for left in lists:
            i = np.searchsorted(left, here, side="right") - 1
            start = np.where(i >= 0, left[np.maximum(i, 0)], -1)
            ok, end = start >= low, here + 1
            for other in lists:
                j = np.searchsorted(other, start)
                nxt = other[np.minimum(j, len(other) - 1)]
                ok &= (j < len(other)) & (nxt < high)
                end = np.maximum(end, nxt + 1)
            ok &= end - start <= within
            width, best = end - start, best_end - best_start
            better = ok & ((width < best) | ((width == best) & (start < best_start)))
            best_start, best_end = np.where(better, start, best_start), np.where(better, end, best_end)
        ok = best_end - best_start <= within
        return best_start[ok], best_end[ok]


class Phrases:
    """A block of phrases as flat arrays: ``slot_*`` has an entry for each word of each phrase."""

    def __init__(self, owners: list, phrases: list[list[int]]):
        self.owners = owners
        self.length = np.array([len(p) for p in phrases], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        flat = np.array([t for p in phrases for t in p], dtype=np.int64).view(np.uint64)
        self.terms, self.slot_term = np.unique(flat, return_inverse=True)
        self.slot_phrase = np.repeat(np.arange(len(phrases)), self.length)

    def __len__(self) -> int:
        return len(self.length)


def windows(items: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(item, phrase)``: every ``n`` consecutive words of an item, or all of fewer."""
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("item"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).where("item is not null")

    def cut(batches):
        for b in blocks(batches):
            starts, terms = _words(b)
            per_text, first = b.counts(starts)
            signed = terms.view(np.int64)
            owner, phrase = [], []
            for k, item in enumerate(b.rows.column(0).to_pylist()):
                own = signed[first[k]:first[k + 1]]
                for i in range(max(len(own) - n + 1, min(len(own), 1))):
                    owner.append(item)
                    phrase.append(own[i:i + n])
            yield pa.RecordBatch.from_arrays([pa.array(owner, pa.string()), pa.array(phrase, pa.list_(pa.int64()))],
                                             ["item", "phrase"])

    return rows.mapInArrow(cut, "item string, phrase array<long>").distinct()


def _query_blocks(queries: DataFrame, block: int):
    """The queries in blocks of about ``block`` rows, one on the driver at a time."""
    total = queries.count()
    parts = -(-total // block)
    for k in range(parts):
        yield queries.where(F.pmod(F.xxhash64(*queries.columns), F.lit(parts)) == k).collect() if parts > 1 else queries.collect()


def _merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of half-open ranges as ascending disjoint ranges."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > reach[:-1])
    return list(zip(start[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)].tolist()))


def phrase_matches(index: DataFrame, phrases: DataFrame, block: int = QUERY_BLOCK) -> DataFrame:
    """Every document with the merged word spans that any phrase covers and the items that own a
    phrase in it. ``phrases`` has ``item`` and ``phrase`` (term hashes, as from :func:`windows`)."""

    def search(queries: Phrases | None, every: bool):
        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    seg, found = Segment(row), {}
                    for number, start in (seg.phrases(queries) if queries else ()):
                        doc = seg.doc_of(start)
                        order = np.argsort(doc, kind="stable")
                        doc, number, start = doc[order], number[order], start[order]
                        for d, a, z in _runs(doc):
                            spans, items = found.setdefault(d, ([], set()))
                            spans.append((start[a:z], start[a:z] + queries.length[number[a:z]]))
                            items.update(queries.owners[x] for x in np.unique(number[a:z]))
                    docs = range(len(seg.lengths)) if every else sorted(found)
                    out = [(seg.number, d, seg.doc_ids[d], int(seg.lengths[d]),
                            [{"start": s - int(seg.doc_start[d]), "end": e - int(seg.doc_start[d])} for s, e in
                             _merged(*(np.concatenate(x) for x in zip(*found[d][0])))] if d in found else [],
                            sorted(found[d][1]) if d in found else []) for d in docs]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in out], t) for k, t in enumerate(_MATCH_ARROW)], _MATCH_NAMES)
        return run

    parts = [Phrases([r.item for r in rows], [r.phrase for r in rows]) for rows in _query_blocks(phrases, block)]
    if len(parts) <= 1:
        return index.mapInArrow(search(parts[0] if parts else None, True), MATCH_SCHEMA)
    found = index.mapInArrow(search(parts[0], True), MATCH_SCHEMA)
    for part in parts[1:]:
        found = found.unionByName(index.mapInArrow(search(part, False), MATCH_SCHEMA))
    # a document's spans from several query blocks: at most its own words from each block
    joined = found.groupBy("segment", "doc_no").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def merge(batches):
        for batch in batches:
            spans = [[{"start": s, "end": e} for s, e in _merged(*(np.array([x[k] for x in v]) for k in ("start", "end")))]
                     if v else [] for v in batch.column(4).to_pylist()]
            yield batch.set_column(4, "spans", pa.array(spans, _MATCH_ARROW[4]))

    return joined.select(*_MATCH_NAMES).mapInArrow(merge, MATCH_SCHEMA)


_MATCH_NAMES = ["segment", "doc_no", "doc_id", "n_words", "spans", "items"]
_MATCH_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]


def _runs(sorted_values: np.ndarray):
    """``(value, begin, end)`` of each run of equal values."""
    if not len(sorted_values):
        return
    cut = np.flatnonzero(np.diff(sorted_values)) + 1
    for a, z in zip(np.append(0, cut), np.append(cut, len(sorted_values))):
        yield int(sorted_values[a]), int(a), int(z)


def near_matches(index: DataFrame, queries: DataFrame, within: int, block: int = QUERY_BLOCK) -> DataFrame:
    """Spans of at most ``within`` words that hold all terms of a query in any order:
    ``(doc_id, item, start, end)``. ``queries`` has ``item`` and ``phrase`` like :func:`windows`."""
    schema = "doc_id long, item string, start long, end long"

    def search(rows: list):
        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    seg, out = Segment(row), set()
                    for q in rows:
                        for s, e in zip(*seg.near(np.array(q.phrase, dtype=np.int64).view(np.uint64), within)):
                            d = int(seg.doc_of(np.array([s]))[0])
                            out.add((d, q.item, int(s - seg.doc_start[d]), int(e - seg.doc_start[d])))
                    out = sorted(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([seg.doc_ids[r[0]] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()),
                         *(pa.array([r[k] for r in out], pa.int64()) for k in (2, 3))], ["doc_id", "item", "start", "end"])
        return run

    found = None
    for rows in _query_blocks(queries, block):
        part = index.mapInArrow(search(rows), schema)
        found = part if found is None else found.unionByName(part)
    return index.sparkSession.createDataFrame([], schema) if found is None else found


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW, min_share: float = 0.05,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``spans``, ``items``, ``n_hit`` and ``contaminated``
    (some word hit, and at least ``min_share`` of the words)."""
    found = phrase_matches(build_index(docs, id_col, text_col), windows(items, n, item_id, item_text))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    parts = round(1 / min_share)
    return found.select("doc_id", "n_words", "spans", "items", hit.alias("n_hit")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (parts * F.col("n_hit") >= F.col("n_words")))
