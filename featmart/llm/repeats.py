"""Bytes of a corpus that lie in long strings which occur elsewhere, by two-stage suffix sorting.

Every window of ``LENGTH`` bytes picks the least hashed ``GRAM``-byte gram inside it as its anchor;
equal windows pick the same one. Windows of a text with the same anchor form a *stretch* (about 85
window starts). All stretches are counted by anchor and by content. A stretch whose content occurs
again is repeated as a whole; one whose anchor occurs nowhere else is unique; the others go, one copy
of each content, to the group of their anchor, where a suffix array finds the windows they share.

The suffix array of a group is built in two stages: the suffixes smaller than their successors are
sorted directly, the others follow from these by one scan over the buckets of first bytes. Suffixes
next to each other whose common prefix has ``LENGTH`` bytes are repeats.

Bounds: a segment has ``SEGMENT_BYTES`` of text or one longer text, which is worked through in slices.
A group of stretches takes part in suffix sorting up to ``HOT`` occurrences of its anchor; the windows
of more frequent anchors are counted one by one by their hash (the exact way for the rest), again
added up in every segment first, so that no anchor fills a task.

Defined edge cases: a null or empty text has no bytes; texts shorter than ``LENGTH`` lose nothing;
repeated rows are copies of each other; strings never cross texts; kept bytes are returned as bytes,
since a cut may fall inside a character; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.llm.common import blocks, id_text, mix64, prefix_hash, range_hash, stored
from featmart.llm.packed import REPLY_SCHEMA, Items, answers, bits_for, by_bucket, squeeze, totals, unsqueeze

LENGTH = 200
GRAM = 32
SEGMENT_BYTES = 2 << 20
SLICE = 1 << 20
SORT_BYTES = 1 << 18  # text sorted at once
HOT = 1000
PARTITION_ITEMS = 1 << 18
GROUP_BYTES = 2 << 20
ANCHORS, CONTENTS, WINDOWS = 0, 1, 2

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                  ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
_PART = pa.schema([("bucket", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("n_bytes", pa.int64()), ("anchors", pa.binary()),
                   ("contents", pa.binary()), ("sizes", pa.binary()), ("asks", pa.binary()), ("numbers", pa.binary()), ("text", pa.binary())])


# ---- two-stage suffix sorting -------------------------------------------------------------------

def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor (the end of the data is the least suffix)."""
    if not len(data):
        return np.zeros(0, dtype=bool)
    step = np.sign(np.diff(data.astype(np.int16), append=-1))
    at = np.flatnonzero(step)
    return step[at[np.searchsorted(at, np.arange(len(data)))]] > 0


def suffix_array(data: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Places of all suffixes in ascending order of at least their first ``depth`` bytes (default all).

    ``data`` is uint8 below 255 (as UTF-8 is), at most 2^31 long.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    depth = n if depth is None else min(depth, n)
    small = smaller_than_next(data)
    direct = np.flatnonzero(small)
    padded = np.zeros(n + depth, dtype=np.uint8)
    padded[:n] = data + 1
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    keys = np.ascontiguousarray(windows[direct]).view(f"S{depth}").ravel() if len(direct) else np.zeros(0, "S1")
    direct = direct[np.argsort(keys, kind="stable")]
    # buckets of first bytes: the induced suffixes stand before the directly sorted ones
    size = np.bincount(data, minlength=256)
    begin = np.cumsum(size) - size
    tail = begin + size - np.bincount(data[direct], minlength=256)
    out = np.empty(n, dtype=np.int64)
    bucket = data[direct]
    out[tail[bucket] + np.arange(len(direct)) - np.searchsorted(bucket, bucket)] = direct
    head = begin.copy()

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~small[before]]
        if len(before):
            first = data[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            out[head[first] + np.arange(len(first)) - np.searchsorted(first, first)] = before
            head[:] += np.bincount(first, minlength=256)

    induce(np.array([n]))
    for c in range(256):
        at = begin[c]
        while at < head[c]:  # runs of one byte induce into their own bucket
            at, end = head[c], at
            induce(out[end:at])
        induce(out[tail[c]:begin[c] + size[c]])
    return out


def adjacent_common_prefix(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each two neighbours of ``order``, how many of their first ``limit`` bytes agree."""
    padded = np.zeros(len(data) + limit + 8, dtype=np.uint8)
    padded[:len(data)] = data + 1
    a, b = order[:-1], order[1:]
    out = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    for k in range(0, limit, 8):
        x = np.lib.stride_tricks.sliding_window_view(padded, 8)
        same = x[a[live] + k] == x[b[live] + k]
        run = np.where(same.all(axis=1), 8, same.argmin(axis=1))
        out[live] += run
        live = live[run == 8]
        if not len(live):
            break
    end = np.minimum(len(data) - a, len(data) - b)
    return np.minimum(np.minimum(out, limit), end)


# ---- stretches ----------------------------------------------------------------------------------

def _window_least(key: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` consecutive keys, from running minima of blocks of ``w``."""
    n = len(key)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    block = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


class Stretches:
    """Stretches of a segment: ``low`` and ``high`` first and last window start, ``anchor`` and
    ``content`` hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, parts = data, []
        text = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(text, offsets[1:-1], 1)
        text = np.cumsum(text)[:len(data)]
        for cut in range(0, max(len(data) - LENGTH + 1, 0), SLICE):
            parts.append(self._slice(data[cut:cut + SLICE + LENGTH - 1], text[cut:cut + SLICE + LENGTH - 1], cut))
        zero = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
        self.low, self.high, self.anchor, self.content = (np.concatenate(x) for x in zip(zero, *parts))

    @staticmethod
    def _slice(data: np.ndarray, text: np.ndarray, cut: int):
        prefix = prefix_hash(data)
        places = np.arange(len(data) - GRAM + 1)
        h = range_hash(prefix, places, places + GRAM)
        bits = np.uint64(len(data).bit_length())
        least = _window_least((h >> bits << bits) | places.astype(np.uint64), LENGTH - GRAM + 1)
        at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        start = np.flatnonzero(text[:len(at)] == text[LENGTH - 1:LENGTH - 1 + len(at)])
        anchor = at[start]
        new = np.append(True, (np.diff(anchor) != 0) | (np.diff(start) != 1))[:len(start)]
        first = np.flatnonzero(new)
        low, high, anchor = start[first], start[np.append(first[1:], len(start)) - 1], anchor[first]
        content = mix64(range_hash(prefix, low, high + LENGTH) + (anchor - low).astype(np.uint64))
        return low + cut, high + cut, mix64(h[anchor]), content  # the least hashes crowd at zero: spread them for the buckets


def _load(row: dict) -> tuple[Stretches, np.ndarray]:
    offsets = np.frombuffer(row["offsets"], "<i8")
    return Stretches(unsqueeze(row["text"], row["n_bytes"], "u1"), offsets), offsets


def segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored: some whole texts in a row, as UTF-8 bytes."""

    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        for b in blocks(batches, limit=SEGMENT_BYTES):
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + number]), pa.array([b.rows.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([len(b.data)]),
                 pa.array([b.offsets.astype("<i8").tobytes()]), pa.array([squeeze(b.data)])],
                ["segment", "doc_ids", "n_bytes", "offsets", "text"])
            number += 1

    return stored(id_text(docs, id_col, text_col).mapInArrow(
        run, "segment long, doc_ids array<long>, n_bytes long, offsets binary, text binary"), "texts")


def _stretch_items(row: dict) -> Items:
    s, _ = _load(row)
    for space, hashes in ((ANCHORS, s.anchor), (CONTENTS, s.content)):
        yield space, *np.unique(hashes, return_counts=True)


class _Known:
    """What a segment knows of its stretches from the totals: which are repeated as a whole, which have
    to be compared, and which of these have a frequent anchor."""

    def __init__(self, s: Stretches, total: dict[int, np.ndarray], hot: int):
        anchors = total[ANCHORS][np.unique(s.anchor, return_inverse=True)[1]] if len(s.low) else np.zeros(0, np.int64)
        contents = total[CONTENTS][np.unique(s.content, return_inverse=True)[1]] if len(s.low) else np.zeros(0, np.int64)
        self.whole = contents > 1
        self.open = anchors > contents  # other contents share the anchor
        self.hot = self.open & (anchors > hot)


def _window_hashes(s: Stretches, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and stretch number of each window of the picked stretches."""
    number = np.flatnonzero(pick)
    size = s.high[number] - s.low[number] + 1
    start = np.repeat(s.low[number], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros(len(start), dtype=np.uint64)
    for cut in range(0, len(s.data), SLICE):
        here = np.flatnonzero((start >= cut) & (start < cut + SLICE))
        if len(here):
            prefix = prefix_hash(s.data[cut:cut + SLICE + LENGTH])
            out[here] = range_hash(prefix, start[here] - cut, start[here] - cut + LENGTH)
    return out, start, np.repeat(number, size)


def _parts(bits: int, hot: int):
    """Stretches of a segment that have to be compared, packed by anchor group; and, with the bucket -1,
    the distinct window hashes (as ``anchors``) and their counts (as ``contents``) of those with a
    frequent anchor."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, total = [], answers(right.to_pylist())
        for row in left.to_pylist():
            s, _ = _load(row)
            known = _Known(s, total, hot)
            uniq, count = np.unique(_window_hashes(s, _hot_once(s, known))[0], return_counts=True)
            if len(uniq):
                out.append({"bucket": -1, "segment": row["segment"], "n": len(uniq), "anchors": uniq.astype("<u8").tobytes(),
                            "contents": count.astype("<u4").tobytes()})
            number = np.flatnonzero(known.open & ~known.hot)
            # one copy of a content from a segment
            number = number[np.unique(s.content[number], return_index=True)[1]]
            number = number[np.argsort(s.anchor[number], kind="stable")]
            for bucket, a, z in by_bucket(s.anchor[number], bits):
                own = number[a:z]
                text = np.concatenate([s.data[x:y + LENGTH] for x, y in zip(s.low[own], s.high[own])])
                out.append(dict(zip(_PART.names, (
                    bucket, row["segment"], len(own), len(text), s.anchor[own].astype("<u8").tobytes(), s.content[own].astype("<u8").tobytes(),
                    (s.high[own] - s.low[own] + LENGTH).astype("<i4").tobytes(), (~known.whole[own]).astype("u1").tobytes(),
                    own.astype("<i4").tobytes(), squeeze(text)))))
        return pa.Table.from_pylist(out, _PART)

    return run


def _shared_windows(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For texts of the given sizes, one after the other: which bytes start a window of ``LENGTH`` bytes
    that starts elsewhere too."""
    gap = np.arange(len(size))
    end = np.cumsum(size)
    apart = np.zeros(len(text) + len(size), dtype=np.uint8)  # a zero after each text, bytes raised by one
    place = np.arange(len(text)) + np.repeat(gap, size)
    apart[place] = text + 1
    window = np.arange(len(text)) + LENGTH <= np.repeat(end, size)
    is_window = np.zeros(len(apart), dtype=bool)
    is_window[place] = window
    order = suffix_array(apart, LENGTH)
    order = order[is_window[order]]
    same = adjacent_common_prefix(apart, order, LENGTH) >= LENGTH
    hit = np.zeros(len(apart), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return hit[place]


def _compare(table: pa.Table) -> pa.Table:
    """Answer the stretches of one group of anchors: runs of repeated window starts in each."""
    rows = table.to_pylist()
    column = {k: np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in
              (("anchors", "<u8"), ("contents", "<u8"), ("sizes", "<i4"), ("asks", "u1"), ("numbers", "<i4"))}
    segment = np.repeat([r["segment"] for r in rows], [r["n"] for r in rows])
    text = np.concatenate([unsqueeze(r["text"], r["n_bytes"], "u1") for r in rows])
    begin = np.cumsum(column["sizes"]) - column["sizes"]
    _, keep = np.unique(column["contents"], return_index=True)  # contents name their anchor
    keep = keep[np.argsort(column["anchors"][keep], kind="stable")]
    anchor, size = column["anchors"][keep], column["sizes"][keep].astype(np.int64)
    # whole anchors at a time, about SORT_BYTES of text
    cut = np.append(0, np.flatnonzero(np.diff(anchor)) + 1)
    until = np.append(np.cumsum(size)[np.append(cut[1:], len(keep)) - 1], 0)
    found = []
    i = 0
    while i < len(cut):
        j = i + 1
        base = until[i - 1] if i else 0
        while j < len(cut) and until[j] - base <= SORT_BYTES:
            j += 1
        a, z = cut[i], cut[j] if j < len(cut) else len(keep)
        if z - a > 1:
            own = keep[a:z]
            hit = _shared_windows(np.concatenate([text[begin[k]:begin[k] + column["sizes"][k]] for k in own]), size[a:z])
            at = np.cumsum(size[a:z]) - size[a:z]
            for k, x, n in zip(own, at, size[a:z]):
                if column["asks"][k] and hit[x:x + n].any():
                    edge = np.flatnonzero(np.diff(hit[x:x + n].astype(np.int8), prepend=0, append=0))
                    found.append((segment[k], column["numbers"][k], edge[::2], edge[1::2]))
        i = j
    out: dict[int, list] = {}
    for seg, number, x, y in found:
        out.setdefault(int(seg), []).append(np.stack([np.full(len(x), number), x, y], axis=1))
    return pa.table({"segment": pa.array(list(out), pa.int64()), "space": pa.array([-1] * len(out), pa.int32()),
                     "bucket": pa.array([0] * len(out), pa.int64()), "n": pa.array([sum(map(len, v)) for v in out.values()], pa.int64()),
                     "totals": pa.array([squeeze(np.concatenate(v).astype("<i8")) for v in out.values()], pa.binary())})


def _cut(hot: int):
    """Remove what is repeated from the texts of a segment."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies, out = right.to_pylist(), []
        total = answers([r for r in replies if r["space"] >= 0])
        for row in left.to_pylist():
            s, offsets = _load(row)
            known = _Known(s, total, hot)
            cover = np.zeros(len(s.data) + 1, dtype=np.int64)
            np.add.at(cover, s.low[known.whole], 1)
            np.add.at(cover, s.high[known.whole] + LENGTH, -1)
            for r in replies:
                if r["space"] < 0:
                    number, x, y = unsqueeze(r["totals"], 3 * r["n"], "<i8").reshape(-1, 3).T
                    np.add.at(cover, s.low[number] + x, 1)
                    np.add.at(cover, s.low[number] + y + LENGTH - 1, -1)
            if WINDOWS in total:
                h, start, _ = _window_hashes(s, known.hot & ~known.whole)
                uniq = np.unique(_window_hashes(s, _hot_once(s, known))[0])
                start = start[total[WINDOWS][np.searchsorted(uniq, h)] > 1]
                np.add.at(cover, start, 1)
                np.add.at(cover, start + LENGTH, -1)
            gone = np.cumsum(cover)[:-1] > 0
            ids, spans, kept = row["doc_ids"], [], []
            for a, z in zip(offsets[:-1], offsets[1:]):
                edge = np.flatnonzero(np.diff(gone[a:z].astype(np.int8), prepend=0, append=0))
                spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
                kept.append(s.data[a:z][~gone[a:z]].tobytes())
            out.append(pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(offsets)), pa.array(spans, _OUT.field(2).type),
                                             pa.array(kept, pa.binary())], schema=_OUT))
        return pa.concat_tables(out) if out else _OUT.empty_table()

    return run


def _hot_once(s: Stretches, known: _Known) -> np.ndarray:
    """One stretch of each content among those of frequent anchors. A content that occurs in several
    segments is sent by each; its windows then count as repeated, which they are."""
    number = np.flatnonzero(known.hot)
    pick = np.zeros(len(s.low), dtype=bool)
    pick[number[np.unique(s.content[number], return_index=True)[1]]] = True
    return pick


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``removed`` (maximal byte runs) and ``kept`` (the other bytes)."""
    texts = segments(docs, id_col, text_col)
    n_bytes = texts.agg(F.sum("n_bytes")).first()[0] or 0
    bits = bits_for(n_bytes // 85, PARTITION_ITEMS)
    counted = stored(totals(texts, _stretch_items, bits), "totals")
    by_segment = counted.groupBy("segment")
    bits = bits_for(n_bytes, GROUP_BYTES)
    parts = stored(texts.groupBy("segment").cogroup(by_segment).applyInArrow(
        _parts(bits, hot), "bucket long, segment long, n long, n_bytes long, anchors binary, "
        "contents binary, sizes binary, asks binary, numbers binary, text binary"), "parts")
    compared = parts.where("bucket >= 0").groupBy("bucket").applyInArrow(_compare, REPLY_SCHEMA)
    frequent = totals(parts.where("bucket < 0").select("segment", "anchors", "contents"), _window_items, bits)
    known = stored(compared.unionByName(frequent), "compared")
    return texts.groupBy("segment").cogroup(counted.unionByName(known).groupBy("segment")).applyInArrow(
        _cut(hot), "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")


def _window_items(row: dict) -> Items:
    yield WINDOWS, np.frombuffer(row["anchors"], "<u8"), np.frombuffer(row["contents"], "<u4")
