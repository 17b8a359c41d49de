"""Counting hashed items of all segments of a corpus and telling every segment the totals.

A segment sends its distinct items, as packed ascending 64-bit hashes with counts, to the partition
that the leading bits of the hash name. A partition adds the counts of all segments and answers each
with the totals of just its items, in its order. An item that is frequent everywhere is one entry from
a segment, so partitions stay even.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_REQUEST = pa.schema([("segment", pa.int64()), ("space", pa.int32()), ("bucket", pa.int64()), ("width", pa.int32()),
                      ("wanted", pa.bool_()), ("items", pa.binary()), ("counts", pa.binary())])
REPLY_SCHEMA = "segment long, space int, bucket long, n long, totals binary"
_REPLY = pa.schema([("segment", pa.int64()), ("space", pa.int32()), ("bucket", pa.int64()), ("n", pa.int64()), ("totals", pa.binary())])

Items = Iterable[tuple[int, np.ndarray, np.ndarray]]


def squeeze(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(blob: bytes, n: int, dtype: str) -> np.ndarray:
    """The ``n`` entries of a squeezed array."""
    size = n * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True) if size else b"", dtype)


def _pack(items: np.ndarray, base: int) -> tuple[bytes, int]:
    """Gaps between ascending hashes, in six bytes each where that is enough."""
    gap = np.diff(items, prepend=np.uint64(base)).astype("<u8")
    width = 6 if gap.max(initial=0) < 1 << 48 else 8
    return gap.view(np.uint8).reshape(-1, 8)[:, :width].tobytes(), width


def _unpack(blob: bytes, width: int, base: int) -> np.ndarray:
    gap = np.zeros((len(blob) // width, 8), dtype=np.uint8)
    gap[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return np.cumsum(gap.view("<u8").ravel(), dtype=np.uint64) + np.uint64(base)


def bits_for(items: int, each: int) -> int:
    """Leading hash bits that make partitions of about ``each`` items."""
    return max(0, items // each).bit_length()


def by_bucket(hashes: np.ndarray, bits: int) -> Iterable[tuple[int, int, int]]:
    """``(bucket, begin, end)`` of the stretches of ascending hashes that share their leading bits."""
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        cut = np.append(0, np.flatnonzero(np.diff(bucket)) + 1)
        for a, z in zip(cut, np.append(cut[1:], len(hashes))):
            yield int(bucket[a]), int(a), int(z)


def totals(segments: DataFrame, items: Callable[[dict], Items], bits: int) -> DataFrame:
    """Replies for all segments that want them. ``items`` lists a segment's ``(space, distinct ascending
    hashes, counts)``; a segment row has ``segment`` and may have ``wanted`` (default true)."""

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for space, hashes, counts in items(row):
                    for bucket, a, z in by_bucket(hashes, bits):
                        blob, width = _pack(hashes[a:z], bucket << (64 - bits) if bits else 0)
                        out.append(dict(zip(_REQUEST.names, (row["segment"], space, bucket, width, row.get("wanted", True), blob,
                                                             squeeze(counts[a:z].astype("<u4"))))))
                yield pa.RecordBatch.from_pylist(out, _REQUEST)

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        base = rows[0]["bucket"] << (64 - bits) if bits else 0
        hashes = [_unpack(r["items"], r["width"], base) for r in rows]
        counts = [unsqueeze(r["counts"], len(h), "<u4") for r, h in zip(rows, hashes)]
        uniq, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts), minlength=len(uniq)).astype("<i8")[place]
        ends = np.cumsum([len(h) for h in hashes])
        return pa.Table.from_pylist([dict(zip(_REPLY.names, (r["segment"], r["space"], r["bucket"], len(h), squeeze(total[e - len(h):e]))))
                                     for r, h, e in zip(rows, hashes, ends) if r["wanted"]], _REPLY)

    asked = segments.mapInArrow(ask, "segment long, space int, bucket long, width int, wanted boolean, items binary, counts binary")
    return asked.groupBy("space", "bucket").applyInArrow(add, REPLY_SCHEMA)


def answers(rows: list[dict]) -> dict[int, np.ndarray]:
    """Totals by space, from a segment's replies, in the order in which it listed its items."""
    out: dict[int, list[np.ndarray]] = {}
    for r in sorted(rows, key=lambda r: (r["space"], r["bucket"])):
        out.setdefault(r["space"], []).append(unsqueeze(r["totals"], r["n"], "<i8"))
    return {k: np.concatenate(v) for k, v in out.items()}
