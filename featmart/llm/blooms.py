"""Blocked Bloom filters: a key sets five bits of one 64-bit block.

A filter is made by one aggregate (``bit_or`` of the masks of a block) and broadcast. Its size is bounded by
``MAX_BYTES`` whatever the number of keys: more keys make it fuller, which lets more false positives through to
the exact join that follows every use, and changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key, as long as the bound allows.
BITS = 16
#: Bound of all filters of one use together.
MAX_BYTES = 32 << 20

ROWS = "shard int, block int, mask long"
_SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("mask", pa.int64())])


def blocks_for(keys: dict[int, int], max_bytes: int = MAX_BYTES) -> dict[int, int]:
    """Blocks of each shard's filter from its number of keys; in total at most ``max_bytes`` (and one a shard)."""
    fair = max_bytes / (8 * max(1, sum(keys.values())))
    return {s: max(1, int(n * min(BITS / 64, fair))) for s, n in keys.items()}


def _place(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def _mask(h: np.ndarray) -> np.ndarray:
    m = np.uint64(1) << (h & np.uint64(63))
    for k in (6, 12, 18, 24):
        m |= np.uint64(1) << ((h >> np.uint64(k)) & np.uint64(63))
    return m


def rows(shard: int, h: np.ndarray, blocks: int) -> pa.RecordBatch:
    """What the keys with the (well mixed) hashes ``h`` add to the filter of ``shard``."""
    return pa.record_batch([np.full(len(h), shard, np.int32), _place(h, blocks).astype(np.int32), _mask(h).view(np.int64)], schema=_SCHEMA)


def build(parts: DataFrame, blocks: dict[int, int]) -> dict:
    """Broadcast filters by shard from ``rows``; a task loads only those of the shards it asks for."""
    sc = parts.sparkSession.sparkContext
    table = parts.groupBy("shard", "block").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most MAX_BYTES / 8 rows
    shard, block, mask = (table[c].to_numpy() for c in ("shard", "block", "mask"))
    out = {}
    for s, n in blocks.items():
        mine, bits = shard == s, np.zeros(n, np.uint64)
        bits[block[mine]] = mask[mine].view(np.uint64)
        out[s] = sc.broadcast(bits)
    return out


def hit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """May the filter hold the keys? True for every key that it holds."""
    m = _mask(h)
    return (bits[_place(h, len(bits)).astype(np.int64)] & m) == m
