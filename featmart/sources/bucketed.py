"""Feature tables cached as bucketed tables (SRC-9), and marts that join them without moving a row (JN-3).

A cached table is written once, shuffled by its key into ``buckets`` files; every later join on that key with another
table of as many buckets reads matching files side by side. Hot keys are no concern: a part of a mart has one row per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from featmart.operators.relational import left_mart
from featmart.session import checkpoint_dir

#: Rows of the widest table that one bucket should hold.
ROWS_A_BUCKET = 5_000_000


class BucketedCache:
    """Named tables bucketed and sorted by one key, in the shared folder of the session's checkpoints.

    ``buckets`` must be the same for all tables that are to be joined in place, so it belongs to the cache."""

    def __init__(self, spark: SparkSession, key: str, buckets: int):
        self.spark, self.key, self.buckets = spark, key, buckets
        self._prefix = f"featmart_{uuid.uuid4().hex[:12]}"
        self._path = f"{checkpoint_dir(spark).rstrip('/')}/{self._prefix}"
        self._tables: dict[str, str] = {}

    @classmethod
    def sized_for(cls, base: DataFrame, key: str, rows_a_bucket: int = ROWS_A_BUCKET) -> BucketedCache:
        """A cache with so many buckets that one holds about ``rows_a_bucket`` rows of ``base`` (a power of two)."""
        return cls(base.sparkSession, key, 1 << max(2, (base.count() // rows_a_bucket).bit_length()))

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` under ``name`` and return it as read from the cache. A NULL key is a key like others."""
        if name in self._tables:
            raise ValueError(f"cached already: {name}")
        table = f"{self._prefix}_{name}"
        (df.repartition(self.buckets, self.key).write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
         .option("path", f"{self._path}/{name}").saveAsTable(table))
        self._tables[name] = table
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.table(self._tables[name])

    def drop(self) -> None:
        """Forget the tables; their files go with the checkpoint folder."""
        for table in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()


def bucketed_mart(cache: BucketedCache, base: DataFrame, parts: Mapping[str, DataFrame]) -> DataFrame:
    """JN-3 over cached tables: ``base`` left-joined to every part on the cache's key. All tables are written bucketed
    first; the joins then sort and merge bucket by bucket, and no row is exchanged above the scans."""
    cached = {name: cache.put(name, p).hint("merge") for name, p in parts.items()}
    return left_mart(cache.put("base", base), cached, cache.key)
