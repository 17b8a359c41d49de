"""Splitting a table into ordered buckets without sorting or storing it.

Split points are full order tuples taken from a bounded sample of the rows. They decide only which
bucket a row goes to, never the result: the buckets follow each other in the order, whatever the
sample was. As the points are literals of the plan, every pass over the table sees the same buckets,
so multi-pass operators need no checkpoint. Tuples (not just the first column) split ties as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_BUCKET = 30
PER_PARTITION = 3  # buckets for each shuffle partition, so that hashing them leaves few tasks empty
MAX_BUCKETS = 2048
TREE = 64  # points that one chain of comparisons decides


def split_points(df: DataFrame, order: Sequence[str], buckets: int) -> list:
    """At most ``buckets - 1`` ascending order tuples, from a sample of about ``SAMPLE_PER_BUCKET`` rows for each bucket
    (their number is bounded by the parameters). Rows are sampled, not tuples, so a tuple that many rows hold
    becomes a point of its own and the buckets around it stay even."""
    keys = df.select(F.struct(*order).alias("k"))
    wanted, n = buckets * SAMPLE_PER_BUCKET, keys.count()
    if n > 2 * wanted:
        keys = keys.sample(1.0 * wanted / n, seed=7)
    rows = [r.k for r in keys.orderBy("k").collect()]
    step = max(1, len(rows) // buckets)
    points = rows[step::step][:buckets - 1]
    return [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]


def _literal(df: DataFrame, order: Sequence[str], point) -> Column:
    return F.struct(*(F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, point)))


def with_bucket(df: DataFrame, order: Sequence[str], name: str = "__b", buckets: int | None = None) -> DataFrame:
    """``df`` with the number of its bucket in ``order``; smaller buckets hold smaller tuples (NULLs first)."""
    n = buckets or PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = split_points(df, order, min(n, MAX_BUCKETS))
    if not points:
        return df.withColumn(name, F.lit(0))
    key, width = F.struct(*order), -(-len(points) // TREE)
    literals = [_literal(df, order, p) for p in points]
    # how many points are not above the row: whole groups of ``width`` first, then inside the last group
    group = _count_below(key, literals[::width], 0)
    if width == 1:
        return df.withColumn(name, group)
    fine = F.array(*literals)
    inner = F.size(F.filter(F.slice(fine, (F.col("__group") - 1) * width + 1, F.lit(width)), lambda p: p <= key))
    out = df.withColumn("__group", group)
    return out.withColumn(name, F.when(F.col("__group") == 0, 0).otherwise((F.col("__group") - 1) * width + inner).cast("int")).drop("__group")


def _count_below(key: Column, points: list[Column], base: int) -> Column:
    """``base`` plus the number of ascending ``points`` that are not above ``key``: a binary search as nested CASEs."""
    if not points:
        return F.lit(base)
    mid = len(points) // 2
    return F.when(key < points[mid], _count_below(key, points[:mid], base)).otherwise(_count_below(key, points[mid + 1:], base + mid + 1))
