"""Reproducible splits, folds and samples (SPL-*).

Random assignment is a hash of the row id and a seed (D10): ``md5(id || '|' || seed)``, first 8 hex
digits as an integer. It is a pure column expression -- the same row always lands in the same part,
independent of partitioning, re-execution after an executor loss, or the engine (DuckDB computes the
same bucket, so every split is oracle-checkable). ``randomSplit`` has none of these properties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.operators.relational import with_global_row_number

BUCKETS = 10_000


def hash_unit(id_col: Column | str, seed: int | str) -> Column:
    """Deterministic integer in ``[0, 2^32)`` from an id and a seed."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    h = F.md5(F.concat(c.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def hash_bucket(id_col: Column | str, seed: int | str, buckets: int = BUCKETS) -> Column:
    return (hash_unit(id_col, seed) % F.lit(buckets)).cast("int")


def split_flag(id_col: Column | str, fraction: float, seed: int | str = 0) -> Column:
    """SPL-1: True for the held-out part (about ``fraction`` of the rows)."""
    return hash_bucket(id_col, seed) < F.lit(int(round(fraction * BUCKETS)))


def nested_split_flag(id_col: Column | str, fraction: float, seed: int | str = 0) -> Column:
    """SPL-2: second-level split of a split, with an independent seed."""
    return split_flag(id_col, fraction, f"{seed}/inner")


def kfold(id_col: Column | str, k: int, seed: int | str = 0) -> Column:
    """SPL-4 (shuffled): fold in ``0..k-1``."""
    return (hash_unit(id_col, seed) % F.lit(k)).cast("int")


def group_kfold(group_col: Column | str, k: int, seed: int | str = 0) -> Column:
    """SPL-5: all rows of a group share a fold (hash of the group key)."""
    return kfold(group_col, k, seed)


def contiguous_folds(df: DataFrame, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """SPL-4 (unshuffled ``KFold``): consecutive blocks in ``order``; the first ``n % k`` folds get one
    extra row. Uses the two-pass global row number (no single-task window)."""
    n = df.count()
    q, r = divmod(n, k)
    num = with_global_row_number(df, order, "__rn")
    i = F.col("__rn") - 1
    big = r * (q + 1)
    fold = F.when(i < big, F.floor(i / (q + 1))).otherwise(F.lit(r) + F.floor((i - big) / F.lit(max(q, 1))))
    return num.withColumn(name, fold.cast("int")).drop("__rn")


def fixed_size_sample(df: DataFrame, id_col: str, n: int, seed: int | str = 0) -> DataFrame:
    """SPL-6: exactly ``n`` rows (or all), chosen by hash order -- the limit is the operator.
    ``orderBy(...).limit(n)`` runs as a per-partition top-n plus a merge of n rows per partition."""
    return df.orderBy(hash_unit(id_col, seed), F.col(id_col)).limit(n)


def balance_classes(df: DataFrame, label: str, order: Sequence[str], positive=1) -> DataFrame:
    """SPL-7: all positive rows plus the first ``#positives`` negative rows in ``order``."""
    n_pos = df.where(F.col(label) == F.lit(positive)).count()
    neg = df.where((F.col(label) != F.lit(positive)) | F.col(label).isNull())
    neg = with_global_row_number(neg, order, "__rn").where(F.col("__rn") <= n_pos).drop("__rn")
    return df.where(F.col(label) == F.lit(positive)).unionByName(neg)


def positional_slice(df: DataFrame, order: Sequence[str], start: int, stop: int | None = None) -> DataFrame:
    """PRJ-11 / SPL-3: rows ``start <= position < stop`` (0-based) in ``order`` (``iloc[a:b]``)."""
    num = with_global_row_number(df, order, "__rn")
    cond = F.col("__rn") > start
    if stop is not None:
        cond = cond & (F.col("__rn") <= stop)
    return num.where(cond).drop("__rn")
