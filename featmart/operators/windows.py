"""Window features (WIN-*). Windows run inside ordered buckets of an entity's rows (visitor, user), with a
carry from the buckets before, so one entity may hold any share of the rows. Whole-group statistics use
aggregate + join (``group_stat_on_rows``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.functions.scalar import hours_between
from featmart.operators.ordered import grouped_row_number, null_safe_join
from featmart.operators.relational import group_stat_on_rows
from featmart.operators.layout import with_bucket


def session_gaps(df: DataFrame, entity: str, ts: str, tiebreak: str) -> DataFrame:
    """WIN-5/6 (+SRT-1): whole hours since the previous and until the next row of the same entity.

    ``hours_since_prev = floor((ts - prev_ts)/1h)``, ``hours_to_next = floor((ts - next_ts)/1h)``
    (<= 0); NULL for the first / last row (Q11, Q12). Order: ``ts`` then ``tiebreak``.
    """
    s = with_bucket(df, [entity, ts, tiebreak])
    part = [entity, "__b"]
    edges = s.groupBy(*part).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))  # one row per entity and bucket
    w = Window.partitionBy(entity).orderBy("__b")
    edges = edges.select(*part, F.lag("__hi").over(w).alias("__before"), F.lead("__lo").over(w).alias("__after"))
    inner = Window.partitionBy(*part).orderBy(ts, tiebreak)
    s = null_safe_join(s.withColumns({"__prev": F.lag(ts).over(inner), "__next": F.lead(ts).over(inner)}), edges, part)
    return s.select(*df.columns, hours_between(F.col(ts), F.coalesce("__prev", "__before")).alias("hours_since_prev"),
                    hours_between(F.col(ts), F.coalesce("__next", "__after")).alias("hours_to_next"))


def ordinal_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     name: str = "ordinal", size_name: str = "group_size",
                     ratio_name: str | None = "ordinal_ratio") -> DataFrame:
    """WIN-2/3/4: 1-based running ordinal within ``keys`` (``cumcount()+1``), the group size, and
    their ratio, both from ordered buckets of the groups."""
    out = grouped_row_number(df, keys, order, name, size_name)
    if ratio_name:
        out = out.withColumn(ratio_name, F.col(name) / F.col(size_name))
    return out


def forward_fill(df: DataFrame, cols: Sequence[str], partition: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """WIN-7 within groups: ``fillna(method='pad')`` per ``partition`` in ``order``."""
    s = with_bucket(df, [*partition, *order])
    part = [*partition, "__b"]
    lasts = s.groupBy(*part).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"__last_{c}") for c in cols])
    before = Window.partitionBy(*partition).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(*part, *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in cols])
    inner = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    s = s.select("*", *[F.last(c, ignorenulls=True).over(inner).alias(f"__fill_{c}") for c in cols])
    out = null_safe_join(s, carry, part)
    return out.select(*[F.coalesce(f"__fill_{c}", f"__carry_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def global_forward_fill(df: DataFrame, cols: Sequence[str], order: Sequence[str],
                        num_buckets: int | None = None) -> DataFrame:
    """WIN-7 over the whole table in a global order, without a single-task window.

    Filled inside ordered buckets (one exchange), falling back to the last non-NULL value of the
    buckets before, from an aggregate with one row per bucket. ``order`` must be a total order.
    """
    s = with_bucket(df, order, buckets=num_buckets)
    key = F.struct(*order)
    lasts = s.groupBy("__b").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"__last_{c}") for c in cols])
    before = Window.partitionBy().orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select("__b", *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in cols])
    inner = Window.partitionBy("__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    s = s.select("*", *[F.last(c, ignorenulls=True).over(inner).alias(f"__fill_{c}") for c in cols])
    out = s.join(F.broadcast(carry), "__b")
    return out.select(*[F.coalesce(f"__fill_{c}", f"__carry_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def keys_occurring_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WIN-8: rows whose key occurs exactly once (``~duplicated(keep=False)``), via aggregate+semi join."""
    once = df.groupBy(*keys).count().where("count = 1").drop("count")
    return df.join(once, list(keys), "left_semi")


def partition_mean(df: DataFrame, keys: str | Sequence[str], col: str, name: str) -> DataFrame:
    """WIN-1: ``groupby(k)[c].transform('mean')`` (aggregate + join, skew-safe)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return group_stat_on_rows(df, keys, [F.avg(col).alias(name)])


def ordered_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "pos") -> DataFrame:
    """AGG-12 / WIN-9: every value with its 0-based position in its group, as ``(keys..., name, value)``.
    ``order`` must be total within a group. No list is built, so a group may have any length."""
    numbered = grouped_row_number(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, name)
    return numbered.select(*keys, (F.col(name) - 1).cast("bigint").alias(name), F.col(value).alias("value"))


def wide_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, width: int, prefix: str = "pred") -> DataFrame:
    """AGG-12 in the wide form: one row a group with its first ``width`` values in ``order`` as ``<prefix>_0`` and so on
    (NULL where the group is shorter) and ``n_values``, the length of the whole list. One aggregate over the numbered
    rows, so a group of any length is summed up in parts."""
    long = ordered_values(df, keys, order, value)
    slots = [F.max(F.when(F.col("pos") == i, F.col("value"))).alias(f"{prefix}_{i}") for i in range(width)]
    return long.groupBy(*keys).agg(*slots, F.count(F.lit(1)).alias("n_values"))
