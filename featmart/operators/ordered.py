"""Global-order primitives that never pull a whole table into one task.

A global window (``Window.orderBy(...)`` without ``partitionBy``) runs in a single task. These
helpers get the same answers from ordered buckets (``layout.with_bucket``): a window inside each
bucket (one exchange of the table) plus a carry from a partial aggregate with one row per bucket.

- ``prefix_sums``: running sums in a global order (optionally restarting per group);
- ``exact_quantiles``: exact linear-interpolated quantiles (``percentile_cont``), see :mod:`featmart.operators.ranks`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featmart.operators.layout import with_bucket
from featmart.operators.ranks import quantiles


def prefix_sums(df: DataFrame, order_cols: Sequence[str], value_cols: Sequence[str],
                group_cols: Sequence[str] = (), inclusive: bool = True,
                num_buckets: int | None = None) -> DataFrame:
    """Running sums of ``value_cols`` in the order ``group_cols + order_cols``.

    ``inclusive`` includes the current row. With ``group_cols`` the running sum restarts per group: a
    group's sums are added up from its own buckets, so they keep their digits next to larger groups.
    ``group_cols + order_cols`` must be a total order.
    """
    groups = list(group_cols)
    s = with_bucket(df, [*groups, *order_cols], buckets=num_buckets)
    keys = [*groups, "__b"]
    totals = s.groupBy(*keys).agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    # one row per bucket (and per group that shares it)
    before = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__c_{v}") for v in value_cols])
    inner = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    running = s.select("*", *[F.sum(v).over(inner).alias(f"__r_{v}") for v in value_cols])
    out = running.join(carry if groups else F.broadcast(carry), keys)
    res = [F.col(f"__r_{v}") + F.col(f"__c_{v}") - (F.lit(0) if inclusive else F.col(v)) for v in value_cols]
    return out.select(*df.columns, *[r.alias(f"cum_{v}") for r, v in zip(res, value_cols)])


def grouped_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
                       size_name: str | None = None, num_buckets: int | None = None) -> DataFrame:
    """1-based row number within ``keys`` in ``order`` (total within a group), and optionally the group's size.

    Groups are cut into ordered buckets, so a group that holds a third of the rows is numbered by many
    tasks; the rows before a bucket come from a count with one row for each group and bucket, which is
    joined on the keys the rows are already partitioned by."""
    keys = list(keys)
    s = with_bucket(df, [*keys, *order], buckets=num_buckets)
    part = [*keys, "__b"]
    counts = s.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys)
    shift = counts.select(*part, (F.sum("__n").over(w.orderBy("__b")) - F.col("__n")).alias("__off"), F.sum("__n").over(w).alias("__all"))
    out = s.withColumn("__local", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    out = null_safe_join(out, shift, part)
    return out.select(*df.columns, (F.col("__local") + F.col("__off")).alias(name),
                      *([F.col("__all").alias(size_name)] if size_name else []))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL; the right side's keys are not kept."""
    other = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(other[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(other, cond).drop(*[f"__r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """Exact ``percentile_cont`` values of ``col`` (NULLs ignored) for each probability."""
    return quantiles(df, [col], probs)[col]
