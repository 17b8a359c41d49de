"""Relational feature-mart building blocks (AGG-*, JN-*, SET-*, PRJ-*).

Design rules
- One ``groupBy(key).agg(...)`` per roll-up level: all statistics of a level are computed in a single
  hash aggregate with map-side partial aggregation (JN-5: no per-statistic jobs to align).
- Conditional counts / category shares are conditional aggregates inside that same ``agg``
  (AGG-10/11), never a filtered copy joined back.
- Joins of a fact to per-key aggregates are plain equi-joins; AQE turns them into broadcast joins when
  the aggregated side is small at run time and keeps sort-merge otherwise, so nothing is broadcast
  on a guess. ``broadcast_if_small`` is the explicit, counted alternative for lookup dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.operators.layout import with_bucket
from featmart.session import materialize

# function name -> builder on a column; names follow the reference's ``col_func`` output naming
_AGG_FUNCS = {
    "size": lambda c: F.count(F.lit(1)),
    "count": lambda c: F.count(c),
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),  # D7: sum over all-NULL is 0
    "var": F.var_samp,
    "std": F.stddev_samp,
    "median": F.median,
    "nunique": F.count_distinct,
    "first": lambda c: F.first(c, ignorenulls=True),
}


def agg_exprs(spec: Mapping[str, Sequence[str]], prefix: str = "", sep: str = "_") -> list[Column]:
    """AGG-2/3: ``{column: [func, ...]}`` -> aliased aggregate expressions ``<prefix><col>_<func>``."""
    out = []
    for col, funcs in spec.items():
        for fn in funcs:
            if fn not in _AGG_FUNCS:
                raise ValueError(f"unknown aggregate {fn!r}")
            out.append(_AGG_FUNCS[fn](F.col(col)).alias(f"{prefix}{col}{sep}{fn}"))
    return out


def agg_spec(df: DataFrame, keys: str | Sequence[str], spec: Mapping[str, Sequence[str]],
             prefix: str = "", extra: Iterable[Column] = (), drop_null_keys: bool = True) -> DataFrame:
    """AGG-1/2/3/4/5/6/7: one aggregate over ``keys`` from a dict spec plus extra expressions.

    ``drop_null_keys`` mirrors pandas ``groupby`` (D6): rows with a NULL key form no group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(*agg_exprs(spec, prefix), *extra)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """PRJ-9: names of numeric columns (dtype-driven selection over the schema)."""
    from pyspark.sql import types as T
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """PRJ-9: names of text columns (``dtype == object``)."""
    from pyspark.sql import types as T
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ex]


def agg_all_numeric(df: DataFrame, key: str, funcs: Sequence[str] = ("mean",), prefix: str = "",
                    exclude: Iterable[str] = ()) -> DataFrame:
    """AGG-9: ``groupby(k).mean()/max()/min()`` over every numeric column, in one aggregate."""
    cols = numeric_columns(df, exclude=[key, *exclude])
    return agg_spec(df, key, {c: list(funcs) for c in cols}, prefix=prefix)


def count_where(cond: Column, name: str, zero_as_null: bool = True) -> Column:
    """AGG-11: filter-then-count per group as one conditional aggregate.

    ``zero_as_null`` reproduces the reference's filtered ``groupby`` + left join: a group without a
    matching row has no count (NULL), not 0.
    """
    c = F.count(F.when(cond, F.lit(1)))
    return (F.nullif(c, F.lit(0)) if zero_as_null else c).alias(name)


def pivot_counts(df: DataFrame, keys: str | Sequence[str], col: str, values: Sequence,
                 prefix: str = "") -> DataFrame:
    """AGG-8: value counts pivoted to columns; a missing (key, value) combination is NULL.

    The value list is explicit (no extra job to discover it); written as conditional counts so it
    fuses with other aggregates of the same level.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*pivot_count_exprs(col, values, prefix))


def pivot_count_exprs(col: str, values: Sequence, prefix: str = "") -> list[Column]:
    return [count_where(F.col(col) == F.lit(v), f"{prefix}{col}_{v}") for v in values]


def category_share_exprs(col: str, values: Sequence, funcs: Sequence[str] = ("mean", "max", "min"),
                         prefix: str = "") -> list[Column]:
    """AGG-10: one-hot + group mean/max/min without materialising the one-hot frame.

    A NULL category is an all-zero one-hot row (so it lowers the shares), as ``get_dummies`` does.
    """
    out = []
    fmap = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}
    for v in values:
        ind = F.coalesce((F.col(col) == F.lit(v)).cast("double"), F.lit(0.0))
        for fn in funcs:
            out.append(fmap[fn](ind).alias(f"{prefix}{col}_{v}_{fn}"))
    return out


def distinct_values(df: DataFrame, *cols: str) -> dict[str, list]:
    """Parameter job: sorted distinct non-NULL values of category columns, one job for all of them.

    For columns whose values become output columns; their number is the width of the result. Where it
    has no bound use :func:`category_counts`, which keeps categories as rows."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s"))
    rows = long.select("s.c", "s.v").where("v is not null").distinct().collect()
    return {c: sorted(r["v"] for r in rows if r["c"] == c) for c in cols}


def category_counts(df: DataFrame, keys: str | Sequence[str], col: str) -> DataFrame:
    """AGG-8/10 in long form: ``(keys..., category, n, share)`` for any number of categories; ``share`` is the
    part of the group's rows (NULL categories count as rows)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = df.groupBy(*keys, F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)  # as many rows as the group has categories
    return n.withColumn("share", F.col("n") / F.sum("n").over(w)).where("category is not null")


def left_mart(base: DataFrame, parts: Mapping[str, DataFrame], key: str | Sequence[str]) -> DataFrame:
    """JN-1/3/11: fact table left-joined to named per-key aggregates (each part has one row per key).

    A column name that several parts, or a part and the base, have is prefixed by the part's name in
    every part that has it, so the result does not depend on the order of the parts."""
    keys = [key] if isinstance(key, str) else list(key)
    seen: dict[str, int] = {}
    for c in [*base.columns, *(c for p in parts.values() for c in p.columns)]:
        seen[c] = seen.get(c, 0) + 1
    out = base
    for name, p in parts.items():
        out = out.join(p.select(*keys, *[F.col(c).alias(f"{name}_{c}" if seen[c] > 1 else c) for c in p.columns if c not in keys]),
                       keys, "left")
    return out


def join_on_index(df: DataFrame, other: DataFrame, key: str, index: str) -> DataFrame:
    """JN-2: left join of column ``key`` to the other table's index column ``index``, which is not kept."""
    other = other.withColumnRenamed(index, "__index")
    return df.join(other, df[key] == other["__index"], "left").drop("__index")


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only after counting the rows; above the bound the plain (shuffled) join is used.

    Meant for dimension-like frames (dictionaries, rule tables, per-category statistics) whose size
    is bounded by the number of categories rather than by the data.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def category_join(df: DataFrame, per_category: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join of detail rows to a table with one row per category, without moving the detail rows: the
    table is computed once (checkpointed), counted and broadcast if it is small, so that a category with a
    third of the rows makes no large partition. Beyond the bound it is a join that AQE can split."""
    return df.join(broadcast_if_small(materialize(per_category)), on, "left")


def group_stat_on_rows(df: DataFrame, keys: str | Sequence[str], exprs: Sequence[Column], categories: bool = False) -> DataFrame:
    """JN-6 / WIN-1 / WIN-2: attach per-group statistics to every detail row.

    Aggregate-then-join instead of ``agg().over(partitionBy(k))``: the aggregate is combined
    map-side, so a key that holds a third of all rows costs one partial row per task instead of one
    task buffering the whole partition (a hot key's join side is split by AQE's skew-join handling).
    ``categories``: the keys have few values, so the statistics are joined by a counted broadcast.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    stats = df.groupBy(*keys).agg(*exprs)
    return category_join(df, stats, keys) if categories else df.join(stats, keys, "left")


def unique_key_join(left: DataFrame, right: DataFrame, key_cols: Sequence[str], value: str,
                    default=0.0, name: str = "pred") -> DataFrame:
    """JN-7 / WIN-8: left join to the rows of ``right`` whose key occurs exactly once.

    Keys occurring more than once on the right are dropped entirely (``duplicated(keep=False)``);
    unmatched left rows get ``default``.
    """
    once = (right.groupBy(*key_cols)
            .agg(F.count(F.lit(1)).alias("__n"), F.first(value).alias(name))
            .where(F.col("__n") == 1).drop("__n"))
    return left.join(once, list(key_cols), "left").withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, order_key: str,
           out: str | None = None, left_key: str | None = None) -> DataFrame:
    """JN-8: ``Series.map(dict)`` -- unmatched -> NULL; among duplicate keys the last one wins (Q18)."""
    dedup = mapping.groupBy(key).agg(F.max_by(value, order_key).alias(out or value))
    if left_key and left_key != key:
        dedup = dedup.withColumnRenamed(key, left_key)
    return df.join(dedup, left_key or key, "left")


def union_tagged(train: DataFrame, test: DataFrame, tag: str = "is_test") -> DataFrame:
    """SET-1: train UNION ALL test by name (missing columns NULL) with a tag to split back."""
    return (train.withColumn(tag, F.lit(False))
            .unionByName(test.withColumn(tag, F.lit(True)), allowMissingColumns=True))


def align_columns(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    """SET-5: add missing columns as NULL and return exactly ``columns`` in that order."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(dtype).alias(c) for c in columns])


def with_global_row_number(df: DataFrame, order_cols: Sequence[str], name: str = "row_no",
                           num_buckets: int | None = None) -> DataFrame:
    """PRJ-11 / SPL-3 / SPL-7 helper: 1-based row number in a global order, without a one-task window.

    Rows are numbered inside ordered buckets (one exchange) and shifted by the rows of the buckets
    before, from a count with one row per bucket. ``order_cols`` must be a total order (unique).
    """
    s = with_bucket(df, order_cols, buckets=num_buckets)
    counts = s.groupBy("__b").agg(F.count(F.lit(1)).alias("__cnt"))
    shift = counts.select("__b", (F.sum("__cnt").over(Window.partitionBy().orderBy("__b")) - F.col("__cnt")).alias("__off"))
    local = F.row_number().over(Window.partitionBy("__b").orderBy(*order_cols))
    out = s.withColumn("__local", local).join(F.broadcast(shift), "__b")
    return out.select(*df.columns, (F.col("__off") + F.col("__local")).alias(name))
