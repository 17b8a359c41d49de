"""Encodings, binning and scaling (ENC-*, BIN-*, SCA-*).

Every encoder is ``fit`` (a small parameter DataFrame: one row per category, or a handful of
scalars) + ``apply`` (a join or a column expression), so train-fitted parameters are reused on test.
Category dictionaries are numbered with the global row-number primitive, not a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featmart.operators.ordered import exact_quantiles
from featmart.operators.relational import category_join, distinct_values, with_global_row_number


# ---------------------------------------------------------------- label / factorize codes
def label_dictionary(df: DataFrame, col: str, null_text: str | None = "nan") -> DataFrame:
    """ENC-1 fit: ``(value, code)`` with code = 0-based rank of the sorted distinct text.

    ``LabelEncoder().fit_transform(c.astype(str))``: NULL is the text ``'nan'`` (``null_text``).
    """
    v = F.col(col).cast("string")
    if null_text is not None:
        v = F.coalesce(v, F.lit(null_text))
    vals = df.select(v.alias("value")).where(F.col("value").isNotNull()).distinct()
    return with_global_row_number(vals, ["value"], "code").withColumn("code", F.col("code") - 1)


def apply_dictionary(df: DataFrame, col: str, dictionary: DataFrame, out: str,
                     null_text: str | None = "nan", unseen=None) -> DataFrame:
    """Map ``col`` through a ``(value, code)`` dictionary; unseen -> ``unseen``."""
    v = F.col(col).cast("string")
    if null_text is not None:
        v = F.coalesce(v, F.lit(null_text))
    d = dictionary.select(F.col("value").alias("__v"), F.col("code").alias(out))
    res = df.withColumn("__v", v).join(d, "__v", "left").drop("__v")
    if unseen is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), F.lit(unseen)))
    return res


def label_dictionaries(df: DataFrame, cols: Sequence[str], null_text: str = "nan") -> DataFrame:
    """ENC-2 fit: one ``(column, value, code)`` table for many text columns in one job.

    Unpivot -> distinct -> global numbering in ``(column, value)`` order -> subtract each column's
    first number. Fit it on ``unionByName(train, test)`` to share codes.
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(null_text)).alias("value"))
        for c in cols])).alias("s")).select("s.*").distinct()
    num = with_global_row_number(long, ["column", "value"], "rn")
    first = num.groupBy("column").agg(F.min("rn").alias("__first"))
    return num.join(first, "column").select("column", "value", (F.col("rn") - F.col("__first")).alias("code"))


def factorize_dictionary(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """ENC-3 fit: codes by first appearance in ``order`` (``pd.factorize``); NULL gets no code."""
    first = (df.where(F.col(col).isNotNull())
             .groupBy(F.col(col).cast("string").alias("value"))
             .agg(F.min(F.struct(*[F.col(o) for o in order])).alias("__first")))
    first = first.select("value", *[F.col(f"__first.{o}").alias(f"__o{i}") for i, o in enumerate(order)])
    num = with_global_row_number(first, [f"__o{i}" for i in range(len(order))], "code")
    return num.select("value", (F.col("code") - 1).alias("code"))


# ---------------------------------------------------------------- one-hot
def one_hot_exprs(col: str, values: Sequence, dummy_na: bool = False, prefix: str | None = None) -> list[Column]:
    """ENC-4/5: ``get_dummies``: one 0/1 column per value (NULL -> all zero), plus ``<c>_nan``."""
    p = col if prefix is None else prefix
    out = [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{p}_{v}") for v in values]
    if dummy_na:
        out.append(F.col(col).isNull().cast("int").alias(f"{p}_nan"))
    return out


def one_hot(df: DataFrame, cols: Sequence[str], dummy_na: bool = False) -> DataFrame:
    """ENC-4/5 over several text columns: the value lists of all columns are one parameter job."""
    keep = [F.col(c) for c in df.columns if c not in cols]
    values = distinct_values(df, *cols)
    return df.select(*keep, *[e for c in cols for e in one_hot_exprs(c, values[c], dummy_na)])


def one_hot_long(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """ENC-4 for columns of any number of categories: ``(key, column, value)`` for every indicator that is 1."""
    return df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
                     .alias("s")).select(key, "s.column", "s.value").where("value is not null")


# ---------------------------------------------------------------- frequency / target encodings
def frequency_encode(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """ENC-7: ``count(value) / total rows`` joined back (NULL values form no group -> NULL)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))  # one row per category
    total = F.sum("__n").over(Window.partitionBy())
    freq = counts.select(col, (F.col("__n") / total).alias(name or f"{col}_frequency")).where(F.col(col).isNotNull())
    return category_join(df, freq, col)


def _target(target: str, null_target: str) -> Column:
    """Q17: rows without a target count not at all (``ignore``) or as zeros (``zero``)."""
    if null_target not in ("ignore", "zero"):
        raise ValueError(f"null_target {null_target!r}")
    return F.coalesce(F.col(target), F.lit(0.0)) if null_target == "zero" else F.col(target)


def target_mean_fit(df: DataFrame, col: str, target: str, alpha: float = 5.0, global_mean: float | None = None,
                    null_target: str = "ignore") -> tuple[DataFrame, float]:
    """ENC-8 fit: ``(value, enc)`` with ``enc = (mean*n + global*alpha) / (n + alpha)`` over non-NULL
    targets; categories whose targets are all NULL get NULL (pandas ``mean`` of nothing)."""
    y = _target(target, null_target)
    if global_mean is None:
        global_mean = df.agg(F.avg(y)).first()[0]
    g = F.lit(global_mean)
    stats = (df.where(F.col(col).isNotNull()).groupBy(col)
             .agg(F.count(y).alias("__n"), F.sum(y).alias("__s")))
    enc = F.when(F.col("__n") > 0, (F.col("__s") + g * alpha) / (F.col("__n") + alpha))
    return stats.select(col, enc.alias("enc")), global_mean


def target_mean_apply(df: DataFrame, params: DataFrame, col: str, name: str) -> DataFrame:
    """ENC-8 apply: unseen categories stay NULL."""
    return category_join(df, params.withColumnRenamed("enc", name), col)


def target_mean_oof(df: DataFrame, col: str, target: str, fold: str, alpha: float = 5.0,
                    global_mean: float | None = None, name: str | None = None, null_target: str = "ignore") -> DataFrame:
    """ENC-9: out-of-fold smoothed target mean for every training row, in one pass.

    For a row in fold f the statistics come from the other folds:
    ``((S_c - S_cf) + g*alpha) / ((N_c - N_cf) + alpha)``, where S/N are sums/counts of non-NULL
    targets per category and per (category, fold), g the global mean of the whole training table.
    A category absent from the other folds yields g, which equals the reference's ``fillna(g)``.
    """
    y = _target(target, null_target)
    if global_mean is None:
        global_mean = df.agg(F.avg(y)).first()[0]
    g = F.lit(global_mean)
    per_cf = (df.where(F.col(col).isNotNull()).groupBy(col, fold)
              .agg(F.count(y).alias("__ncf"), F.coalesce(F.sum(y), F.lit(0.0)).alias("__scf")))
    w = Window.partitionBy(col)  # over the (category, fold) table: at most k rows per category
    per_cf = per_cf.select(col, fold, "__ncf", "__scf", F.sum("__ncf").over(w).alias("__nc"),
                           F.sum("__scf").over(w).alias("__sc"))
    enc = ((F.col("__sc") - F.col("__scf")) + g * alpha) / ((F.col("__nc") - F.col("__ncf")) + alpha)
    out = category_join(df, per_cf.select(col, fold, enc.alias(name or f"mean_k_fold_{col}")), [col, fold])
    return out.withColumn(name or f"mean_k_fold_{col}", F.coalesce(F.col(name or f"mean_k_fold_{col}"), g))


# ---------------------------------------------------------------- binning
def quantile_edges(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    """BIN-1/2 fit: exact quantile edges, duplicates dropped (``qcut(duplicates='drop')``), sorted."""
    qs = exact_quantiles(df, col, probs)
    seen, edges = set(), []
    for q in qs:
        if q is not None and q not in seen:
            seen.add(q)
            edges.append(q)
    return sorted(edges)


def bin_index(x: Column | str, edges: Sequence[float]) -> Column:
    """BIN apply: right-closed bins over sorted ``edges``, lowest edge included; outside -> NULL.

    Bin ``i`` holds ``edges[i] < x <= edges[i+1]`` (bin 0 also holds ``x == edges[0]``).
    """
    x = F.col(x) if isinstance(x, str) else x
    if len(edges) < 2:
        return F.lit(None).cast("int")
    arr = F.array(*[F.lit(float(e)) for e in edges])
    k = len(edges) - 1
    n_below = F.size(F.filter(arr, lambda e: e < x))
    return (F.when(x.isNull(), None).when(x == F.lit(float(edges[0])), F.lit(0))
            .when((x < F.lit(float(edges[0]))) | (x > F.lit(float(edges[-1]))), None)
            .otherwise(F.least(n_below - 1, F.lit(k - 1))).cast("int"))


def equal_width_edges(df: DataFrame, col: str, k: int) -> list[float]:
    """BIN-3 fit (``pd.cut(c, k)``): k equal-width bins over [min, max]; the first edge is lowered by
    0.1% of the range as pandas does, so the minimum falls in bin 0."""
    mm = df.agg(F.min(col), F.max(col)).first()
    lo, hi = float(mm[0]), float(mm[1])
    if hi == lo:
        lo, hi = lo - 0.001 * abs(lo) if lo else -0.001, hi + 0.001 * abs(hi) if hi else 0.001
        return [lo + i * (hi - lo) / k for i in range(k + 1)]
    edges = [lo + i * (hi - lo) / k for i in range(k + 1)]
    edges[0] = lo - (hi - lo) * 0.001
    return edges


# ---------------------------------------------------------------- scaling
def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """SCA-1 fit on train: ``{col: (min, max)}`` from one aggregate."""
    row = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    return {c: (row[f"mn_{c}"], row[f"mx_{c}"]) for c in cols}


def minmax_apply(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """SCA-1 apply: ``(x - min) / (max - min)``; a constant column maps to 0 (sklearn)."""
    out = df
    for c, (mn, mx) in params.items():
        rng = (mx - mn) if (mx is not None and mn is not None and mx != mn) else 1.0
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(mn)) / F.lit(rng))
    return out


def mean_range_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """SCA-2: ``(x - mean) / (max - min)`` with statistics of ``df`` itself (one aggregate)."""
    row = df.agg(*[F.avg(c).alias(f"a_{c}") for c in cols], *[F.min(c).alias(f"mn_{c}") for c in cols],
                 *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, F.try_divide(F.col(c) - F.lit(row[f"a_{c}"]),
                                                      F.lit(row[f"mx_{c}"] - row[f"mn_{c}"])))
    return out
