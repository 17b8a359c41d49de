"""Column profiling and pruning (AGG-17..23, PRN-1..3, NUL-2).

Per-column statistics are produced in one pass: a single one-row aggregate for null / zero / moment
counts and one ``groupBy(column)`` over the unpivoted table for distinct counts (partial
aggregation de-duplicates map-side), instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _long_from_one_row(row_df: DataFrame, cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Turn a one-row frame with ``<metric>__<col>`` fields into ``(column, metric...)`` rows."""
    structs = [F.struct(F.lit(c).alias("column"), *[F.col(f"{m}__{c}").alias(m) for m in metrics])
               for c in cols]
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def null_zero_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-18/19: per column ``n_rows, n_null, null_rate, n_zero`` in one scan."""
    exprs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        exprs.append(F.count_if(F.col(c).isNull()).alias(f"n_null__{c}"))
        dt = df.schema[c].dataType
        if isinstance(dt, T.NumericType):
            exprs.append(F.count_if(F.col(c) == 0).alias(f"n_zero__{c}"))
        else:
            exprs.append(F.lit(0).cast("bigint").alias(f"n_zero__{c}"))
    one = df.agg(*exprs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("__n").alias("n_rows"),
                     F.col(f"n_null__{c}").alias("n_null"),
                     (F.col(f"n_null__{c}") / F.col("__n")).alias("null_rate"),
                     F.col(f"n_zero__{c}").alias("n_zero")) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def distinct_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-17: distinct values per column, NULL counted as one value (``nunique(dropna=False)``)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("s")
    ).select("s.*")
    return long.groupBy("column").agg(
        (F.count_distinct("value") + F.max(F.col("value").isNull().cast("int"))).alias("n_distinct"))


def moment_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population variance (PRN-3) and mean / min / max per numeric column, one scan."""
    exprs = []
    for c in cols:
        x = F.col(c).cast("double")
        exprs += [F.var_pop(x).alias(f"var_pop__{c}"), F.avg(x).alias(f"mean__{c}"),
                  F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    return _long_from_one_row(df.agg(*exprs), cols, ["var_pop", "mean", "min", "max"])


def constant_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """PRN-1: columns with at most one value (NULL counts as a value)."""
    return [r["column"] for r in distinct_report(df, cols).where("n_distinct <= 1").collect()]


def null_rate_keep(df: DataFrame, cols: Sequence[str], max_rate: float = 0.8) -> list[str]:
    """PRN-2: columns whose null rate on ``df`` (train) is below ``max_rate`` (strict)."""
    rep = null_zero_report(df, cols).where(F.col("null_rate") < max_rate).select("column").collect()
    keep = {r[0] for r in rep}
    return [c for c in cols if c in keep]


def variance_keep(df: DataFrame, cols: Sequence[str], threshold: float = 0.02) -> list[str]:
    """PRN-3: ``VarianceThreshold`` -- keep columns whose population variance exceeds ``threshold``."""
    rep = moment_report(df, cols).where(F.col("var_pop") > threshold).select("column").collect()
    keep = {r[0] for r in rep}
    return [c for c in cols if c in keep]


def prune_columns(df: DataFrame, cols: Sequence[str], max_null_rate: float = 0.8, min_variance: float = 0.02) -> list[str]:
    """PRN-1/2/3 learned in one aggregate: the columns that are not constant (NULL counts as a value), have a null
    rate below ``max_null_rate`` and, if numeric, a population variance above ``min_variance``."""
    exprs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        exprs += [F.count(c).alias(f"n{i}"), (F.min(c) == F.max(c)).alias(f"one{i}")]
        if isinstance(df.schema[c].dataType, T.NumericType):
            exprs.append(F.var_pop(F.col(c).cast("double")).alias(f"var{i}"))
    row = df.agg(*exprs).first().asDict()  # one row
    keep = []
    for i, c in enumerate(cols):
        full = row[f"n{i}"] == row["n"]
        constant = row[f"n{i}"] == 0 or (full and row[f"one{i}"])
        variance = row.get(f"var{i}")
        if not constant and row["n"] - row[f"n{i}"] < max_null_rate * row["n"] and (f"var{i}" not in row or (variance or 0) > min_variance):
            keep.append(c)
    return keep


def type_counts(df: DataFrame) -> DataFrame:
    """AGG-20: columns and non-NULL values per kind of type (``whole``, ``real``, ``text``, ``time``, ``other``), in
    one aggregate."""
    def kind(t: T.DataType) -> str:
        if isinstance(t, T.IntegralType):
            return "whole"
        if isinstance(t, T.NumericType):
            return "real"
        if isinstance(t, T.StringType):
            return "text"
        return "time" if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "other"

    kinds: dict[str, list[str]] = {}
    for f in df.schema.fields:
        kinds.setdefault(kind(f.dataType), []).append(f.name)
    one = df.agg(*[sum((F.count(c) for c in cols[1:]), F.count(cols[0])).alias(k) for k, cols in kinds.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(len(cols)).cast("bigint").alias("n_columns"),
                                                   F.col(k).alias("n_values")) for k, cols in kinds.items()])).alias("s")).select("s.*")


def group_modes(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """AGG-21: most frequent non-NULL value of each column per group (ties: smallest), as ``<col>_mode``.

    From counts of ``(keys, value)``: no buffer holds the distinct values of a group."""
    out = df.select(*keys).distinct()
    for c in cols:
        n = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("__n"))
        best = n.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col(c).alias("v")))["v"].alias(f"{c}_mode"))
        out = out.join(best, list(keys), "left")
    return out


def text_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent non-NULL value of text columns (ties: smallest), one job for all of them."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cols])).alias("s")).select("s.*")
    n = long.where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("v"))
    return {r["c"]: r["v"] for r in best.collect()}  # one row per column


def group_median(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """AGG-5: exact median per group, from counts of ``(keys, value)`` and their running sums."""
    n = df.select(*keys, value.cast("double").alias("__v")).where("__v is not null").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys)
    upto, total = F.sum("__n").over(w.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)), F.sum("__n").over(w)
    ranked = n.select(*keys, "__v", upto.alias("__to"), (upto - F.col("__n")).alias("__from"), total.alias("__all"))
    def holds(rank):
        return (F.col("__from") < rank) & (rank <= F.col("__to"))
    low, high = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    return ranked.groupBy(*keys).agg(((F.max(F.when(holds(low), F.col("__v"))) + F.max(F.when(holds(high), F.col("__v")))) / 2).alias(name))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-22: Pearson correlation for every ordered pair, in one aggregate, as ``(col_a, col_b, corr)``."""
    pairs = [(a, b) for a in cols for b in cols]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c__{a}__{b}")
                   for a, b in pairs])
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c__{a}__{b}").alias("corr"))
               for a, b in pairs]
    return one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def equal_width_histogram(df: DataFrame, col: str, bins: int, lo: float | None = None,
                          hi: float | None = None, density: bool = False) -> DataFrame:
    """AGG-23 (``np.histogram``): ``bins`` equal-width bins over [lo, hi] (defaults: min / max of the
    column, one parameter job). Last bin is closed on the right. Returns
    ``(bin, left, right, count[, density])`` for every bin, empty bins included."""
    if lo is None or hi is None:
        mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo = mm["lo"] if lo is None else lo
        hi = mm["hi"] if hi is None else hi
    lo, hi = float(lo), float(hi)
    if hi == lo:  # numpy widens a degenerate range by 0.5 on each side
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counted = (df.where(x.isNotNull() & (x >= lo) & (x <= hi)).groupBy(idx.alias("bin"))
               .agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (all_bins.join(counted, "bin", "left")
           .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
                   (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"),
                   F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
    if density:
        total = F.sum("count").over(Window.partitionBy())  # over `bins` rows only
        out = out.withColumn("density", F.col("count") / (total * F.lit(width)))
    return out


def impute_mean_mode(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """NUL-2: fill numeric NULLs with the column mean, text NULLs with the column mode (one
    aggregate of the means, one of the value counts)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
    if not num and not txt:
        return df
    means = df.agg(*[F.avg(c).alias(c) for c in num]).first().asDict() if num else {}
    fills = {**{c: v for c, v in means.items() if v is not None}, **(text_modes(df, txt) if txt else {})}
    out = df
    for c, v in fills.items():
        # a mean of integers is no integer: filled numeric columns become double
        col = F.col(c).cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else F.col(c)
        out = out.withColumn(c, F.coalesce(col, F.lit(v)))
    return out
