"""Lag-key leak search over an ordered list of columns (LEK-1..4, JN-7, SRT-6, Q9).

Columns ``cols`` are ordered newest first. For lag ``L`` (0..n-3) the key of a row seen "as the
target row" is ``cols[:n-L-2]`` and the key of a row seen "as the source row" is ``cols[L+2:]``; when a
target key equals exactly one source key, the source row's ``cols[L]`` is the leaked value.

All lags are one plan: a row becomes one narrow row for each lag with the hashes of its two keys, source keys that
occur more than once per lag are dropped with one aggregate, and one equi-join on the hashes finds every match.
The per-lag statistics then come from a table with one row per lag.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featmart.functions.rows import nonzero_row_mean, pack

LOG_FALLBACK = 14.49  # fixed value: log-space fill for rows without any estimate


#: Odd multipliers of the two polynomial hashes that make a 128-bit key (fixed values, any would do).
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit values whose every bit depends on every bit of the input."""
    x = x + np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _lag_keys(n: int, fields: Sequence[str]):
    """For Arrow batches of ``(id, n values)``: one row for each lag with the hashes of the row's key as a target, those
    of its key as a source, and the value it would leak.

    A row's values are hashed once; running sums of ``hash * base**i`` make the hash of every stretch a difference of two
    sums (times a power that shifts it to the origin), so a lag costs the same however long its key is."""
    lags = np.arange(n - 2)
    up, down = [], []
    for base in _BASES:
        for powers, step in ((up, base), (down, pow(base, -1, 1 << 64))):
            p = np.full(n + 1, np.uint64(step), dtype=np.uint64)
            p[0] = 1
            powers.append(np.cumprod(p, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            m = len(batch)
            column = batch.column(1)
            cells = column.flatten()
            missing = cells.is_null().to_numpy(zero_copy_only=False)
            v = pc.fill_null(cells, 0.0).to_numpy(zero_copy_only=False) + 0.0  # -0.0 counts as 0.0
            bits = np.where(np.isnan(v), np.uint64(0x7FF8000000000000), v.view(np.uint64))
            bits = np.where(missing, np.uint64(0xFFF8000000000001), bits).reshape(m, n)
            keys = []
            for k, base in enumerate(_BASES):
                sums = np.zeros((m, n + 1), dtype=np.uint64)
                np.cumsum(_mixed(bits, base) * up[k][:n], axis=1, dtype=np.uint64, out=sums[:, 1:])
                target = sums[:, n - 2 - lags]
                source = (sums[:, n:] - sums[:, lags + 2]) * down[k][lags + 2]
                keys += [_mixed(target, 1), _mixed(source, 1)]
            value = pa.array(v.reshape(m, n)[:, :n - 2].ravel(), mask=missing.reshape(m, n)[:, :n - 2].ravel())
            t1, s1, t2, s2 = (pa.array(x.ravel().view(np.int64)) for x in keys)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(m), n - 2)))
            yield pa.record_batch([ids, pa.array(np.tile(lags, m).astype(np.int32)), t1, t2, s1, s2, value], names=list(fields))

    return run


def lag_matches(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """LEK-1: ``(id, lag, pred)`` for every (row, lag) whose key matches a unique source key.

    Unmatched (row, lag) pairs are absent (the reference's 0). Keys are 128-bit hashes, made from a row's prefix hashes
    (the work is linear in the number of columns); NULL equals NULL in a key. Only ids, hashes and the value that
    would leak are shuffled: source keys are counted per lag with one aggregate, and one join finds all matches.
    """
    n = len(cols)
    base = df.select(F.col(id_col).alias("__id"), pack(list(cols)).alias("__a"))
    if n < 3:
        return base.select(F.col("__id").alias(id_col), F.lit(0).alias("lag"), F.element_at("__a", 1).alias("pred")).where("false")
    fields = ["__id", "lag", "t1", "t2", "s1", "s2", "pred"]
    schema = T.StructType([T.StructField("__id", df.schema[id_col].dataType), T.StructField("lag", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in fields[2:6]), T.StructField("pred", T.DoubleType())])
    keys = base.mapInArrow(_lag_keys(n, fields), schema)
    once = keys.groupBy("lag", F.col("s1").alias("t1"), F.col("s2").alias("t2")).agg(F.count(F.lit(1)).alias("__c"), F.min("pred").alias("pred")).where("__c = 1")
    return keys.select("__id", "lag", "t1", "t2").join(once, ["lag", "t1", "t2"]).select(F.col("__id").alias(id_col), "lag", "pred")


def compile_leak(df: DataFrame, id_col: str, cols: Sequence[str], max_lag: int | None = None) -> DataFrame:
    """LEK-2 per row: first lag (``<= max_lag``) with a non-zero leaked value and that value."""
    m = lag_matches(df, id_col, cols).where((F.col("pred").isNotNull()) & (F.col("pred") != 0))
    if max_lag is not None:
        m = m.where(F.col("lag") <= max_lag)
    first = m.groupBy(id_col).agg(F.min_by(F.struct("lag", "pred"), F.col("lag")).alias("__f"))
    first = first.select(id_col, F.col("__f.lag").alias("first_lag"), F.col("__f.pred").alias("leak"))
    return df.join(first, id_col, "left")


def leak_lag_stats(df: DataFrame, id_col: str, target: str, cols: Sequence[str],
                   stat_cols: Sequence[str] | None = None, compiled: bool = False) -> DataFrame:
    """LEK-2 per lag ``L``: ``leaky_count`` (rows with compiled leak > 0 using lags <= L),
    ``leaky_correct`` (share of those rows... as the reference: rows with compiled == target divided
    by leaky_count) and ``score`` = RMSE in log space of the compiled leak using lags < L, with the
    non-zero row mean where it is still 0 (Q9), NULL estimates -> 14.49.

    Rows are first reduced to ``(first_lag, value)``; the per-lag numbers are running sums over a
    table with one row per lag. ``compiled``: ``df`` is the result of :func:`compile_leak`.
    """
    n = len(cols)
    none = n - 2  # first_lag of rows without any leak
    rows = df if compiled else compile_leak(df, id_col, cols)
    nzm = nonzero_row_mean(pack(list(stat_cols or cols)))
    y = F.log1p(F.col(target))
    leak_est = F.coalesce(F.log1p(F.col("leak")), F.lit(LOG_FALLBACK))
    fb_est = F.coalesce(F.log1p(nzm), F.lit(LOG_FALLBACK))
    r = rows.select(F.coalesce(F.col("first_lag"), F.lit(none)).alias("f"), F.col("leak"), F.col(target),
                    F.pow(y - leak_est, 2).alias("sse_leak"), F.pow(y - fb_est, 2).alias("sse_fb"))
    per_f = r.groupBy("f").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("leak") > 0).alias("pos"),
        F.count_if(F.col("leak") == F.col(target)).alias("match"),
        F.count_if(F.col(target) == 0).alias("zero_t"),
        F.sum("sse_leak").alias("sse_leak"), F.sum("sse_fb").alias("sse_fb"))
    spark = df.sparkSession
    grid = spark.range(n - 1).select(F.col("id").cast("int").alias("f")).join(per_f, "f", "left").na.fill(0)
    w_le = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, 0)  # over n-1 rows
    w_all = Window.partitionBy()
    g = grid.select(
        "f",
        F.sum("n").over(w_all).alias("N"),
        F.sum("pos").over(w_le).alias("cnt_le"),
        F.sum("match").over(w_le).alias("match_le"),
        (F.sum("zero_t").over(w_all) - F.sum("zero_t").over(w_le)).alias("zero_gt"),
        (F.sum("sse_leak").over(w_le) - F.col("sse_leak")).alias("sse_lt"),
        (F.sum("sse_fb").over(w_all) - F.sum("sse_fb").over(w_le) + F.col("sse_fb")).alias("sse_ge"))
    return (g.where(F.col("f") < none)
            .select(F.col("f").alias("lag"), F.col("cnt_le").alias("leaky_count"),
                    F.try_divide((F.col("match_le") + F.col("zero_gt")).cast("double"), F.col("cnt_le"))
                    .alias("leaky_correct"),
                    F.sqrt((F.col("sse_lt") + F.col("sse_ge")) / F.col("N")).alias("score")))


def best_lag(stats: DataFrame) -> DataFrame:
    """LEK-3 / SRT-6: ``argmin`` of the score (ties -> smallest lag) with the best score."""
    return stats.agg(F.min_by(F.struct("score", "lag"), F.struct("score", "lag")).alias("b")) \
        .select(F.col("b.lag").alias("best_lag"), F.col("b.score").alias("best_score"))


def rewrite_leak(df: DataFrame, id_col: str, cols: Sequence[str], lag: int, compiled: bool = False,
                 keep: Sequence = ()) -> DataFrame:
    """LEK-3: compiled leak using lags ``< lag``; 0 becomes NULL (the hand-off table). A row's first lag
    with a value does not depend on the limit, so compiled rows serve every limit."""
    out = df if compiled else compile_leak(df, id_col, cols)
    leak = F.when(F.col("first_lag") < lag, F.col("leak"))
    return out.select(id_col, F.nullif(F.coalesce(leak, F.lit(0.0)), F.lit(0.0)).alias("compiled_leak"), *keep)


def override(pred: str, leak: str):
    """LEK-4: the known value replaces the model prediction where present."""
    return F.coalesce(F.col(leak), F.col(pred))
