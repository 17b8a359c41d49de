"""Exact order statistics of many columns at once, without sorting rows.

Three passes over the pruned columns, each a map-side aggregate: a sketch proposes cut values around the wanted
ranks, exact counts of the intervals they make tell in which interval each rank lies, and only the intervals that
are not a single value are looked into, by counting their distinct values. The sketch decides how small these
intervals are, never the result. A value held by many rows is one counter in every task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketch: an interval beside a wanted rank holds about 4 / ACCURACY of the rows at most.
ACCURACY = 10_000


def _number(col: str) -> Column:
    """The column as a double; NULL and NaN are no values."""
    x = F.col(f"`{col}`").cast("double")
    return F.when(~F.isnan(x), x)


def bucket_indexes(df: DataFrame, splits: dict[str, Sequence[float]], name: Callable[[str], str]) -> DataFrame:
    """``df`` with, for every column, how many of its ascending ``splits`` are not above the value (NULL and NaN: NULL).
    A binary search in the JVM."""
    taken = set(df.columns)
    for i, (c, cuts) in enumerate(splits.items()):
        work = f"__number_{i}"
        assert work not in taken
        df = df.withColumn(work, _number(c))
        if len(cuts):
            edges = [-math.inf, *(float(x) for x in cuts), math.inf]
            edges = [e for k, e in enumerate(edges) if k == 0 or e > edges[k - 1]]
            low = 1 if math.isinf(cuts[0]) and cuts[0] < 0 else 0  # a cut at -inf is below every value
            df = Bucketizer(splits=edges, inputCol=work, outputCol=f"{work}_b", handleInvalid="keep").transform(df)
            df = df.withColumn(name(c), (F.col(f"{work}_b") + low).cast("int")).drop(f"{work}_b", work)
        else:
            df = df.withColumn(name(c), F.when(F.col(work).isNotNull(), 0).cast("int")).drop(work)
    return df


def _long(df: DataFrame, cols: Sequence[str], splits: dict[str, list[float]]) -> DataFrame:
    """``c, b, v``: number of the column, interval and value of every cell that has one."""
    cells = bucket_indexes(df.select(*[F.col(f"`{c}`") for c in cols]), splits, lambda c: f"__b_{list(cols).index(c)}")
    listed = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"__b_{i}").alias("b"), _number(c).alias("v")) for i, c in enumerate(cols)])
    return cells.select(F.inline(listed)).where("b IS NOT NULL")


def values_at(df: DataFrame, cols: Sequence[str], probs: Sequence[float], ranks: Callable[[float, int], Sequence[int]],
              accuracy: int = ACCURACY) -> dict[str, tuple[int, dict[int, float]]]:
    """Per column the number ``n`` of its values and the values at the 1-based ranks ``ranks(p, n)`` of all ``probs``."""
    cols, probs = list(dict.fromkeys(cols)), list(probs)
    if not cols or not probs:
        return {c: (0, {}) for c in cols}
    near = sorted({min(1.0, max(0.0, p + d / accuracy)) for p in probs for d in (-2, 0, 2)})
    row = df.agg(*[F.struct(F.count(_number(c)).alias("n"), F.percentile_approx(_number(c), near, accuracy).alias("cuts")).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    splits = {}
    for i, c in enumerate(cols):
        cuts = [float(x) for x in row[f"c{i}"]["cuts"] or []]
        # every cut value is an interval of its own
        splits[c] = sorted({float(y) for x in cuts for y in (x, np.nextafter(x, math.inf))})
    counts: dict[int, dict[int, int]] = {i: {} for i in range(len(cols))}
    for r in _long(df, cols, splits).groupBy("c", "b").agg(F.count(F.lit(1)).alias("n")).collect():  # one row an interval
        counts[r["c"]][r["b"]] = r["n"]
    out, wanted = {}, []
    for i, c in enumerate(cols):
        n, found, before = sum(counts[i].values()), {}, 0
        rest = sorted({r for p in probs for r in ranks(p, n)}) if n else []
        for b in sorted(counts[i]):
            here = [r for r in rest if before < r <= before + counts[i][b]]
            single = b > 0 and (b == len(splits[c]) or np.nextafter(splits[c][b - 1], math.inf) >= splits[c][b]) and math.isfinite(splits[c][b - 1])
            if single and b < len(splits[c]):
                found.update(dict.fromkeys(here, splits[c][b - 1]))
            else:
                wanted += [(i, b, r - before, r) for r in here]
            before += counts[i][b]
        out[c] = (n, found)
    if wanted:
        inside = _long(df, cols, splits).join(F.broadcast(df.sparkSession.createDataFrame(sorted({w[:2] for w in wanted}), "c int, b int")), ["c", "b"])
        values = inside.groupBy("c", "b", "v").agg(F.count(F.lit(1)).alias("m"))
        upto = F.sum("m").over(Window.partitionBy("c", "b").orderBy("v"))
        asked = df.sparkSession.createDataFrame(wanted, "c int, b int, k long, r long")  # at most two for each column and probability
        hit = values.withColumn("upto", upto).join(F.broadcast(asked), ["c", "b"]).where("upto - m < k AND k <= upto")
        for r in hit.select("c", "r", "v").collect():
            out[cols[r["c"]]][1][r["r"]] = r["v"]
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles (``percentile_cont``) of each column; ``None`` for a column without values."""
    def ranks(p, n):
        return int(p * (n - 1)) + 1, min(int(p * (n - 1)) + 2, n)

    out = {}
    for c, (n, at) in values_at(df, cols, probs, ranks).items():
        out[c] = []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            low, high = (at[r] for r in ranks(p, n))
            out[c].append(low if low == high else low + (p * (n - 1) - int(p * (n - 1))) * (high - low))
    return out


def equal_count_cuts(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """For each column at most ``bins - 1`` ascending cuts that deal its rows as evenly as ties allow: the values at the
    ranks ``ceil(j * n / bins)``, the largest value left out. Bin ``k`` holds ``cuts[k - 1] < x <= cuts[k]``."""
    probs = [j / bins for j in range(1, bins)] + [1.0]

    def ranks(p, n):
        return (max(1, -(-round(p * bins) * n // bins)),)

    out = {}
    for c, (n, at) in values_at(df, cols, probs, ranks).items():
        cuts = sorted({at[r] for p in probs[:-1] for r in ranks(p, n)}) if n else []
        out[c] = [x for x in cuts if x < at[n]] if n else []
    return out


def equal_count_bins(df: DataFrame, cuts: dict[str, Sequence[float]], name: Callable[[str], str]) -> DataFrame:
    """``df`` with the bin of every column under :func:`equal_count_cuts` (NULL and NaN: NULL)."""
    above = {c: [float(np.nextafter(x, math.inf)) for x in xs] for c, xs in cuts.items()}
    return bucket_indexes(df, above, name)
