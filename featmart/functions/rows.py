"""Row-wise statistics across many columns (ARR-1/2/3, NUL-3).

Wide matrices are packed into one ``array<double>`` column and reduced with higher-order functions
(``filter`` / ``aggregate`` / ``array_sort``), so a thousand-column row is one expression instead of
a thousand generated projections (SURVEY §7.5 "wide data").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["pack", "row_key", "nonzero", "row_stats", "nonzero_row_mean", "array_sum",
           "array_median"]


def pack(cols: list[str]) -> Column:
    """ARR-3 / wide data: the listed columns as one ``array<double>`` (column order kept)."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def row_key(cols: list[str]) -> Column:
    """ARR-3: tuple-of-columns key as an array (equality/hashing work on arrays)."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def nonzero(arr: Column) -> Column:
    """Values that are neither NULL nor 0 (``replace(0, nan)`` followed by a skip-NaN reduction)."""
    return F.filter(arr, lambda x: x.isNotNull() & (x != F.lit(0.0)))


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def array_median(arr: Column) -> Column:
    """Exact median of a NULL-free array (NULL when empty)."""
    s = F.array_sort(arr)
    n = F.size(s)
    lo = F.try_element_at(s, F.floor((n - 1) / 2).cast("int") + 1)
    hi = F.try_element_at(s, F.floor(n / 2).cast("int") + 1)
    return F.when(n > 0, (lo + hi) / 2.0)


def row_stats(arr: Column) -> dict[str, Column]:
    """ARR-1 on an ``array<double>`` in which 0 means missing.

    Returns the eight statistics of the reference, named as there:
    ``log_of_mean`` log1p(mean of non-zero), ``mean_of_log`` mean(log1p(non-zero)),
    ``log_of_median``, ``nb_nans`` (count of zero/NULL cells), ``the_sum`` log1p(sum),
    ``the_std`` sample std (n-1, NULL below 2 values), ``the_kur`` bias-corrected excess kurtosis
    (NULL below 4 values, 0 for constant rows).
    """
    nz = nonzero(arr)
    n = F.size(nz).cast("double")
    total = array_sum(nz)
    mean = F.when(n > 0, total / n)
    m2 = F.aggregate(nz, F.lit(0.0), lambda acc, x: acc + F.pow(x - mean, 2))
    m4 = F.aggregate(nz, F.lit(0.0), lambda acc, x: acc + F.pow(x - mean, 4))
    kur = F.when(n < 4, F.lit(None).cast("double")).when(m2 == 0, F.lit(0.0)).otherwise(
        (n * (n + 1) * (n - 1) * m4) / ((n - 2) * (n - 3) * m2 * m2)
        - 3 * (n - 1) * (n - 1) / ((n - 2) * (n - 3)))
    return {
        "log_of_mean": F.log1p(mean),
        "mean_of_log": F.when(n > 0, F.aggregate(nz, F.lit(0.0), lambda acc, x: acc + F.log1p(x)) / n),
        "log_of_median": F.log1p(array_median(nz)),
        "nb_nans": (F.size(arr) - F.size(nz)).cast("bigint"),
        "the_sum": F.log1p(total),
        "the_std": F.when(n >= 2, F.sqrt(m2 / (n - 1))),
        "the_kur": kur,
    }


def nonzero_row_mean(arr: Column) -> Column:
    """ARR-2: ``expm1(mean(log1p(x[x != 0])))``; NULL for an all-zero row."""
    nz = nonzero(arr)
    n = F.size(nz)
    return F.when(n > 0, F.expm1(F.aggregate(nz, F.lit(0.0), lambda acc, x: acc + F.log1p(x)) / n))
