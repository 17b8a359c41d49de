"""MDL-7: a one-class boundary (novelty detection fitted on the normal class, a share ``nu`` of it outside).

A Gaussian kernel is approximated by random Fourier features, in which the one-class problem is to find the point of
least norm among the weighted means of rows where no weight exceeds ``1 / (nu * n)``. Frank-Wolfe steps find it: a step
needs the mean feature vector of the ``nu`` share of rows with the lowest scores, which is one aggregate, and an
exact line search over two vectors on the driver. The offset is the exact ``nu`` quantile of the scores, so the share
of the training class outside does not depend on how far the steps went.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.operators.ranks import values_at
from featmart.session import materialize


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _mean(rows: DataFrame, components: int) -> np.ndarray:
    """Mean of the arrays ``phi``: one aggregate, one row a component."""
    found = rows.select(F.posexplode("phi").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).collect()
    out = np.zeros(components)
    for r in found:
        out[r["i"]] = r["m"]
    return out


@dataclass
class OneClass:
    features: list[str]
    centre: list[float]
    spread: list[float]
    directions: np.ndarray  # components x features
    phases: np.ndarray
    weights: np.ndarray
    offset: float

    def mapped(self) -> Column:
        """The random Fourier features of a row as one array; a NULL or NaN value counts as the training mean."""
        z = []
        for f, m, s in zip(self.features, self.centre, self.spread):
            x = F.col(f"`{f}`").cast("double")
            z.append(F.coalesce(F.when(~F.isnan(x), (x - m) / s), F.lit(0.0)))
        waves = F.array(*[F.array(F.lit(float(b)), *(F.lit(float(a)) for a in w)) for w, b in zip(self.directions, self.phases)])
        row = F.array(F.lit(1.0), *z)
        return F.transform(waves, lambda w: F.cos(_dot(w, row)) * math.sqrt(2.0 / len(self.phases)))

    def score(self, mapped: Column) -> Column:
        return _dot(mapped, F.array(*(F.lit(float(w)) for w in self.weights)))

    def predict(self, df: DataFrame, margin: str = "margin", flag: str = "flagged") -> DataFrame:
        """``df`` with the distance inside the boundary (negative: outside) and the 0/1 flag of the rows outside."""
        return df.withColumn(margin, self.score(self.mapped()) - self.offset).withColumn(flag, (F.col(margin) < 0).cast("int"))


def fit(normal: DataFrame, features: Sequence[str], nu: float = 0.1, gamma: float | None = None, components: int = 64,
        steps: int = 20, seed: int = 0, tol: float = 1e-9) -> OneClass:
    """The boundary around ``normal``. ``gamma`` is the kernel's width on standardised features (default: one over their
    number). Needs at least one row."""
    features = list(features)
    numbers = {f: F.when(~F.isnan(F.col(f"`{f}`").cast("double")), F.col(f"`{f}`").cast("double")) for f in features}
    row = normal.agg(*[F.struct(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).alias(f"c{i}") for i, x in enumerate(numbers.values())],
                     F.count(F.lit(1)).alias("n")).first()
    if not row["n"]:
        raise ValueError("no rows of the normal class")
    rng = np.random.default_rng(seed)
    gamma = 1.0 / len(features) if gamma is None else gamma
    model = OneClass(features, [row[f"c{i}"]["m"] or 0.0 for i in range(len(features))], [row[f"c{i}"]["s"] or 1.0 for i in range(len(features))],
                     rng.normal(0, math.sqrt(2 * gamma), (components, len(features))), rng.uniform(0, 2 * math.pi, components), np.zeros(components), 0.0)
    rows = materialize(normal.select(model.mapped().alias("phi")))
    model.weights = _mean(rows, components)
    for _ in range(steps):
        scored = rows.withColumn("score", model.score(F.col("phi")))
        limit = scored.agg(F.percentile_approx("score", nu, 10_000)).first()[0]
        gap = model.weights - _mean(scored.where(F.col("score") <= limit), components)
        if float(model.weights @ gap) <= tol:
            break
        model.weights = model.weights - min(1.0, float(model.weights @ gap) / float(gap @ gap)) * gap
    n, at = values_at(rows.select(model.score(F.col("phi")).alias("score")), ["score"], [nu], lambda p, n: (min(int(p * n) + 1, n),))["score"]
    model.offset = at[min(int(nu * n) + 1, n)]
    return model
