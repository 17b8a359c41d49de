"""Trees and boosted stumps of one feature at a time, grown on counts of bins (EVL-8, EVL-9).

Such a model is constant inside a bin, so all it needs of the rows are the sums of each ``(feature, fold, bin)``: one
pass cuts every feature into equal-count bins (an outlier moves no cut), one aggregate makes the sums. What is left
for a feature is a table of ``folds * bins`` cells whatever the input; these small groups are dealt over the cluster
and grown in numpy. NULL and NaN are a bin of their own that a split sends to either side.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.operators.ranks import equal_count_bins, equal_count_cuts
from featmart.operators.split import kfold


def best_split(r: np.ndarray, n: np.ndarray, l2: float, min_rows: int, scale: float):
    """Of bins with sums ``r`` over ``n`` rows, the first entry being the missing ones: ``(worth, bin, missing_left,
    left mask, left mean, right mean)`` of the split with the largest gain, ``None`` without any. Means are shrunk by
    ``l2``; gains are compared after rounding to 12 digits of ``scale`` (ties: lowest bin, missing rows to the right)."""
    total_r, total_n = r.sum(), n.sum()
    best = None
    for missing_left in ((False, True) if n[0] > 0 else (False,)):
        lr, ln = np.cumsum(r[1:]) + missing_left * r[0], np.cumsum(n[1:]) + missing_left * n[0]
        rr, rn = total_r - lr, total_n - ln
        ok = (ln >= min_rows) & (rn >= min_rows) & (n[1:] > 0)
        if not ok.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            worth = np.round((lr * lr / (ln + l2) + rr * rr / (rn + l2) - total_r * total_r / (total_n + l2)) / scale, 12)
        worth[~ok] = -1
        at = int(np.argmax(worth))
        if worth[at] > 0 and (best is None or (-worth[at], at, missing_left) < best[:3]):
            left = np.arange(len(n)) <= at + 1
            left[0] = missing_left
            best = (-worth[at], at, missing_left, left, lr[at] / (ln[at] + l2), rr[at] / (rn[at] + l2))
    return best


def _auc(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float | None:
    """Area under the curve of bins with counts of both classes; ties count half."""
    if pos.sum() == 0 or neg.sum() == 0:
        return None
    _, place = np.unique(score, return_inverse=True)
    p, q = np.bincount(place, weights=pos), np.bincount(place, weights=neg)
    return float((p * (np.cumsum(q) - q / 2)).sum() / (p.sum() * q.sum()))


def _tree_scores(pos: np.ndarray, n: np.ndarray, depth: int, min_rows: int) -> np.ndarray:
    """The share of positives in each bin's leaf, of a tree grown on the counts ``pos`` of ``n``."""
    scale = pos.sum() * (1 - pos.sum() / max(n.sum(), 1))
    out = np.full(len(n), pos.sum() / n.sum() if n.sum() else 0.5)
    groups = [np.ones(len(n), dtype=bool)]
    for _ in range(depth):
        nxt = []
        for g in groups:
            split = best_split(np.where(g, pos, 0), np.where(g, n, 0), 0.0, min_rows, scale) if scale > 0 else None
            if split:
                left, right = g & split[3], g & ~split[3]
                out[left], out[right] = split[4], split[5]
                nxt += [left, right]
        groups = nxt
    return out


def drift_report(train: DataFrame, test: DataFrame, features: Sequence[str], id_col: str, threshold: float = 0.8, top: int | None = None,
                 bins: int = 32, folds: int = 4, depth: int = 5, min_rows: int = 5, seed: int = 0) -> DataFrame:
    """EVL-8 (adversarial validation, one feature at a time): how well each feature alone tells test rows (``origin`` 1)
    from train rows. In each fold a tree of at most ``depth`` levels, grown on the other folds, scores the fold's rows;
    ``drift_score`` is the mean area under the curve, ``drifted`` = above ``threshold``."""
    features = list(features)
    both = (train.select(id_col, *features).withColumn("origin", F.lit(0))
            .unionByName(test.select(id_col, *features).withColumn("origin", F.lit(1)))).withColumn("__fold", kfold(id_col, folds, seed))
    cuts = equal_count_cuts(both, features, bins)
    binned = equal_count_bins(both, cuts, lambda c: f"__bin_{features.index(c)}")
    listed = F.array(*[F.struct(F.lit(f).alias("feature"), F.coalesce(f"__bin_{i}", F.lit(-1)).alias("bin")) for i, f in enumerate(features)])
    cells = binned.select("origin", "__fold", F.explode(listed).alias("s")).groupBy("s.feature", "s.bin", F.col("__fold").alias("fold")).agg(
        F.count_if(F.col("origin") == 1).alias("pos"), F.count(F.lit(1)).alias("n"))

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        pos, n = (np.zeros((folds, bins + 1)) for _ in range(2))
        at = rows["fold"].to_numpy(), rows["bin"].to_numpy() + 1
        pos[at], n[at] = rows["pos"], rows["n"]
        found = [_auc(_tree_scores(pos.sum(0) - pos[k], n.sum(0) - n[k], depth, min_rows), pos[k], n[k] - pos[k]) for k in range(folds)]
        found = [a for a in found if a is not None]
        return pd.DataFrame({"feature": [rows["feature"].iloc[0]], "drift_score": [float(np.mean(found)) if found else None]})

    rep = cells.groupBy("feature").applyInPandas(score, "feature string, drift_score double")
    rep = rep.withColumn("drifted", F.col("drift_score") > threshold)
    return rep if top is None else rep.orderBy(F.desc("drift_score"), "feature").limit(top)


def _boost(train_s, train_n, score_s, score_n, score_ss, rounds, rate, l2, scale, patience) -> tuple[float, int]:
    """Root mean square of the scored fold under stumps on two binned columns, at its best round, and that round."""
    pred = np.full(train_n.shape, train_s.sum() / train_n.sum() if train_n.sum() else 0.0)

    def loss():
        return round((score_ss.sum() - 2 * (pred * score_s).sum() + (score_n * pred * pred).sum()) / score_n.sum(), 12)

    best = (loss(), 0)
    for k in range(1, rounds + 1):
        rest = train_s - train_n * pred
        tried = [(s, axis) for axis in (0, 1) if (s := best_split(rest.sum(1 - axis), train_n.sum(1 - axis), l2, 1, scale))]
        if not tried:
            break
        split, axis = min(tried, key=lambda t: (t[0][0], t[1]))
        add = np.where(split[3], split[4], split[5]) * rate
        pred = pred + (add[:, None] if axis == 0 else add[None, :])
        now = loss()
        if now < best[0]:
            best = (now, k)
        elif k - best[1] >= patience:
            break
    return float(np.sqrt(max(best[0], 0.0))), best[1]


def boosted_feature_report(df: DataFrame, y: str, base: str, fold: str, features: Sequence[str], rounds: int = 1000, rate: float = 0.1,
                           l2: float = 1.0, patience: int = 50, bins: int = 16) -> DataFrame:
    """EVL-9: for each feature the cross-validated RMSE of boosted stumps on ``(base, feature)``, every fold scored by a
    model of the others that stops when the fold's loss has not fallen for ``patience`` rounds; with the mean of the
    rounds kept, and the feature's zero and distinct counts. All features and folds are grown from the sums of
    ``(feature, fold, bin of base, bin of feature)``; rows without ``y`` are left out."""
    features = list(features)
    rows = df.select(F.col(y).cast("double").alias("__y"), F.col(fold).alias("__fold"), F.col(base).alias("__base"), *features).where("__y IS NOT NULL")
    cuts = equal_count_cuts(rows, ["__base", *features], bins)
    names = ["__base", *features]
    binned = equal_count_bins(rows, cuts, lambda c: f"__bin_{names.index(c)}")
    listed = F.array(*[F.struct(F.lit(f).alias("feature"), F.coalesce(f"__bin_{i}", F.lit(-1)).alias("bin"), (F.col(f).cast("double") == 0).alias("zero"))
                       for i, f in enumerate(features, 1)])
    long = binned.select("__y", "__fold", F.coalesce("__bin_0", F.lit(-1)).alias("base_bin"), F.explode(listed).alias("s"))
    cells = long.groupBy("s.feature", F.col("__fold").alias("fold"), "base_bin", "s.bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("__y").alias("s"), F.sum(F.col("__y") * F.col("__y")).alias("ss"), F.count_if("s.zero").alias("zero"))

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        folds, place = np.unique(rows["fold"].to_numpy(), return_inverse=True)
        n, s, ss = (np.zeros((len(folds), bins + 1, bins + 1)) for _ in range(3))
        at = place, rows["base_bin"].to_numpy() + 1, rows["bin"].to_numpy() + 1
        n[at], s[at], ss[at] = rows["n"], rows["s"], rows["ss"]
        found = []
        for k in range(len(folds)):
            tn, ts, tss = n.sum(0) - n[k], s.sum(0) - s[k], ss.sum() - ss[k].sum()
            scale = tss - ts.sum() ** 2 / tn.sum() if tn.sum() else 0.0
            found.append(_boost(ts, tn, s[k], n[k], ss[k], rounds if scale > 0 else 0, rate, l2, scale, patience))
        return pd.DataFrame({"feature": [rows["feature"].iloc[0]], "cv_rmse": [float(np.mean([f[0] for f in found]))],
                             "rounds": [float(np.mean([f[1] for f in found]))], "n_zero": [int(rows["zero"].sum())]})

    rep = cells.groupBy("feature").applyInPandas(score, "feature string, cv_rmse double, rounds double, n_zero long")
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("s")
    distinct = rows.select(values).groupBy("s.feature", "s.v").agg(F.count(F.lit(1)).alias("m")).groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))
    return rep.join(distinct, "feature").orderBy("cv_rmse", "feature")
