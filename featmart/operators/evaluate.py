"""Evaluation metrics and reports (EVL-*, MDL-7/12, SRT-6).

All metrics are exact aggregates. Rank-based metrics (ROC points, AUC) group by distinct score first
and take running sums with ``prefix_sums`` (range-partitioned, no single-task window), so they hold
for any number of rows and distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.operators.bin_models import boosted_feature_report, drift_report  # noqa: F401
from featmart.operators.ordered import prefix_sums


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-1 (= micro F1 for single-label, EVL-7)."""
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-2: ``(actual, predicted, count)`` for the non-empty cells."""
    return df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def _score_counts(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*group, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """EVL-3: one point per distinct score ``s`` (threshold ``score >= s``): ``(score, tpr, fpr)``."""
    sc = _score_counts(df, label, score).withColumn("__neg_score", -F.col("score"))
    cum = prefix_sums(sc, ["__neg_score"], ["pos", "neg"])  # descending score
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = tot["P"] or 0, tot["N"] or 0
    return cum.select("score", F.try_divide(F.col("cum_pos"), F.lit(P)).alias("tpr"),
                      F.try_divide(F.col("cum_neg"), F.lit(N)).alias("fpr"))


def auc(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """EVL-4: tie-corrected ROC AUC ``sum_s pos(s) * (neg(< s) + neg(s)/2) / (P * N)`` per group.

    NULL when a group has a single class.
    """
    sc = _score_counts(df, label, score, group)
    cum = prefix_sums(sc, ["score"], ["neg"], group_cols=list(group), inclusive=False)
    contrib = F.col("pos") * (F.col("cum_neg") + F.col("neg") / 2.0)
    return (cum.groupBy(*group)
            .agg(F.sum(contrib).alias("__u"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
            .select(*group, F.try_divide(F.col("__u"), F.col("__p") * F.col("__n")).cast("double").alias("auc")))


def rmse(df: DataFrame, y: str, p: str, log_space: bool = False) -> DataFrame:
    """EVL-5: ``sqrt(mean((y-p)^2))``; ``log_space`` compares ``log1p`` of both."""
    return df.agg(rmse_expr(y, p, log_space).alias("rmse"))


def rmse_expr(y: str, p: str, log_space: bool = False) -> Column:
    """The RMSE as an aggregate expression, to stand beside others of the same pass."""
    a, b = F.col(y), F.col(p)
    if log_space:
        a, b = F.log1p(a), F.log1p(b)
    return F.sqrt(F.avg(F.pow(a - b, 2)))


def r2(df: DataFrame, y: str, p: str) -> DataFrame:
    """EVL-6: ``1 - SS_res / SS_tot``; ``SS_tot`` is the count times the population variance (one pass)."""
    return df.agg((F.lit(1.0) - F.try_divide(F.sum(F.pow(F.col(y) - F.col(p), 2)),
                                             F.count(y) * F.var_pop(y))).alias("r2"))


def onehot_exact_match(df: DataFrame, y_vec: str, p_vec: str) -> DataFrame:
    """EVL-7: accuracy on one-hot rows = share of rows whose vectors are equal."""
    return df.agg(F.avg((F.col(y_vec) == F.col(p_vec)).cast("double")).alias("accuracy"))


def unpivot_features(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """``(ids..., feature, value)`` with values as double -- the shape of every per-feature job."""
    return df.select(*ids, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
        .alias("s")).select(*ids, "s.feature", "s.value")


def single_feature_report(df: DataFrame, y: str, base: str, fold: str, features: Sequence[str]) -> DataFrame:
    """EVL-9 re-aimed: per feature, the cross-validated RMSE of the least-squares plane ``y ~ base + feature``
    fitted on the other folds and scored on each fold (mean of the fold values), plus zero and distinct
    counts. Sorted by RMSE, best first.

    One aggregate gives centred moments for each ``(feature, fold)``; the folds are then put together from
    differences of their means, so large values do not cancel. No model per feature, no fold loop.
    """
    from pyspark.sql import Window
    long = unpivot_features(df, [y, base, fold], features).where(
        F.col("value").isNotNull() & F.col(y).isNotNull() & F.col(base).isNotNull())
    cols = {"b": F.col(base).cast("double"), "x": F.col("value"), "y": F.col(y).cast("double")}
    pairs = ["bb", "bx", "by", "xx", "xy", "yy"]
    n = F.count(F.lit(1))
    per = long.groupBy("feature", F.col(fold).alias("f")).agg(
        n.alias("n"), *[F.avg(c).alias(f"m{k}") for k, c in cols.items()],
        *[(F.covar_pop(cols[p[0]], cols[p[1]]) * n).alias(f"s{p}") for p in pairs])
    w = Window.partitionBy("feature")  # as many rows as folds
    centre = {k: F.sum(F.col(f"m{k}") * F.col("n")).over(w) / F.sum("n").over(w) for k in cols}
    per = per.select("feature", "f", "n", *[(F.col(f"m{k}") - c).alias(f"m{k}") for k, c in centre.items()], *[f"s{p}" for p in pairs])
    other = per.select("feature", *[F.col(c).alias(f"o_{c}") for c in per.columns if c != "feature"])
    rest = per.select("feature", "f").join(other, "feature").where("f <> o_f").groupBy("feature", "f").agg(
        F.sum("o_n").alias("tn"), *[(F.sum(F.col("o_n") * F.col(f"o_m{k}")) / F.sum("o_n")).alias(f"t{k}") for k in cols],
        *[F.sum(F.col(f"o_s{p}") + F.col("o_n") * F.col(f"o_m{p[0]}") * F.col(f"o_m{p[1]}")).alias(f"q{p}") for p in pairs])
    rest = rest.select("feature", "f", *[f"t{k}" for k in cols],
                       *[(F.col(f"q{p}") - F.col("tn") * F.col(f"t{p[0]}") * F.col(f"t{p[1]}")).alias(f"q{p}") for p in pairs])
    det = F.col("qbb") * F.col("qxx") - F.col("qbx") * F.col("qbx")
    full = det > 1e-9 * F.col("qbb") * F.col("qxx")
    only = F.coalesce(F.try_divide(F.col("qby"), F.col("qbb")), F.lit(0.0))
    rest = rest.withColumn("kb", F.when(full, (F.col("qby") * F.col("qxx") - F.col("qxy") * F.col("qbx")) / det).otherwise(only)) \
               .withColumn("kx", F.when(full, (F.col("qxy") * F.col("qbb") - F.col("qby") * F.col("qbx")) / det).otherwise(0.0))
    j = per.join(rest, ["feature", "f"])
    off = (F.col("my") - F.col("ty")) - F.col("kb") * (F.col("mb") - F.col("tb")) - F.col("kx") * (F.col("mx") - F.col("tx"))
    sse = (F.col("syy") + F.col("kb") ** 2 * F.col("sbb") + F.col("kx") ** 2 * F.col("sxx") - 2 * F.col("kb") * F.col("sby")
           - 2 * F.col("kx") * F.col("sxy") + 2 * F.col("kb") * F.col("kx") * F.col("sbx") + F.col("n") * off ** 2)
    score = j.groupBy("feature").agg(F.avg(F.sqrt(F.greatest(sse, F.lit(0.0)) / F.col("n"))).alias("cv_rmse"))
    counts = (unpivot_features(df, [], features).groupBy("feature")
              .agg(F.count_if(F.col("value") == 0).alias("n_zero"),
                   (F.count_distinct("value") + F.max(F.col("value").isNull().cast("int"))).alias("n_distinct")))
    return score.join(counts, "feature").orderBy("cv_rmse", "feature")


def good_features(report: DataFrame, limit: float, score: str = "cv_rmse") -> list[str]:
    """FLT-6: names of the features whose score is at most ``limit``, best first (one name per feature)."""
    return [r["feature"] for r in report.where(F.col(score) <= limit).orderBy(score, "feature").select("feature").collect()]


def novelty_score(df: DataFrame, normal: DataFrame, features: Sequence[str], quantile: float = 0.9) -> DataFrame:
    """MDL-7 re-aimed: squared z-score distance from the normal class's mean/std; rows above the
    normal class's ``quantile`` of that distance are flagged (fraction nu = 1 - quantile)."""
    from featmart.operators.ordered import exact_quantiles
    st = normal.agg(*[F.avg(f).alias(f"m_{f}") for f in features],
                    *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    dist = None
    for f in features:
        s = st[f"s_{f}"] or 1.0
        z = F.pow((F.col(f) - F.lit(st[f"m_{f}"])) / F.lit(s), 2)
        dist = z if dist is None else dist + z
    ref = normal.select(dist.alias("d"))
    thr = exact_quantiles(ref, "d", [quantile])[0]
    return df.withColumn("novelty", dist).withColumn("flagged", (F.col("novelty") > F.lit(thr)).cast("int"))


def blend(cols: Sequence[str], weights: Sequence[float]) -> Column:
    """SCL-6 / MDL-12: weighted sum of score columns (join the score tables on id first)."""
    out = None
    for c, w in zip(cols, weights):
        term = F.col(c) * F.lit(w)
        out = term if out is None else out + term
    return out


def fold_report(df: DataFrame, fold: str, y: str, p: str) -> DataFrame:
    """EVL-10: per-fold RMSE plus mean and std across folds, as ``(fold, metric, value)`` rows."""
    per = df.groupBy(fold).agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2))).alias("value"))
    summ = per.agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    rows = per.select(F.col(fold).cast("string").alias("fold"), F.lit("rmse").alias("metric"), "value")
    return rows.unionByName(summ.select(F.lit("all").alias("fold"), F.lit("rmse_mean").alias("metric"),
                                        F.col("mean").alias("value"))) \
               .unionByName(summ.select(F.lit("all").alias("fold"), F.lit("rmse_std").alias("metric"),
                                        F.col("std").alias("value")))
