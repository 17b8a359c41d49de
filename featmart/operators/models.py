"""Model fitting over Spark MLlib (MDL-*, CLU-1, DEC-1). Results are model / seed dependent, so the
registered queries built on these are checked by row counts and invariants, not by an SQL oracle.

D4: MLlib trees reject NaN/NULL, so ``assemble`` imputes NULL with 0 and adds ``<c>_isnull``
indicators before building the vector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featmart.session import materialize

ESTIMATORS = {
    "gbt_classifier": GBTClassifier,          # MDL-1
    "gbt_regressor": GBTRegressor,            # MDL-2
    "rf_classifier": RandomForestClassifier,  # MDL-3
    "rf_regressor": RandomForestRegressor,    # MDL-3
    "tree_regressor": DecisionTreeRegressor,  # MDL-4
    "linear_svc": LinearSVC,                  # MDL-5
    "mlp": MultilayerPerceptronClassifier,    # MDL-6
}


def assemble(df: DataFrame, features: Sequence[str], out: str = "features",
             null_indicators: bool = True) -> DataFrame:
    """MDL-14: impute NULL with 0 (+ indicator columns) and assemble a vector column."""
    cols = []
    prep = df
    for f in features:
        prep = prep.withColumn(f"__f_{f}", F.coalesce(F.col(f).cast("double"), F.lit(0.0)))
        cols.append(f"__f_{f}")
        if null_indicators:
            prep = prep.withColumn(f"__n_{f}", F.col(f).isNull().cast("double"))
            cols.append(f"__n_{f}")
    va = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error")
    res = va.transform(prep)
    return res.drop(*cols)


def fit(df: DataFrame, kind: str, label: str = "label", features: str = "features", **params):
    """Fit one estimator from ``ESTIMATORS``."""
    est = ESTIMATORS[kind](labelCol=label, featuresCol=features, **params)
    return est.fit(df)


def positive_probability(pred: DataFrame, col: str = "probability", out: str = "p1") -> DataFrame:
    """MDL-15: class-1 probability as a double column."""
    return pred.withColumn(out, vector_to_array(F.col(col))[1])


def fit_early_stopping(df: DataFrame, kind: str, valid_flag: str, label: str = "label",
                       features: str = "features", tol: float = 0.01, **params):
    """MDL-9: boosted trees with a validation indicator column and a tolerance."""
    est = ESTIMATORS[kind](labelCol=label, featuresCol=features, validationIndicatorCol=valid_flag,
                           validationTol=tol, **params)
    return est.fit(df)


def grid_search(df: DataFrame, kind: str, grid: dict, evaluator, folds: int = 4, label: str = "label",
                features: str = "features", parallelism: int = 4, seed: int = 0):
    """MDL-8: k-fold grid search (``CrossValidator``)."""
    est = ESTIMATORS[kind](labelCol=label, featuresCol=features)
    pg = ParamGridBuilder()
    for name, values in grid.items():
        pg = pg.addGrid(getattr(est, name), values)
    cv = CrossValidator(estimator=est, estimatorParamMaps=pg.build(), evaluator=evaluator,
                        numFolds=folds, parallelism=parallelism, seed=seed)
    return cv.fit(df)


def oof_predictions(df: DataFrame, kind: str, fold: str, k: int, id_col: str, label: str = "label",
                    features: str = "features", test: DataFrame | None = None, **params):
    """MDL-10: k fits over one checkpointed, fold-tagged frame; every training row predicted exactly
    once by the model that did not see it; test predictions averaged over the k models.

    Returns ``(oof, test_avg)`` DataFrames of ``(id, prediction)``.
    """
    base = materialize(df.select(id_col, fold, label, features))
    oof_parts, test_parts = [], []
    for f in range(k):
        model = fit(base.where(F.col(fold) != f), kind, label, features, **params)
        oof_parts.append(model.transform(base.where(F.col(fold) == f)).select(id_col, "prediction"))
        if test is not None:
            test_parts.append(model.transform(test).select(id_col, "prediction"))
    oof = oof_parts[0]
    for p in oof_parts[1:]:
        oof = oof.unionByName(p)
    test_avg = None
    if test_parts:
        t = test_parts[0]
        for p in test_parts[1:]:
            t = t.unionByName(p)
        test_avg = t.groupBy(id_col).agg(F.avg("prediction").alias("prediction"))
    return oof, test_avg


def feature_importance(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """MDL-13: ``(feature, importance)`` pairs, largest first."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda t: (-t[1], t[0]))


def cluster_feature(train: DataFrame, apply_to: DataFrame, features: Sequence[str], k: int = 8,
                    seed: int = 1, out: str = "cluster") -> DataFrame:
    """CLU-1: k-means on NULL->0 features fitted on ``train``, cluster id added to ``apply_to``."""
    def prep(d):
        d2 = d
        for f in features:
            d2 = d2.withColumn(f"__k_{f}", F.coalesce(F.col(f).cast("double"), F.lit(0.0)))
        return VectorAssembler(inputCols=[f"__k_{f}" for f in features], outputCol="__kv").transform(d2)
    model = KMeans(k=k, seed=seed, featuresCol="__kv", predictionCol=out).fit(prep(train))
    res = model.transform(prep(apply_to))
    return res.drop("__kv", *[f"__k_{f}" for f in features])


def whitened_pca(df: DataFrame, features: str, k: int, out: str = "pca") -> DataFrame:
    """DEC-1: centred PCA with ``k`` components, each scaled to unit variance (``whiten=True``)."""
    centred = StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol="__c").fit(df).transform(df)
    pca = PCA(k=k, inputCol="__c", outputCol="__p").fit(centred)
    proj = pca.transform(centred)
    scaled = StandardScaler(withMean=False, withStd=True, inputCol="__p", outputCol=out).fit(proj).transform(proj)
    return scaled.drop("__c", "__p")


__all__ = ["ESTIMATORS", "assemble", "fit", "positive_probability", "fit_early_stopping", "grid_search",
           "oof_predictions", "feature_importance", "cluster_feature", "whitened_pca", "Pipeline"]
