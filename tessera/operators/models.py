"""Models on ``pyspark.ml`` (M11, M12, M14, M16-M22, M29); boosting of its own is in ``boosting``,
the forests of ``rf_readmission`` (M9) and ``rf_loan`` (M10) in ``forest``.

The fit is distributed by ``pyspark.ml``; the only driver-side state is the fitted models
themselves.
"""

from __future__ import annotations

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import argmax, softmax


def with_features(df: DataFrame, cols=None, array_col: str | None = None,
                  out_col: str = "features") -> DataFrame:
    """Feature vector from numeric columns (VectorAssembler) or from an array column."""
    if array_col:
        return df.withColumn(out_col, array_to_vector(F.col(array_col)))
    return VectorAssembler(inputCols=list(cols), outputCol=out_col, handleInvalid="skip").transform(df)


def random_forest(train: DataFrame, label: str = "label", num_trees: int = 200,
                  max_depth: int = 10, min_leaf: int = 2, weight_col: str | None = None,
                  feature_subset: str = "auto", subsampling: float = 1.0, bootstrap: bool = True,
                  seed: int = 42):
    """M11 (bagging = every feature at each split, sampled rows)."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                featureSubsetStrategy=feature_subset, subsamplingRate=subsampling,
                                bootstrap=bootstrap, seed=seed)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return rf.fit(train)


def decision_tree(train: DataFrame, label: str = "label", max_depth: int = 6, seed: int = 42):
    """M12."""
    return DecisionTreeClassifier(labelCol=label, maxDepth=max_depth, seed=seed).fit(train)


def gradient_boosting(train: DataFrame, label: str = "label", max_iter: int = 100,
                      step: float = 0.1, max_depth: int = 3, seed: int = 42):
    """M14."""
    return GBTClassifier(labelCol=label, maxIter=max_iter, stepSize=step, maxDepth=max_depth,
                         seed=seed).fit(train)


def mlp(train: DataFrame, layers, label: str = "label", max_iter: int = 200, seed: int = 1):
    """Multilayer perceptron (sigmoid hidden layers, softmax output)."""
    return MultilayerPerceptronClassifier(labelCol=label, layers=list(layers), maxIter=max_iter,
                                          seed=seed).fit(train)


def linear_head(train: DataFrame, label: str = "label", max_iter: int = 100, reg: float = 0.0):
    """Linear classifier on frozen features (multinomial logistic regression)."""
    return LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg,
                              family="multinomial").fit(train)


def linear_regression(train: DataFrame, label: str, solver: str = "normal"):
    """M17."""
    return LinearRegression(labelCol=label, solver=solver, regParam=0.0).fit(train)


def tree_regressor(train: DataFrame, label: str, max_depth: int = 10, seed: int = 42):
    """M18."""
    return DecisionTreeRegressor(labelCol=label, maxDepth=max_depth, seed=seed).fit(train)


def importances(model, names) -> DataFrame:
    """Feature importances with names, largest first."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    vals = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, vals)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def score_batch(model, df: DataFrame, id_col: str, vec_col: str, dim: int,
                class_names=None) -> DataFrame:
    """Class and confidence per row (softmax of the raw scores); rows whose input is
    unreadable (missing or of the wrong width) are skipped."""
    ok = df.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) == dim))
    scored = model.transform(with_features(ok, array_col=vec_col))
    prob = softmax(vector_to_array("rawPrediction"))
    out = scored.select(id_col, argmax(prob).alias("pred_index"), F.array_max(prob).alias("conf"))
    if class_names:
        names = F.array(*[F.lit(c) for c in class_names])
        out = out.withColumn("pred", F.element_at(names, F.col("pred_index") + 1))
    return out


def objective_history(model) -> list[float]:
    """Loss per iteration of a model with a summary."""
    return [float(v) for v in model.summary.objectiveHistory]
