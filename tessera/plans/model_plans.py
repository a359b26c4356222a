"""Keys for the models.  Results depend on floating-point fits, so these are checked by
row count here and by pytest (accuracy above the majority class, importances summing to 1,
AdaBoost not worse than one stump).  The linear slope key has an SQL twin.

Stand-in frames: the embedding table (64 features) with the binary target ``label < 5`` or
the ten labels; daily event series for the forecasting keys; line items for regression.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import round_half_up
from ..operators import boosting as B
from ..operators import evaluate as E
from ..operators import forest as FO
from ..operators import models as MD
from ..operators import prep as P
from ..operators import series as S
from ..session import scratch_path
from ..sources import files as IO
from ..sources.retail_model import RetailModel
from ..sources.tables import Tables
from .registry import r2_sql, register, rounded

G = "models"
DIM = 64
ADABOOST_ROUNDS = 200


def _binary_split(spark, d, weights: bool = False):
    emb = Tables(spark, d).embeddings.withColumn("label", (F.col("label") < 5).cast("double"))
    s = P.stratified_split(emb, "label", "vec_id", 0.7, seed=42)
    if weights:
        s = P.with_class_weights(s, "label")
    s = MD.with_features(s, array_col="embedding")
    s = s.checkpoint(eager=True)  # estimators pass over it many times: materialise once
    return s.filter("is_train"), s.filter(~F.col("is_train"))


def _report(model, test, label="label"):
    pred = model.transform(test).select(F.col(label).cast("int").alias("y"),
                                        F.col("prediction").cast("int").alias("p"))
    return rounded(E.classification_report(pred, "y", "p"), "precision", "recall", "f1")


@register("rf_readmission", G)
def q_rf_readmission(spark, d):
    """Random forest, 200 trees, depth 10, leaf 2, classes balanced per tree; test-split report."""
    train, test = _binary_split(spark, d)
    m = FO.balanced_forest(train, "embedding", "label", "vec_id", DIM, trees=200, max_depth=10, min_leaf=2)
    pred = FO.predict(m, test.select("label", "embedding"), "embedding")
    return rounded(E.classification_report(pred.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("p")),
                                           "y", "p"), "precision", "recall", "f1")


@register("rf_loan", G)
def q_rf_loan(spark, d):
    """Random forest, 800 trees, sqrt features, depth 30, leaf 2, class weights; test-split report."""
    train, test = _binary_split(spark, d, weights=True)
    pred = FO.forest_shares(train, test.select("label", "embedding"), "embedding", "label", "vec_id", DIM, trees=800,
                            max_depth=30, min_leaf=2, weight="weight")
    return rounded(E.classification_report(pred.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("p")),
                                           "y", "p"), "precision", "recall", "f1")


@register("bagging", G)
def q_bagging(spark, d):
    """Bagged trees: 50 trees of depth 6, leaf 3, every feature, 90% bootstrap samples."""
    train, test = _binary_split(spark, d)
    m = MD.random_forest(train, num_trees=50, max_depth=6, min_leaf=3, feature_subset="all",
                         subsampling=0.9, bootstrap=True)
    return _report(m, test)


@register("decision_tree", G)
def q_decision_tree(spark, d):
    train, test = _binary_split(spark, d)
    return _report(MD.decision_tree(train, max_depth=6), test)


def _scored(model, test):
    """Class report of a model of ``boosting`` on the test rows."""
    pred = B.predict(model, test.select("label", "embedding"), "embedding")
    return rounded(E.classification_report(pred.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("p")),
                                           "y", "p"), "precision", "recall", "f1")


@register("adaboost", G)
def q_adaboost(spark, d):
    """AdaBoost, 200 depth-1 trees, learning rate 0.8; weighted error per round."""
    train, _ = _binary_split(spark, d)
    model = B.adaboost(train, "embedding", "label", DIM, rounds=ADABOOST_ROUNDS, learning_rate=0.8)
    return spark.createDataFrame(model.history, "round int, weighted_error double, alpha double")


@register("adaboost_report", G)
def q_adaboost_report(spark, d):
    train, test = _binary_split(spark, d)
    return _scored(B.adaboost(train, "embedding", "label", DIM, rounds=ADABOOST_ROUNDS, learning_rate=0.8), test)


@register("gbt", G)
def q_gbt(spark, d):
    """Gradient boosting: 100 trees, rate 0.1, depth 3."""
    train, test = _binary_split(spark, d)
    return _report(MD.gradient_boosting(train, max_iter=100, step=0.1, max_depth=3), test)


@register("gbt_hist", G)
def q_gbt_hist(spark, d):
    """Second-order histogram boosting: 100 trees, rate 0.6, depth 6."""
    train, test = _binary_split(spark, d)
    return _scored(B.boost(train, "embedding", "label", DIM, rounds=100, rate=0.6, max_depth=6), test)


@register("rf_importance", G)
def q_rf_importance(spark, d):
    train, _ = _binary_split(spark, d, weights=True)
    m = MD.random_forest(train, num_trees=200, max_depth=10, min_leaf=2, weight_col="weight")
    return MD.importances(m, [f"f{i}" for i in range(DIM)])


_LR_FEATURES = ("l_quantity", "l_discount", "l_tax")


@register("linreg", G)
def q_linreg(spark, d):
    """Linear regression of the line price on quantity, discount and tax; MAE and R2 on a
    20% random test part, plus the coefficients."""
    li = Tables(spark, d).lineitem
    s = MD.with_features(P.random_split(li, "l_orderkey", 0.8, seed=42), cols=_LR_FEATURES)
    train, test = s.filter("is_train"), s.filter(~F.col("is_train"))
    m = MD.linear_regression(train, "l_extendedprice")
    metrics = rounded(E.regression_metrics(m.transform(test), "l_extendedprice", "prediction"), "mae", "mse", "r2")
    coef = ", ".join(f"{c}:{v:.6g}" for c, v in zip(_LR_FEATURES, m.coefficients.toArray()))
    return metrics.withColumn("coefficients", F.lit(coef)).withColumn("intercept", F.lit(float(m.intercept)))


@register("linreg_slope", G, f"""
SELECT {r2_sql('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
       {r2_sql('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept
FROM lineitem""")
def q_linreg_slope(spark, d):
    """Single-feature least squares by LinearRegression, equal to SQL's regr_slope."""
    li = MD.with_features(Tables(spark, d).lineitem, cols=["l_quantity"])
    m = MD.linear_regression(li, "l_extendedprice")
    return spark.range(1).select(round_half_up(F.lit(float(m.coefficients[0])), 4).alias("slope"),
                                 round_half_up(F.lit(float(m.intercept)), 4).alias("intercept"))


@register("tree_regressor", G)
def q_tree_regressor(spark, d):
    li = Tables(spark, d).lineitem
    s = MD.with_features(P.random_split(li, "l_orderkey", 0.8, seed=42), cols=_LR_FEATURES)
    m = MD.tree_regressor(s.filter("is_train"), "l_extendedprice", max_depth=10)
    return rounded(E.regression_metrics(m.transform(s.filter(~F.col("is_train"))), "l_extendedprice", "prediction"), "mae", "mse", "r2")


@register("mlp_loan", G)
def q_mlp_loan(spark, d):
    """2-8-4-2 perceptron on two z-scored inputs (population std, train statistics)."""
    emb = Tables(spark, d).embeddings.select(
        "vec_id", (F.col("label") < 5).cast("double").alias("label"),
        F.col("embedding")[0].cast("double").alias("x1"), F.col("embedding")[1].cast("double").alias("x2"))
    s = P.stratified_split(emb, "label", "vec_id", 0.7, seed=42).checkpoint(eager=True)
    tr = s.filter("is_train")
    stats = tr.agg(*[F.avg(c).alias(f"m_{c}") for c in ("x1", "x2")],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in ("x1", "x2")])
    z = s.crossJoin(F.broadcast(stats)).select(  # one-row statistics
        "label", "is_train", *[((F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")).alias(c) for c in ("x1", "x2")])
    z = MD.with_features(z, cols=["x1", "x2"])
    m = MD.mlp(z.filter("is_train"), [2, 8, 4, 2], max_iter=200)
    return _report(m, z.filter(~F.col("is_train")))


def _multi_split(spark, d):
    emb = Tables(spark, d).embeddings.withColumn("label", F.col("label").cast("double"))
    s = P.per_class_split(emb, "label", "vec_id", 0.8, seed=42).checkpoint(eager=True)
    return s.filter("is_train"), s.filter(~F.col("is_train"))


@register("linear_head", G)
def q_linear_head(spark, d):
    """Linear classifier on frozen 64-wide embeddings, ten classes; test-split report."""
    train, test = _multi_split(spark, d)
    m = MD.linear_head(MD.with_features(train, array_col="embedding"))
    return _report(m, MD.with_features(test, array_col="embedding"))


@register("score_batch", G)
def q_score_batch(spark, d):
    """Class and confidence for every scorable vector (wrong-width rows are skipped)."""
    train, _ = _multi_split(spark, d)
    m = MD.linear_head(MD.with_features(train, array_col="embedding"))
    emb = Tables(spark, d).embeddings
    return MD.score_batch(m, emb, "vec_id", "embedding", DIM,
                          class_names=[f"class_{i}" for i in range(10)])


@register("training_history", G)
def q_training_history(spark, d):
    """Loss and accuracy on the fitting and the validation part after each of 30 boosting
    epochs, stored as JSON and CSV and read back."""
    train, test = _binary_split(spark, d)
    model = B.boost(train, "embedding", "label", DIM, rounds=30, rate=0.3, max_depth=3, validation=test)
    j, _c = IO.save_history(spark.createDataFrame(model.history, IO.HISTORY_SCHEMA), scratch_path(spark, "history"))
    return IO.read_json(spark, j, IO.HISTORY_SCHEMA)


@register("training_stop", G)
def q_training_stop(spark, d):
    """The validation history of the same model with the patience rule: best accuracy so far,
    epochs since, and the epoch at which a patience of 5 ends it."""
    history = q_training_history(spark, d).withColumn("series", F.lit(1))
    return S.early_stop(history, ["series"], "epoch", "val_acc", patience=5).select(
        "epoch", "val_acc", "best_so_far", "improved", "no_improve", "stop_here", "after_stop")


@register("ar_forecast", G)
def q_ar_forecast(spark, d):
    """Autoregression on 5-value windows of each daily series (fit on the first 80% of the
    windows) next to the two naive forecasts of the last value."""
    series = RetailModel(spark, d).series
    win = S.sliding_windows(series, ["series_id"], "t", "value", 5)
    win = S.ordered_split(win, ["series_id"], "t", 0.8)
    win = MD.with_features(win, array_col="features", out_col="fvec").checkpoint(eager=True)
    lr = MD.LinearRegression(featuresCol="fvec", labelCol="target", regParam=0.0).fit(win.filter("is_train"))
    last = S.last_window(series, ["series_id"], "t", "value", 5)
    pred = lr.transform(MD.with_features(last, array_col="last_values", out_col="fvec"))
    naive = S.naive_forecast(series, ["series_id"], "t", "value")
    val = lr.transform(win.filter(~F.col("is_train")))
    val_mae = val.groupBy("series_id").agg(F.avg(F.abs(F.col("target") - F.col("prediction"))).alias("val_mae_ar"))
    return (pred.select("series_id", F.col("prediction").alias("forecast_ar"))
            .join(naive.select("series_id", "forecast_repeat_last", "forecast_add_last_diff"), "series_id")
            .join(val_mae, "series_id", "left"))
