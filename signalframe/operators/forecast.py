"""Boosted-tree forecasting with Spark ML.

Spark ML grows the trees level by level from per-task statistics, so training
reads the table where it lies.  Scores differ from other boosting libraries in
that columns are drawn per node instead of per tree.  Fitting runs jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalframe import config
from signalframe.operators.prepare import sequence_windows
from signalframe.operators.series import tail_validation
from signalframe.plans.staging import stage

VECTOR = "_features"


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="skip").transform(df)


def learner(target: str, trees: int, depth: int, rate: float, seed: int) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=VECTOR, labelCol=target, predictionCol="predicted", lossType="squared", maxIter=trees,
        maxDepth=depth, stepSize=rate, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed,
    )


def best_length(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Trees up to the smallest error before ``patience`` trees brought nothing better, and whether that many did."""
    best = 0
    for k, error in enumerate(errors):
        if error < errors[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_trees(df: DataFrame, target: str, validation: str | None = None, trees: int = 1000, depth: int = 6,
              rate: float = 0.05, seed: int = config.SEED, patience: int = 50) -> GBTRegressionModel:
    """Squared-error trees on a table with a feature vector.

    ``validation`` names a boolean column.  With it the number of trees is the
    one with the smallest error on those rows, looked for until ``patience``
    trees brought no better one: the model grows in steps that double, and the
    last one is cut to the best length.
    """
    if not validation:
        return learner(target, trees, depth, rate, seed).fit(df)
    fit, held = df.where(~F.col(validation)).drop(validation), df.where(validation).drop(validation)
    if held.isEmpty():
        return learner(target, trees, depth, rate, seed).fit(fit)
    length = min(trees, 2 * patience)
    while True:
        model = learner(target, length, depth, rate, seed).fit(fit)
        best, settled = best_length(model.evaluateEachIteration(held, "squared"), patience)
        if settled or length == trees:
            return model if best == length else first_trees(model, best)
        length = min(trees, 2 * length)


def first_trees(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The model of the first ``trees`` trees of a fitted one, with their weights; nothing is fitted.

    Trees are grown one after the other, each on what the ones before leave, so
    this is the model that a fit of that length gives.
    """
    spark, java = SparkSession.active(), model._java_obj
    gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    kept = gateway.new_array(ml.DecisionTreeRegressionModel, trees)
    weights = gateway.new_array(gateway.jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(java.trees()[:trees], model.treeWeights)):
        kept[i], weights[i] = tree, float(weight)
    cut = GBTRegressionModel(ml.GBTRegressionModel(f"{model.uid}_first_{trees}", kept, weights, model.numFeatures))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def save_model(model: GBTRegressionModel, path: str) -> None:
    """Store a fitted model in place of the one at that path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTRegressionModel:
    return GBTRegressionModel.load(path)


def gbt_forecast(train: DataFrame, features: Sequence[str], target: str, validation: str | None = None,
                 **settings) -> GBTRegressionModel:
    """Trees on named feature columns."""
    return fit_trees(assemble(train, features), target, validation, **settings)


def predict(model: GBTRegressionModel, df: DataFrame, features: Sequence[str], target: str, time: str) -> DataFrame:
    """(time, actual, predicted) for every row with complete features."""
    return model.transform(assemble(df, features)).select(time, F.col(f"`{target}`").alias("actual"), "predicted")


def feature_importance(model: GBTRegressionModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, importance), largest first; one row per model input."""
    rows = [(name, float(v)) for name, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def sequence_vectors(df: DataFrame, time: str, features: Sequence[str], target: str,
                     rows: int = config.SEQUENCE_ROWS, keys: Sequence[str] = (), max_gap: str | None = None) -> DataFrame:
    """One flat vector of the preceding ``rows`` feature rows per row."""
    return sequence_windows(df, time, features, target, rows, keys, max_gap).withColumn(
        VECTOR, array_to_vector(F.flatten("sequence"))).drop("sequence")


def sequence_forecast(train: DataFrame, test: DataFrame, time: str, features: Sequence[str], target: str,
                      rows: int = config.SEQUENCE_ROWS, max_gap: str | None = None, **settings) -> DataFrame:
    """(time, actual, predicted) of the next step from the preceding ``rows`` rows.

    The last fifth of the training sequences decides the number of trees.
    ``max_gap`` leaves out sequences over holes, in training and in the result.
    """
    sequences = stage(sequence_vectors(train, time, features, target, rows, max_gap=max_gap), "sequences")
    held = tail_validation(sequences, time, name="_role").withColumn("_held", F.col("_role") == "validation").drop("_role")
    model = fit_trees(stage(held, "held-sequences"), "target", "_held", **settings)
    return model.transform(sequence_vectors(test, time, features, target, rows, max_gap=max_gap)).select(
        time, F.col("target").alias("actual"), "predicted")
