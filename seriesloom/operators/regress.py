"""Linear and boosted regressors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Penalties tried by the alpha sweep.
ALPHAS = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
MAX_ITER = 1000
TOLERANCE = 1e-9


def fit_ols(train: DataFrame, features: str = "features", label: str = "label", prediction: str = "prediction") -> LinearRegressionModel:
    """Least squares from one pass over the Gram matrix (up to 4,096 features)."""
    return LinearRegression(
        featuresCol=features, labelCol=label, predictionCol=prediction, regParam=0.0, solver="normal", standardization=True
    ).fit(train)


def fit_ols_per_target(train: DataFrame, targets: Sequence[str], features: str = "features") -> dict[str, LinearRegressionModel]:
    """One least-squares model per target column; its prediction column is ``predicted_<target>``."""
    return {t: fit_ols(train, features, t, f"predicted_{t}") for t in targets}


def predict_targets(df: DataFrame, models: dict[str, LinearRegressionModel]) -> DataFrame:
    """Adds the prediction of every target."""
    for model in models.values():
        df = model.transform(df)
    return df


def fit_lasso(train: DataFrame, alpha: float = 1.0, features: str = "features", label: str = "label") -> LinearRegressionModel:
    """Minimises ``|y - Xw|^2 / (2n) + alpha |w|_1``."""
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=MAX_ITER, tol=TOLERANCE
    ).fit(train)


def fit_ridge(train: DataFrame, alpha: float = 1.0, features: str = "features", label: str = "label") -> LinearRegressionModel:
    """Minimises ``|y - Xw|^2 + alpha |w|^2``.

    The solver averages the loss over the rows and works on the label in units of its standard
    deviation, so its penalty is ``alpha / n * stddev_pop(label)``.
    """
    row = train.agg(F.count("*").alias("n"), F.stddev_pop(label).alias("s")).first()
    penalty = alpha / row["n"] * row["s"]
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal"
    ).fit(train)


def coefficient_table(model: LinearRegressionModel, names: Sequence[str], spark) -> DataFrame:
    """``(term, coefficient)`` with the intercept under ``intercept``."""
    rows = [("intercept", float(model.intercept))] + [(n, float(c)) for n, c in zip(names, model.coefficients)]
    return spark.createDataFrame(rows, "term string, coefficient double")


def fit_boosted_mae(
    train: DataFrame,
    valid: DataFrame,
    features: str = "features",
    label: str = "label",
    max_iter: int = 50,
    patience: int = 10,
    depth: int = 5,
    step: float = 0.1,
    seed: int = 346672,
) -> tuple[GBTRegressionModel, DataFrame]:
    """Boosted trees on absolute error with early stopping by ``patience`` rounds.

    The losses of every round come from one boosting run. Training would have stopped at the first
    round that is ``patience`` rounds past the best one; the model is the run's trees up to the best
    round. The history table has both losses up to the stop.
    """
    spark = train.sparkSession
    model = GBTRegressor(
        featuresCol=features, labelCol=label, lossType="absolute", maxIter=max_iter, maxDepth=depth, stepSize=step, seed=seed
    ).fit(train)
    valid_loss = list(model.evaluateEachIteration(valid, "absolute"))
    train_loss = list(model.evaluateEachIteration(train, "absolute"))
    best = stop = 0
    for i, loss in enumerate(valid_loss):
        stop = i
        if loss < valid_loss[best]:
            best = i
        elif i - best >= patience:
            break
    rows = [(i + 1, float(train_loss[i]), float(valid_loss[i]), i == best) for i in range(stop + 1)]
    history = spark.createDataFrame(rows, "round int, train_loss double, valid_loss double, is_best boolean")
    return first_trees(model, best + 1), history


def first_trees(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model after its first ``rounds`` rounds; boosting only ever adds trees."""
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    kinds = jvm.org.apache.spark.ml.regression
    trees, weights = gateway.new_array(kinds.DecisionTreeRegressionModel, rounds), gateway.new_array(jvm.double, rounds)
    grown = model._java_obj.trees()
    for i in range(rounds):
        trees[i], weights[i] = grown[i], float(model.treeWeights[i])
    shorter = kinds.GBTRegressionModel(f"{model.uid}_{rounds}", trees, weights)
    shorter.setFeaturesCol(model.getFeaturesCol())
    shorter.setPredictionCol(model.getPredictionCol())
    return GBTRegressionModel(shorter)
