"""Classifiers, decision margins and the tree as a table."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import combinations

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.prepare import assemble
from seriesloom.session import scratch_path

MAX_TREE_DEPTH = 30
SVC_ITERATIONS = 100


@dataclass(frozen=True)
class LinearWeights:
    """A linear decision function kept outside a model."""

    coefficients: Sequence[float]
    intercept: float


def fit_linear_svc(
    train: DataFrame, c: float = 1.0, features: str = "features", label: str = "label", n: int | None = None, max_iter: int = SVC_ITERATIONS
) -> LinearSVCModel:
    """Linear support vector classifier with penalty ``c`` on the summed hinge loss."""
    rows = train.count() if n is None else n
    svc = LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (c * rows), standardization=False, maxIter=max_iter, tol=1e-6)
    return svc.fit(train)


def margin_column(model: LinearSVCModel | LinearWeights, columns: Sequence[str | Column]) -> Column:
    """Signed margin from plain columns; no vector is built."""
    total = F.lit(float(model.intercept))
    for weight, column in zip(model.coefficients, columns):
        total = total + F.lit(float(weight)) * (F.col(column) if isinstance(column, str) else column)
    return total


def fit_one_vs_one(
    train: DataFrame, classes: Sequence[int] | None = None, c: float = 1.0, features: str = "features", label: str = "label",
    max_iter: int = SVC_ITERATIONS, parallelism: int = 4,
) -> dict[tuple[int, int], LinearSVCModel]:
    """A linear classifier for every pair of classes: ``{(low, high): model}``.

    The classes are those of ``train`` unless given. Class sizes come from one aggregate, and up to
    ``parallelism`` pairs are fitted at a time; pass a stored table, each pair reads its two classes.
    """
    sizes = {int(r[label]): r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    pairs = list(combinations(sorted(sizes if classes is None else classes), 2))

    def fit(pair: tuple[int, int]) -> LinearSVCModel:
        low, high = pair
        rows = train.where(F.col(label).isin(low, high)).withColumn("_pair", (F.col(label) == high).cast("double"))
        return fit_linear_svc(rows, c, features, "_pair", sizes[low] + sizes[high], max_iter)

    with ThreadPoolExecutor(parallelism) as pool:
        return dict(zip(pairs, pool.map(inheritable_thread_target(fit), pairs)))


def predict_one_vs_one(df: DataFrame, models, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """Class with the most pairwise votes, ties to the lower class; all margins in one projection."""
    x = F.col("_x")
    classes = sorted({c for pair in models for c in pair})
    size = len(next(iter(models.values())).coefficients)
    votes = {c: F.lit(0) for c in classes}
    for (low, high), model in models.items():
        wins = (margin_column(model, [x[i] for i in range(size)]) > 0).cast("int")
        votes[high] = votes[high] + wins
        votes[low] = votes[low] + (1 - wins)
    best = F.array_max(F.array(*[F.struct(votes[c].alias("v"), F.lit(-c).alias("c")) for c in classes]))
    scored = df.withColumn("_x", vector_to_array(features)).withColumn(prediction, (-best["c"]).cast("double"))
    return scored.drop("_x")


def fit_one_vs_rest(
    train: DataFrame, c: float = 1.0, features: str = "features", label: str = "label", parallelism: int = 4, max_iter: int = SVC_ITERATIONS
) -> OneVsRestModel:
    """The cheaper multi-class form: one classifier per class."""
    svc = LinearSVC(regParam=1.0 / (c * train.count()), standardization=False, maxIter=max_iter)
    return OneVsRest(classifier=svc, featuresCol=features, labelCol=label, parallelism=parallelism).fit(train)


def fit_tree(
    train: DataFrame,
    max_depth: int | None = None,
    min_leaf: int = 1,
    max_bins: int = 256,
    features: str = "features",
    label: str = "label",
    seed: int = 346672,
) -> DecisionTreeClassificationModel:
    """Gini tree; without a depth it grows to the engine's limit of 30 levels."""
    return DecisionTreeClassifier(
        featuresCol=features,
        labelCol=label,
        impurity="gini",
        maxDepth=MAX_TREE_DEPTH if max_depth is None else max_depth,
        minInstancesPerNode=min_leaf,
        maxBins=max_bins,
        maxMemoryInMB=512,
        seed=seed,
    ).fit(train)


def tree_nodes(model: DecisionTreeClassificationModel, spark, features: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """One row per node: rule, gini, rows, rows per class, majority class, children."""
    path = scratch_path(spark, "tree")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData") if "nodeData" in data.columns else F.struct(*[F.col(c) for c in data.columns])
    data = data.select(node.alias("d")).select("d.*")
    leaf = F.col("leftChild") < 0
    feature = F.get(F.array(*[F.lit(f) for f in features]), F.col("split.featureIndex"))
    threshold = F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1))
    return data.select(
        F.col("id").alias("node"),
        F.when(~leaf, feature).alias("feature"),
        F.when(~leaf, threshold).alias("threshold"),
        F.col("impurity").alias("gini"),
        F.col("rawCount").cast("long").alias("samples"),
        F.transform("impurityStats", lambda v: v.cast("long")).alias("value"),
        F.get(F.array(*[F.lit(c) for c in classes]), F.col("prediction").cast("int")).alias("class"),
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
    )


def fit_softmax(train: DataFrame, c: float = 1.0, max_iter: int = 500, features: str = "features", label: str = "label") -> LogisticRegressionModel:
    """Multinomial logistic regression with penalty ``1 / c`` on the summed loss."""
    return LogisticRegression(
        featuresCol=features, labelCol=label, family="multinomial", regParam=1.0 / (c * train.count()), maxIter=max_iter, standardization=False
    ).fit(train)


def objective_history(model: LogisticRegressionModel, spark) -> DataFrame:
    """Training loss per iteration."""
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "round int, train_loss double")


# Hidden layer sizes of the five dense classifiers.
DENSE_LAYOUTS = ((300,), (120, 60, 60, 60), (256, 256, 128, 64, 64), (512,), (60, 30, 30, 30, 30, 30))


def fit_dense(
    train: DataFrame, inputs: int, classes: int, hidden: Sequence[int], max_iter: int = 100, features: str = "features", label: str = "label", seed: int = 346672
) -> MultilayerPerceptronClassificationModel:
    """Dense network with softmax output and sigmoid hidden units; scale the inputs first."""
    return MultilayerPerceptronClassifier(
        layers=[inputs, *hidden, classes], featuresCol=features, labelCol=label, maxIter=max_iter, seed=seed
    ).fit(train)


def margin_grid(spark, limits: tuple[tuple[float, float], tuple[float, float]], model: LinearSVCModel | LinearWeights, names: Sequence[str], steps: int = 100) -> DataFrame:
    """Signed margin on a ``steps`` x ``steps`` grid over two features; the grid is made by Spark."""

    def axis(index: Column, low: float, high: float) -> Column:
        return F.lit(low) + (F.lit(high) - F.lit(low)) * index / (steps - 1)

    (x0, x1), (y0, y1) = limits
    index = F.col("id")
    points = spark.range(steps * steps).select(
        axis(F.floor(index / steps), x0, x1).alias(names[0]), axis(index % steps, y0, y1).alias(names[1])
    )
    return points.withColumn("margin", margin_column(model, list(names)))


def margins(df: DataFrame, columns: Sequence[str], model: LinearSVCModel | LinearWeights) -> DataFrame:
    """Signed margin of every row."""
    return df.withColumn("margin", margin_column(model, columns))


def with_features(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``features`` and a numeric ``label`` next to the other columns."""
    return assemble(df, columns).withColumn("label", F.col(label).cast("double"))
