"""K-means over scaled anchor similarities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_kmeans(df: DataFrame, k: int = 3, features: str = "features", seed: int = 346672) -> KMeansModel:
    """Distributed k-means with k-means|| starts."""
    return KMeans(k=k, featuresCol=features, predictionCol="cluster", seed=seed, maxIter=100, tol=1e-6).fit(df)


def ordered_labels(model: KMeansModel, up: int, down: int) -> list[int]:
    """New number of each cluster: 0 for the centre that leans most to ``down``, rising to ``up``.

    Cluster numbers are arbitrary; in this order their mean is a score.
    """
    lean = [float(c[up] - c[down]) for c in model.clusterCenters()]
    order = sorted(range(len(lean)), key=lambda i: lean[i])
    return [order.index(i) for i in range(len(lean))]


def cluster_scores(df: DataFrame, model: KMeansModel, up: int, down: int, output: str = "score") -> DataFrame:
    """Adds the ordered cluster number of every row."""
    numbers = F.array(*[F.lit(float(v)) for v in ordered_labels(model, up, down)])
    return model.transform(df).withColumn(output, F.get(numbers, F.col("cluster"))).drop("cluster")


def nearest_centre(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest of a few given centres, ties to the first."""

    def distance(centre: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for name, value in zip(columns, centre):
            gap = F.col(name) - F.lit(float(value))
            total = total + gap * gap
        return total

    options = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*options))["i"]


def lloyd_step(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]]) -> DataFrame:
    """One refinement: rows per nearest centre and the new centres."""
    assigned = df.withColumn("cluster", nearest_centre(columns, centres))
    return assigned.groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"centre_{c}") for c in columns])
