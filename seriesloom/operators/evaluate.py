"""Scores of predictions, each one aggregate over all parts of a split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _by(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*keys) if keys else df.groupBy()


def r2_column(label: str = "label", prediction: str = "prediction") -> Column:
    """Share of the label's variance the prediction explains; null when the label is constant."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    total = F.var_pop(y) * F.count(y)
    return 1 - F.sum((y - p) * (y - p)) / F.nullif(total, F.lit(0.0))


def mae_column(label: str = "label", prediction: str = "prediction") -> Column:
    """Mean absolute error."""
    return F.avg(F.abs(F.col(label) - F.col(prediction)))


def accuracy_column(label: str = "label", prediction: str = "prediction") -> Column:
    """Share of rows whose class is predicted."""
    return F.avg((F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double"))


def regression_scores(df: DataFrame, keys: Sequence[str] = ("split",), label: str = "label") -> DataFrame:
    """Rows, R2 and mean absolute error per part."""
    return _by(df, keys).agg(F.count("*").alias("n"), r2_column(label).alias("r2"), mae_column(label).alias("mae"))


def accuracy_scores(df: DataFrame, keys: Sequence[str] = ("split",), label: str = "label") -> DataFrame:
    """Rows and accuracy per part."""
    return _by(df, keys).agg(F.count("*").alias("n"), accuracy_column(label).alias("accuracy"))
