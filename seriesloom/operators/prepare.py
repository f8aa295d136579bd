"""Feature preparation: assembling, scaling, polynomial terms, label dictionaries, one-hot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns as one vector; a null is an error, as in a dense matrix."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


@dataclass(frozen=True)
class Scaling:
    """Fitted shift and width per column; a column without width becomes 0."""

    shift: dict[str, float]
    width: dict[str, float]

    def column(self, name: str) -> Column:
        """One scaled column."""
        if not self.width[name]:
            return F.when(F.col(name).isNotNull(), F.lit(0.0))
        return (F.col(name) - F.lit(self.shift[name])) / F.lit(self.width[name])

    def transform(self, df: DataFrame) -> DataFrame:
        """The frame with its columns scaled in place; other parts use the fitted values unchanged."""
        return df.withColumns({c: self.column(c) for c in self.shift})


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean and population standard deviation of each column, in one aggregate."""
    stats = []
    for i, c in enumerate(columns):
        stats += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = df.agg(*stats).first()
    return Scaling(
        {c: row[f"m{i}"] or 0.0 for i, c in enumerate(columns)}, {c: row[f"s{i}"] or 0.0 for i, c in enumerate(columns)}
    )


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Minimum and range of each column, in one aggregate; later values are not clipped."""
    stats = []
    for i, c in enumerate(columns):
        stats += [F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
    row = df.agg(*stats).first()
    low = {c: float(row[f"l{i}"] or 0.0) for i, c in enumerate(columns)}
    return Scaling(low, {c: float(row[f"h{i}"] or 0.0) - low[c] for i, c in enumerate(columns)})


def polynomial(df: DataFrame, degree: int, features: str = "features", output: str = "poly") -> DataFrame:
    """All products of the features up to a degree, without the constant term."""
    return PolynomialExpansion(degree=degree, inputCol=features, outputCol=output).transform(df)


def polynomial_columns(df: DataFrame, columns: Sequence[str], degree: int, prefix: str = "p") -> tuple[DataFrame, list[str]]:
    """Polynomial terms as plain columns, so that they can be scaled one by one."""
    expanded = polynomial(assemble(df, columns, "_x"), degree, "_x", "_poly")
    expanded = expanded.withColumn("_poly", vector_to_array("_poly"))
    terms = _term_count(len(columns), degree)
    names = [f"{prefix}{i}" for i in range(terms)]
    return expanded.withColumns({n: F.col("_poly")[i] for i, n in enumerate(names)}).drop("_x", "_poly"), names


def _term_count(inputs: int, degree: int) -> int:
    count = 1
    for i in range(1, degree + 1):
        count = count * (inputs + i) // i
    return count - 1


def label_dictionary(df: DataFrame, label: str, row_key: str, index: str = "label_index") -> DataFrame:
    """Classes numbered from 0 in order of first appearance by ``row_key``.

    The window runs over one row per class.
    """
    first = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.min(row_key).alias("first_key"))
    number = F.row_number().over(Window.orderBy("first_key", label)) - 1
    return first.withColumn(index, number)


def one_hot(df: DataFrame, index: str, output: str = "one_hot") -> DataFrame:
    """Class index to a vector with one entry per class, none left out."""
    encoder = OneHotEncoder(inputCol=index, outputCol=output, dropLast=False)
    return encoder.fit(df).transform(df)
