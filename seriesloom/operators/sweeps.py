"""Parameter sweeps: one fit per setting, scores on train and test as a small table.

Each fit is a distributed job on a persisted frame, and each score is one aggregate over all parts. Up to
``PARALLELISM`` settings run at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.classify import fit_tree
from seriesloom.operators.evaluate import accuracy_column, r2_column
from seriesloom.operators.prepare import polynomial
from seriesloom.operators.regress import ALPHAS, fit_lasso

PARALLELISM = 4


def _train_test(predicted: DataFrame, score) -> tuple[float | None, float | None]:
    row = predicted.groupBy("split").agg(score.alias("score")).groupBy().agg(
        F.max(F.when(F.col("split") == "train", F.col("score"))).alias("train"),
        F.max(F.when(F.col("split") == "test", F.col("score"))).alias("test"),
    ).first()
    return row["train"], row["test"]


def _sweep(df: DataFrame, settings: Iterable[tuple], run: Callable[..., DataFrame], score, schema: str) -> DataFrame:
    df = df.persist()
    try:
        with ThreadPoolExecutor(PARALLELISM) as pool:
            one = inheritable_thread_target(lambda setting: (*setting, *_train_test(run(df, *setting), score)))
            rows = list(pool.map(one, settings))
    finally:
        df.unpersist()
    return df.sparkSession.createDataFrame(rows, f"{schema}, train_score double, test_score double")


def sweep_degree(df: DataFrame, fit: Callable[[DataFrame, str], object], degrees: Sequence[int] = (1, 2, 3), classes: bool = False) -> DataFrame:
    """``(degree, train_score, test_score)`` of a model on polynomial features.

    ``df`` has ``features``, ``label`` and ``split``; ``fit(train, features)`` returns a fitted model.
    """

    def run(frame: DataFrame, degree: int) -> DataFrame:
        expanded = polynomial(frame, degree)
        return fit(expanded.where("split = 'train'"), "poly").transform(expanded)

    score = accuracy_column() if classes else r2_column()
    return _sweep(df, [(d,) for d in degrees], run, score, "degree int")


def sweep_alpha(df: DataFrame, alphas: Sequence[float] = ALPHAS, fit=fit_lasso) -> DataFrame:
    """``(alpha, train_score, test_score, log_alpha)`` of a penalised regressor."""

    def run(frame: DataFrame, alpha: float) -> DataFrame:
        return fit(frame.where("split = 'train'"), alpha).transform(frame)

    table = _sweep(df, [(float(a),) for a in alphas], run, r2_column(), "alpha double")
    return table.withColumn("log_alpha", F.log10("alpha"))


def sweep_tree(df: DataFrame, depths: Sequence[int] = (1, 4, 7), leaves: Sequence[int] = (1, 4, 7)) -> DataFrame:
    """``(max_depth, min_leaf, train_score, test_score)`` of the gini tree."""

    def run(frame: DataFrame, depth: int, leaf: int) -> DataFrame:
        return fit_tree(frame.where("split = 'train'"), depth, leaf).transform(frame)

    settings = [(d, leaf) for d in depths for leaf in leaves]
    return _sweep(df, settings, run, accuracy_column(), "max_depth int, min_leaf int")
