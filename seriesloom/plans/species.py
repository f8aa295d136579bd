"""Class profile and classification of a labelled measurement table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import classify, dense, prepare, profile, split
from seriesloom.operators.evaluate import accuracy_column, accuracy_scores
from seriesloom.operators.relational import label_index
from seriesloom.session import materialise

SEED = 346672


def profile_table(df: DataFrame, label: str, measures: Sequence[str]) -> DataFrame:
    """Rows, share and means per class, in one table."""
    return profile.class_share(df, label).join(profile.class_means(df, label, measures), label)


def binary_rows(df: DataFrame, label: str, positive: str, negative: str, columns: Sequence[str], key: str, seed: int = SEED) -> DataFrame:
    """Rows of two classes with label 1/0, a stratified split and z-scored columns."""
    two = df.where(F.col(label).isin(positive, negative)).select(key, *columns, (F.col(label) == positive).cast("int").alias("label"))
    parts = split.stratified_split(two, key, "label", seed)
    return prepare.fit_zscore(parts.where("split = 'train'"), columns).transform(parts)


def multi_rows(df: DataFrame, label: str, columns: Sequence[str], key: str, seed: int = SEED, valid: bool = False) -> tuple[DataFrame, DataFrame]:
    """All classes: rows with class index and stratified split, and the label dictionary."""
    dictionary = prepare.label_dictionary(df, label, key)
    indexed = label_index(df.select(key, label, *columns), dictionary, label, "label_index").drop(label)
    indexed = indexed.withColumnRenamed("label_index", "label")
    if valid:
        return split.three_way_split(indexed, key, seed, "label"), dictionary
    return split.stratified_split(indexed, key, "label", seed), dictionary


def dense_fits(
    rows: DataFrame, columns: Sequence[str], layouts: Sequence[Sequence[int]] = classify.DENSE_LAYOUTS, seed: int = SEED, **options
) -> tuple[DataFrame, DataFrame]:
    """Every dense layout on three-way split rows, all in the same passes, each stopped on the validation part.

    Gives accuracy per layout and part, and the losses per layout and round; ``layout`` counts from 1.
    """
    rows = materialise(rows)
    ready = materialise(prepare.fit_zscore(rows.where("split = 'train'"), columns).transform(rows))
    classes = int(ready.agg(F.max("label")).first()[0]) + 1
    nets = [dense.new_net([len(columns), *hidden, classes], "tanh", "entropy", seed) for hidden in layouts]
    fitted, histories = dense.fit_dense_nets(ready, columns, nets, **options)
    scored = dense.predict_dense(ready, fitted, columns, [f"_of_{number}" for number in range(1, len(fitted) + 1)])
    hits = [accuracy_column(prediction=f"_of_{number}").alias(f"_of_{number}") for number in range(1, len(fitted) + 1)]
    every = F.explode(F.array(*[F.struct(F.lit(n).alias("layout"), F.col(f"_of_{n}").alias("accuracy")) for n in range(1, len(fitted) + 1)])).alias("s")
    scores = scored.groupBy("split").agg(F.count("*").alias("n"), *hits).select("split", "n", every)
    return scores.select("s.layout", "split", "n", "s.accuracy"), dense.history_table(rows.sparkSession, histories)


def fit_and_score(rows: DataFrame, columns: Sequence[str], fit, scaled: bool = False, degree: int = 1) -> tuple[object, DataFrame]:
    """Fits on the train part; accuracy per part of the split."""
    if scaled:
        rows = prepare.fit_zscore(rows.where("split = 'train'"), columns).transform(rows)
    ready = prepare.assemble(rows, columns).withColumn("label", F.col("label").cast("double"))
    if degree > 1:
        ready = prepare.polynomial(ready, degree, "features", "_poly").drop("features").withColumnRenamed("_poly", "features")
    ready = materialise(ready)
    model = fit(ready.where("split = 'train'"))
    predicted = classify.predict_one_vs_one(ready, model) if isinstance(model, dict) else model.transform(ready)
    return model, accuracy_scores(predicted)
