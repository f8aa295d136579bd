"""Slices, null handling, latest rows, joins and unions of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.lookup import sized
from seriesloom.session import materialise


def class_slice(df: DataFrame, label: str, value, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of the rows of one class; filter and columns reach the scan."""
    return df.where(F.col(label) == value).select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """All columns but the named ones."""
    return df.drop(*columns)


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in any (or any named) column."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose score is still to be filled."""
    return df.where(F.col(column).isNull())


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of an order: each task keeps its best ``n``, no full sort."""
    return df.orderBy(*order).limit(n)


def latest_row(df: DataFrame, series: str, date: str, shift_days: int = 1) -> DataFrame:
    """Newest row of every series, its date moved on: the row a next-day forecast is made from."""
    columns = [c for c in df.columns if c != series]
    newest = df.groupBy(series).agg(F.max_by(F.struct(*columns), F.col(date)).alias("row"))
    picked = newest.select(series, *[F.col(f"row.{c}").alias(c) for c in columns])
    return picked.withColumn(date, F.date_add(F.col(date), shift_days)).select(*df.columns)


def with_daily_score(panel: DataFrame, scores: DataFrame, date: str = "date") -> DataFrame:
    """Daily table with the score of its day, null on days without one.

    ``scores`` has one row per calendar day; Spark picks broadcast or sort-merge by its size.
    """
    return panel.join(scores, date, "left")


def fill_from(df: DataFrame, filled: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace nulls of ``columns`` by the values another table holds for the same keys."""
    renamed = filled.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = df.join(renamed, list(keys), "left")
    patched = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}
    return joined.withColumns(patched).select(*df.columns)


def merge_score_tables(nouns: DataFrame, cohesion: DataFrame) -> DataFrame:
    """One score per token: noun score plus cohesion for a noun, cohesion alone for the others."""
    left = nouns.select("token", F.col("score").alias("noun_score"))
    right = cohesion.select("token", F.col("score").alias("cohesion_score"))
    both = F.col("noun_score") + F.coalesce(F.col("cohesion_score"), F.lit(0.0))
    score = F.when(F.col("noun_score").isNotNull(), both).otherwise(F.col("cohesion_score"))
    return left.join(right, "token", "full_outer").select("token", score.alias("score"))


def label_index(df: DataFrame, dictionary: DataFrame, label: str, index: str = "label_index") -> DataFrame:
    """Class text to its index by the label dictionary, which is stored, measured and broadcast if small."""
    return df.join(sized(materialise(dictionary.select(label, index))), label, "left")


def fixed_index(df: DataFrame, names: Sequence[str], column: str, index: str) -> DataFrame:
    """Position of a name in a fixed list; null for a name that is not listed."""
    spark = df.sparkSession
    rows = [(name, i) for i, name in enumerate(names)]
    listed = spark.createDataFrame(rows, f"{column} string, {index} int")
    return df.join(F.broadcast(listed), column, "left")


def every_pairing(batches: DataFrame, names: Sequence[str] | DataFrame, column: str) -> DataFrame:
    """Each batch once per name: of a list, or of the first column of a table of a few names.

    The names reach the batches as one array (a table's as a subquery result) that is exploded.
    """
    if isinstance(names, DataFrame):
        listed = names.agg(F.sort_array(F.collect_set(names.columns[0])).alias("names")).scalar()
    else:
        listed = F.array(*[F.lit(n) for n in names])
    return batches.withColumn(column, F.explode(listed))


def labelled_union(slices: Mapping[int, DataFrame], label: str = "label") -> DataFrame:
    """Class slices stacked, each with its numeric label."""
    frames = [frame.withColumn(label, F.lit(value)) for value, frame in slices.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def merge_vocabulary(words: DataFrame, more: DataFrame) -> DataFrame:
    """Distinct words of two vocabularies."""
    return words.select("word").union(more.select("word")).distinct()


def parameter_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small user-supplied table of parameters."""
    return spark.createDataFrame(list(rows), schema)
