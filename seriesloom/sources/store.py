"""Stored tables: overwrite, load-or-build, append of new rows, word vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.lookup import sized


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write Parquet. With partition columns, rows of one value go to few files."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at ``path`` (its ``_SUCCESS`` marker exists)."""
    return exists(spark, f"{path}/_SUCCESS")


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Load the table if it was stored; otherwise build it, store it and load it.

    A run that died while writing leaves no marker, so the table is built again.
    """
    if not is_stored(spark, path):
        write_table(build(), path, partition_by)
    return spark.read.parquet(path)


def only_new(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of the batch, one per key, whose key is not stored yet.

    The stored side gives its key column alone. When the batch's keys are small enough to broadcast,
    measured, they cut the stored keys where those are read, and what moves is bounded by the batch;
    a larger batch meets them in a shuffle join. ``batch`` is read three times: persist it.
    """
    first = batch.dropDuplicates([key])
    known = stored.select(key).join(sized(first.select(key)), key, "left_semi")
    return first.join(known.distinct(), key, "left_anti")


def append_new(spark: SparkSession, batch: DataFrame, path: str, key: str) -> None:
    """Append the rows of ``batch`` that the table at ``path`` does not hold yet."""
    fresh = only_new(batch, spark.read.parquet(path), key) if is_stored(spark, path) else batch.dropDuplicates([key])
    write_table(fresh, path, mode="append")


def save_word_vectors(model: Word2VecModel, model_path: str, table_path: str) -> None:
    """Keep the model for reloading and its vectors as a plain table."""
    model.write().overwrite().save(model_path)
    write_table(vector_table(model), table_path)


def vector_table(model: Word2VecModel) -> DataFrame:
    """``(word, vector ARRAY<FLOAT>)`` of a fitted model."""
    return model.getVectors().select("word", vector_to_array(F.col("vector"), "float32").alias("vector"))


def load_word_vectors(spark: SparkSession, model_path: str, table_path: str) -> tuple[Word2VecModel, DataFrame]:
    """The model and the vector table written by :func:`save_word_vectors`."""
    return Word2VecModel.load(model_path), spark.read.parquet(table_path)
