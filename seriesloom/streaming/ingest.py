"""Incremental article ingest.

A file stream picks up newly fetched articles. Each micro-batch is written to a folder of its own under
``run=<id>/batch_id=<n>``; the id is that of the stream's checkpoint. A batch that is replayed after a
failure overwrites its own rows and adds nothing twice, and a stream with another checkpoint writes
beside what is stored. Within a batch rows lie in ``bucket`` folders by a hash of their key, so a batch
is compared with the buckets its keys fall into.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seriesloom.sources.store import exists, only_new

BUCKETS = 256
LAYOUT = ["run", "batch_id", "bucket"]


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _stored(spark: SparkSession, store: str, schema: StructType, key: str) -> DataFrame:
    typed = StructType([schema[key]]).add("run", "string").add("batch_id", "long").add("bucket", "integer")
    return spark.read.schema(typed).parquet(store)


def _write_batch(store: str, checkpoint: str, schema: StructType, key: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        batch = batch.withColumn("bucket", _bucket(key)).persist()
        if exists(spark, store):
            touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]  # BUCKETS rows at most
            others = _stored(spark, store, schema, key).where(F.col("bucket").isin(touched))
            fresh = only_new(batch, others.where((F.col("run") != run) | (F.col("batch_id") != batch_id)), key)
        else:
            fresh = batch.dropDuplicates([key])
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/run={run}/batch_id={batch_id}")
        batch.unpersist()

    return write


def ingest_articles(
    spark: SparkSession,
    incoming: str,
    store: str,
    checkpoint: str,
    schema: StructType,
    key: str = "url",
    files_per_batch: int | None = None,
    glob: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Read every new file of ``incoming`` once, keep rows whose key is not stored yet, then stop.

    ``prepare`` may rework the rows before they are stored. Run it again with the same checkpoint to
    pick up later files; a new checkpoint reads all files again and adds what the store lacks.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.parquet(incoming)
    if prepare:
        rows = prepare(rows)
    writer = rows.writeStream.foreachBatch(_write_batch(store, checkpoint, rows.schema, key))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_store(spark: SparkSession, store: str, schema: StructType | None = None) -> DataFrame:
    """All stored articles; with a ``schema`` also of a store without a row."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(store).drop(*LAYOUT)
