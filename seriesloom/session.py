"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "seriesloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` overrides the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which every executor reaches.

    A session without the setting must have been given a checkpoint folder otherwise.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named and context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    folder = named or context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, keep as Parquet in the shared folder and read from there.

    For results that are read several times by later steps (token counts, vocabularies, panels). The
    lineage ends at the files: a lost executor costs a re-read and not a recompute, and a later step
    reads the columns it needs. The files stay until the owner of the folder clears it.
    """
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input of few splits over all cores, for a caller whose work is heavy per row.

    A table of few, large row groups is read by few tasks, whatever the number of partitions: a row group
    is read by one of them. The rows are dealt out when the input has fewer partitions than there are
    cores, which a file of one row group always has once it is small; operators never do this by themselves.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
