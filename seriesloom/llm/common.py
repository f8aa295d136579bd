"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.session import scratch_path

BROADCAST_BYTES = 16 * 1024 * 1024
TEXT_ROWS = 1000


def ship(module: str) -> None:
    """Send the Python kernels of ``module`` to executors by value, so they need no install there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)

#: Paths of the tables stored in the block at hand.
_STORED: ContextVar[list[str] | None] = ContextVar("stored", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there.

    Cuts the lineage: a lost executor costs a re-read. Results are lazy and still read the files, so they
    stay until a block of :func:`cleared` ends or the caller clears the shared folder.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    if (made := _STORED.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Removes the tables stored inside the block when it ends, but for those its function has stored.

    For a step whose whole result is stored by that function: nothing reads the tables behind it then.
    """
    outer, kept = _STORED.get(), []
    made: list[str] = []
    _STORED.set(made)

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = stored(df, name)
        kept.append(made[-1])
        return out

    try:
        yield keep
    finally:
        _STORED.set(outer)
        for path in made:
            if path not in kept:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if outer is not None:
            outer += kept


def lean_batches(spark: SparkSession) -> None:
    """Has this session hand texts to Python in batches of ``TEXT_ROWS`` rows, unless it has chosen a size.

    A task holds a batch on both sides, and texts are of any length: Spark's own 10,000 rows may be too many.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(TEXT_ROWS))


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast when its counted rows take at most ``BROADCAST_BYTES``.

    A larger one is returned unmarked and joins by shuffle, where adaptive execution splits hot keys.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def parts(rows: int, per_task: int) -> int:
    """How many groups of about ``per_task`` rows hold ``rows``; one at least."""
    return max(1, math.ceil(rows / per_task))


def batches(table, limit: int, *columns: str):
    """Consecutive row ranges of an Arrow table whose ``columns`` hold about ``limit`` bytes each.

    A longer value has a range of its own.
    """
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.zeros(table.num_rows, dtype=np.int64)
    for c in columns:
        sizes += pc.fill_null(pc.binary_length(table.column(c)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < table.num_rows:
        yield start, table.num_rows
