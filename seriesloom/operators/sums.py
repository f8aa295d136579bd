"""Sums of numpy arrays over all rows of a frame, taken where the rows lie."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Executors need no install of the kernels: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Partial sums the driver takes directly; more are summed by tasks first.
FAN_IN = 32
#: Numbers a sum may have: every task and the driver hold a few arrays of that length.
MAX_NUMBERS = 1 << 24


def summed(rows: DataFrame, add: Callable[[np.ndarray, pa.RecordBatch], None], width: int, tasks: int | None = None) -> np.ndarray:
    """The sum over all batches of ``rows`` of what ``add(total, batch)`` adds to ``width`` numbers.

    Each task hands back one row; the driver takes ``FAN_IN`` of them at most, however many tasks there are.
    A width above ``MAX_NUMBERS`` is refused. ``tasks`` is how many partitions ``rows`` has, if known.
    """
    if width > MAX_NUMBERS:
        raise ValueError(f"{width} numbers to sum, {MAX_NUMBERS} are the most")

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in tables:
            add(total, batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merge(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in tables:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    tasks = rows.rdd.getNumPartitions() if tasks is None else tasks
    sums = rows.mapInArrow(run, "sums binary")
    while tasks > FAN_IN:
        tasks = math.ceil(math.sqrt(tasks))
        sums = sums.repartition(tasks).mapInArrow(merge, "sums binary")
    return sum((np.frombuffer(r["sums"]) for r in sums.collect()), np.zeros(width))


def numbers(column: pa.Array, rows: int) -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
