"""Linear classifiers of all pairs of classes, fitted together in passes over one table.

Each pass sums, for every pair, loss, slope and curvature of its rows; the driver takes one Newton step per
pair. The corner of the hinge is rounded by a width that shrinks, so the last steps are those of the hinge.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.classify import LinearWeights
from seriesloom.operators.sums import numbers, summed
from seriesloom.session import scratch_path

# Executors need no install of the kernels: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Widths of the rounded corner, the share of a step's promise it must keep, the shorter steps that are tried.
WIDTHS = tuple(2 * 0.5**i for i in range(13))
LEAST_GAIN, STEPS = 1e-4, tuple(0.5**i for i in range(10))
#: Share of the loss a step must still promise before the corner is made sharper.
ROUGHLY = 1e-3
MAX_PASSES = 300
#: Rows of a block: what every pass reads are blocks of numbers, packed once.
BLOCK_ROWS = 10_000


@dataclass
class _Pair:
    """A pair's weights (the last is the intercept), the step on trial and what is known at the weights."""

    c: float
    point: np.ndarray
    direction: np.ndarray
    loss: float = np.inf
    promise: float = 0.0
    stage: int = 0
    open: bool = True
    damping: float = 0.0
    trial: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def value(self, losses: np.ndarray) -> np.ndarray:
        """Half the squared slopes (the intercept is free) plus ``c`` times the summed loss, at all trial points."""
        return 0.5 * (self.trial[:, :-1] ** 2).sum(axis=1) + self.c * losses

    def aim(self) -> None:
        """The points of the next pass: the whole step first, then shorter ones."""
        self.trial = self.point + np.outer(STEPS, self.direction)

    def take(self, losses: np.ndarray, slope: np.ndarray, curve: np.ndarray, tolerance: float) -> None:
        """Moves to the trial point that keeps its promise; slope and curvature are those of the first point."""
        values = self.value(losses)
        if np.isfinite(self.loss):
            kept = np.flatnonzero(values <= self.loss - LEAST_GAIN * np.array(STEPS) * self.promise)
            if not len(kept):
                # The curvature promises too much: a shorter step from the same point.
                self.damping = max(self.damping * 1e3, 1e-6)
                if self.damping > 1e9:
                    self._narrower()
                else:
                    self._head()
                return
            if kept[0] > 0:
                # Slope and curvature are wanted at the shorter step: the next pass looks there.
                self.damping = max(self.damping * 4, 1e-6)
                self.point, self.direction, self.loss = self.trial[kept[0]], 0 * self.direction, np.inf
                return
            self.damping /= 10
        self.point, self.loss = self.trial[0], float(values[0])
        self.free = np.append(np.ones(len(slope) - 1), 0.0)
        self.slope, self.curve = self.free * self.point + self.c * slope, np.diag(self.free) + self.c * curve
        enough = (tolerance if self.stage + 1 == len(WIDTHS) else ROUGHLY) * max(1e-300, abs(self.loss))
        self._head()
        if self.promise <= enough and self.damping:
            # A damped step promises little wherever it starts; only the whole one tells that this is the end.
            self.damping = 0.0
            self._head()
        if self.promise <= enough:
            self._narrower()

    def _head(self) -> None:
        """The Newton step; damping holds back most where few rows bend the loss, as for the intercept."""
        size = max(1e-12, float(np.abs(self.curve).max()))
        held = self.curve + max(self.damping, 1e-12) * size * np.eye(len(self.curve))
        self.direction = -np.linalg.solve(held, self.slope)
        self.promise = float(-self.slope @ self.direction)

    def _narrower(self) -> None:
        self.loss, self.promise, self.direction = np.inf, 0.0, 0 * self.direction
        self.damping = min(self.damping, 1e-3)
        if self.stage + 1 < len(WIDTHS):
            self.stage += 1
        else:
            self.open = False


def rounded_hinge(short: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of how far margins fall short of 1, with its first and second derivative in that."""
    inside = np.clip(short + width, 0, 2 * width)
    loss = inside**2 / (4 * width) + np.maximum(short - width, 0)
    return loss, inside / (2 * width), (np.abs(short) < width) / (2 * width)


def hinge_losses(short: np.ndarray, width: float) -> np.ndarray:
    """The losses of :func:`rounded_hinge` alone."""
    inside = np.clip(short + width, 0, 2 * width)
    np.square(inside, out=inside)
    inside /= 4 * width
    inside += np.maximum(short - width, 0)
    return inside


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows ``x``, ``y`` as stored blocks of one class: ``y`` and the numbers of its rows, a one behind each row.

    Not compressed, so that a split of the files is no more in memory than on disk.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                y = some.column(1).to_numpy(zero_copy_only=False)
                x = np.concatenate([numbers(some.column(0), some.num_rows), np.ones((some.num_rows, 1))], axis=1)
                names = np.unique(y)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array([np.ascontiguousarray(x[y == k], dtype=np.float64).tobytes() for k in names], pa.binary())], names=["y", "x"]
                )

    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "blocks")
    packed = rows.mapInArrow(run, "y int, x binary")
    packed.write.option("compression", "none").parquet(path)
    return spark.read.schema(packed.schema).parquet(path)


def fit_all_pairs(
    train: DataFrame, classes: Sequence[int] | None = None, c: float = 1.0, features: str = "features", label: str = "label", tolerance: float = 1e-11
) -> dict[tuple[int, int], LinearWeights]:
    """A linear support vector classifier for every pair of classes: ``{(low, high): weights}``.

    The minimum of half the squared slopes plus ``c`` times the summed hinge loss, as ``fit_one_vs_one`` has it,
    but one job per pass for all pairs. Pass a stored table: it is read once for its blocks. Rows with a null are left out, a class without
    rows gives pairs whose weights are those of the other class alone. Per pair the driver holds
    the square of the number of features; more than ``sums.MAX_NUMBERS`` in all are refused.
    """
    known = train.where(F.col(features).isNotNull() & F.col(label).isNotNull())
    rows = known.select(vector_to_array(features).alias("x"), F.col(label).cast("double").cast("int").alias("y"))
    if classes is None:
        classes = [r["y"] for r in rows.select("y").distinct().collect()]
    names = list(combinations(sorted(int(k) for k in classes), 2))
    first = rows.first()
    if first is None or not names:
        return {}
    size, blocks = len(first["x"]) + 1, _blocks(rows)
    tasks = blocks.rdd.getNumPartitions()
    pairs = [_Pair(c, np.zeros(size), np.zeros(size)) for _ in names]
    for _ in range(MAX_PASSES):
        live = [(name, p) for name, p in zip(names, pairs) if p.open]
        if not live:
            break
        for _, p in live:
            p.aim()
        asked = [(low, high, p.point, p.trial[0], p.direction, WIDTHS[p.stage]) for (low, high), p in live]
        each = len(STEPS) + size + size * size

        def add(total: np.ndarray, batch: pa.RecordBatch, asked=asked, each=each) -> None:
            for k, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(block.as_buffer()).reshape(-1, size)
                for i, (low, high, point, first_point, direction, width) in enumerate(asked):
                    if k != low and k != high:
                        continue
                    sign = 1.0 if k == high else -1.0
                    part = total[i * each : (i + 1) * each]
                    short = 1 - sign * (x @ first_point)
                    loss, first, second = rounded_hinge(short, width)
                    part[0] += loss.sum()
                    if direction.any():
                        away = 1 - sign * (x @ point)
                        turn = sign * (x @ direction)
                        for at, step in enumerate(STEPS[1:], 1):
                            part[at] += hinge_losses(away - step * turn, width).sum()
                    part[len(STEPS) : len(STEPS) + size] -= sign * (first @ x)
                    # Only rows at the corner bend the loss.
                    bent = np.flatnonzero(second)
                    near = x[bent]
                    part[len(STEPS) + size :] += ((near * second[bent, None]).T @ near).ravel()

        sums = summed(blocks, add, each * len(live), tasks).reshape(len(live), each)
        for (_, p), s in zip(live, sums):
            p.take(s[: len(STEPS)], s[len(STEPS) : len(STEPS) + size], s[len(STEPS) + size :].reshape(size, size), tolerance)
    return {name: LinearWeights([float(v) for v in p.point[:-1]], float(p.point[-1])) for name, p in zip(names, pairs)}
