"""Dense networks trained on rows that stay where they are.

The weights travel to the tasks. Rows are packed once into blocks, which are dealt out evenly and kept over
all passes. Each task runs its blocks through the networks in memory that they share, and hands back one row of summed gradients and losses, which tasks add up; the driver gets one row, holds weights and
moments only and takes the step. The sums are those of all rows of a step, however they are dealt, so a
network does not depend on the number of tasks. Several networks share a pass, and the validation losses
come with the same pass.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from seriesloom.session import scratch_path
from seriesloom.sources.store import exists

# Executors need no install of the kernels: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 2048
#: Blocks that are worth a task of their own, tasks of a pass for every core then, and blocks of a task at most.
OWN_BLOCKS, CORE_TASKS, TASK_BLOCKS = 64, 4, 512
#: Partial sums that one task adds up; more are summed in rounds first.
FAN_IN = 32
# Decay of the two moments and the least denominator of a step.
FIRST_DECAY, SECOND_DECAY, LEAST = 0.9, 0.999, 1e-7


@dataclass(frozen=True)
class DenseNet:
    """Sizes of the layers, inputs and outputs included, and all weights in one row of numbers.

    ``loss`` is ``entropy`` for classes (outputs are log odds) or ``absolute`` for one number.
    """

    layers: tuple[int, ...]
    weights: np.ndarray
    activation: str = "tanh"
    loss: str = "entropy"


def new_net(layers: Sequence[int], activation: str, loss: str, seed: int, dtype=np.float32) -> DenseNet:
    """A network with uniform random weights whose spread suits the sizes on both sides; biases are 0."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(layers, layers[1:]):
        reach = math.sqrt(6 / (a + b))
        parts += [rng.uniform(-reach, reach, a * b), np.zeros(b)]
    return DenseNet(tuple(layers), np.concatenate(parts).astype(dtype), activation, loss)


def _matrices(layers: Sequence[int], flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


class Room:
    """Arrays by name that are used again for the next block; new ones each time cost as much as what is done to them."""

    def __init__(self) -> None:
        self.kept: dict[tuple, np.ndarray] = {}

    def __call__(self, name: tuple, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size, key = math.prod(shape), (*name, dtype)
        if key not in self.kept or len(self.kept[key]) < size:
            self.kept[key] = np.empty(size, dtype)
        return self.kept[key][:size].reshape(shape)


def outputs(net: DenseNet, x: np.ndarray, room: Room | None = None) -> list[np.ndarray]:
    """The values of every layer for the rows ``x``; the last are the network's outputs. With a ``room`` they last until its next use."""
    room, dtype = room or Room(), net.weights.dtype
    values = [x.astype(dtype)]
    matrices = _matrices(net.layers, net.weights)
    for i, (w, b) in enumerate(matrices):
        z = np.matmul(values[-1], w, out=room(("value", i), (len(x), w.shape[1]), dtype))
        z += b
        if i + 1 < len(matrices):
            np.tanh(z, out=z) if net.activation == "tanh" else np.maximum(z, 0, out=z)
        values.append(z)
    return values


def _loss(net: DenseNet, out: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss and its slope in the outputs."""
    if net.loss == "absolute":
        gap = out[:, 0] - y
        return float(np.abs(gap).sum(dtype=np.float64)), np.sign(gap)[:, None].astype(out.dtype)
    shifted = out - out.max(axis=1, keepdims=True)
    powers = np.exp(shifted)
    totals = powers.sum(axis=1, keepdims=True)
    rows, classes = np.arange(len(y)), y.astype(np.int64)
    slope = powers / totals
    slope[rows, classes] -= 1
    return float((np.log(totals[:, 0]) - shifted[rows, classes]).sum(dtype=np.float64)), slope


def loss_and_gradient(net: DenseNet, x: np.ndarray, y: np.ndarray, room: Room | None = None) -> tuple[float, np.ndarray]:
    """Summed loss of the rows and its gradient in all weights, which with a ``room`` lasts until its next use."""
    room, dtype = room or Room(), net.weights.dtype
    values = outputs(net, x, room)
    loss, slope = _loss(net, values[-1], y)
    flat = room(("gradient",), net.weights.shape, dtype)
    matrices, gradients = _matrices(net.layers, net.weights), _matrices(net.layers, flat)
    for i in range(len(matrices) - 1, -1, -1):
        np.matmul(values[i].T, slope, out=gradients[i][0])
        np.sum(slope, axis=0, out=gradients[i][1])
        if i:
            slope = np.matmul(slope, matrices[i][0].T, out=room(("slope", i), values[i].shape, dtype))
            own = values[i]  # no longer needed as it is
            if net.activation == "tanh":
                np.subtract(1, np.multiply(own, own, out=own), out=own)
                slope *= own
            else:
                slope *= own > 0
    return loss, flat


def _blocks(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``x``, ``y`` and ``valid`` as blocks of ``BLOCK_ROWS`` rows, the last one what is left."""
    held: list[tuple[np.ndarray, ...]] = []

    def cut(least: int) -> Iterator[pa.RecordBatch]:
        x, y, valid = (np.concatenate(c) for c in zip(*held))
        end = len(y) // least * least if least > 1 else len(y)
        for at in range(0, end, BLOCK_ROWS):
            span = slice(at, min(at + BLOCK_ROWS, end))
            columns = [pa.array([c[span].tobytes()], pa.binary()) for c in (x, y, valid)]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "valid"])
        held[:] = [(x[end:], y[end:], valid[end:])] if end < len(y) else []

    for batch in tables:
        if batch.num_rows:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            held.append((x, y, batch.column(2).to_numpy(zero_copy_only=False).astype(bool)))
            if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                yield from cut(BLOCK_ROWS)
    if held:
        yield from cut(1)


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` (``x``, ``y``, ``valid``) with up to ``BLOCK_ROWS`` of them in one row, as bytes."""
    return rows.select("x", "y", "valid").mapInArrow(_blocks, "x binary, y binary, valid binary")


def pass_sums(rows: DataFrame, tasks: int, nets: Sequence[DenseNet]) -> list[np.ndarray]:
    """One pass over ``rows`` (``x``, ``y``, ``valid``, packed or not): per network its gradient and four last numbers.

    These are loss and rows of the training part, and loss and rows of the validation part. ``tasks`` is how
    many partitions ``rows`` has; the driver takes one row of sums, however many they are. Sums are added in
    the order of their partitions.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, room = [np.zeros(len(n.weights) + 4) for n in nets], Room()
        for batch in tables:
            for x, y, valid in zip(*batch.columns):
                own_y, held = np.frombuffer(y.as_buffer()), np.frombuffer(valid.as_buffer(), dtype=bool)
                own_x = np.frombuffer(x.as_buffer()).reshape(len(own_y), -1)
                (train_x, train_y), (held_x, held_y) = ((own_x[part], own_y[part]) for part in (~held, held))
                for net, total in zip(nets, sums):
                    if len(train_y):
                        loss, gradient = loss_and_gradient(net, train_x, train_y, room)
                        total[:-4] += gradient
                        total[-4:-2] += loss, len(train_y)
                    if len(held_y):
                        total[-2:] += _loss(net, outputs(net, held_x, room)[-1], held_y)[0], len(held_y)
        yield one_row(TaskContext.get().partitionId(), np.concatenate(sums))

    def one_row(part: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(((row["part"], row["sums"]) for batch in tables for row in batch.to_pylist()), key=lambda f: f[0])
        total = np.zeros(sum(len(n.weights) + 4 for n in nets))
        for _, value in found:
            total += np.frombuffer(value)
        yield one_row(found[0][0] if found else -1, total)

    schema = "part int, sums binary"
    blocks = rows if rows.schema["x"].dataType == BinaryType() else packed(rows)
    sums = blocks.select("x", "y", "valid").mapInArrow(run, schema)
    while tasks > 1:
        tasks = 1 if tasks <= FAN_IN else math.ceil(math.sqrt(tasks))
        sums = sums.repartition(tasks).mapInArrow(add, schema)
    total = sum((np.frombuffer(r["sums"]) for r in sums.collect()), np.zeros(sum(len(n.weights) + 4 for n in nets)))
    return np.split(total, np.cumsum([len(n.weights) + 4 for n in nets])[:-1])


@dataclass
class _Training:
    net: DenseNet
    first: np.ndarray
    second: np.ndarray
    steps: int = 0
    best: DenseNet | None = None
    history: list[tuple[float, float]] = field(default_factory=list)
    best_round: int = 0
    open: bool = True

    def step(self, gradient: np.ndarray, rate: float) -> None:
        """A step along both moments, the first one looked ahead (Nesterov)."""
        self.steps += 1
        self.first = FIRST_DECAY * self.first + (1 - FIRST_DECAY) * gradient
        self.second = SECOND_DECAY * self.second + (1 - SECOND_DECAY) * gradient**2
        ahead = FIRST_DECAY * self.first / (1 - FIRST_DECAY ** (self.steps + 1)) + (1 - FIRST_DECAY) * gradient / (1 - FIRST_DECAY**self.steps)
        spread = np.sqrt(self.second / (1 - SECOND_DECAY**self.steps)) + LEAST
        moved = self.net.weights - (rate * ahead / spread).astype(self.net.weights.dtype)
        self.net = DenseNet(self.net.layers, moved, self.net.activation, self.net.loss)

    def note(self, number: int, train: float, valid: float, gain: float, patience: int, start: DenseNet) -> None:
        """Losses of a round at the weights it starts from; ends the training when they stopped falling."""
        self.history.append((train, valid))
        if self.best is None or valid < self.history[self.best_round - 1][1] * (1 - gain):
            self.best, self.best_round = start, number
        elif number - self.best_round >= patience:
            self.open = False


def _dealt(rows: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of the rows, dealt evenly over the cores and kept, and the number of the tasks.

    Each core gets several tasks once the blocks are worth it, so that a slow one holds up only part of a pass.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = math.ceil(rows.count() / BLOCK_ROWS)
    waves = max(min(blocks // (OWN_BLOCKS * cores), CORE_TASKS), math.ceil(blocks / (TASK_BLOCKS * cores)), 1)
    tasks = max(1, min(waves * cores, blocks))
    return packed(rows).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK), tasks


def fit_dense_nets(
    rows: DataFrame, columns: Sequence[str], nets: Sequence[DenseNet], label: str = "label", split: str = "split",
    rounds: int = 1000, patience: int = 10, batches: int = 4, rate: float = 0.003, decay: float = 0.0, gain: float = 1e-4,
) -> tuple[list[DenseNet], list[list[tuple[int, float, float, bool]]]]:
    """The ``nets`` trained side by side on the rows whose ``split`` is ``train``, and their loss histories.

    A round steps through ``batches`` parts of the rows, dealt by hash. A network stops when the loss on the
    rows of split ``valid`` (on the training rows where there are none) has not fallen by a share of ``gain``
    for ``patience`` rounds, and keeps the weights of its best round; nothing is fitted twice. The history
    has number, both losses at the weights the round starts from (the training loss as its parts are seen)
    and whether it is the best. Step ``t`` moves by ``rate / (1 + decay * t)``. Scale the inputs first; rows
    with a null in an input, the label or the split are left out.
    """
    spark = rows.sparkSession
    known = rows.where(F.col(split).isin("train", "valid")).na.drop(subset=[*columns, label])
    ready = known.select(
        F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), F.col(label).cast("double").alias("y"), (F.col(split) == "valid").alias("valid")
    )
    number = F.when(F.col("valid"), F.lit(0)).otherwise(F.pmod(F.xxhash64("x", "y"), F.lit(batches)).cast("int"))
    path = scratch_path(spark, "dense")
    ready.withColumn("part", number).write.partitionBy("part").parquet(path)
    # Each part is read from its own folder, so no step lists or filters the others.
    schema = ready.schema
    parts = [spark.read.schema(schema).option("basePath", f"{path}/part={p}").parquet(f"{path}/part={p}") for p in range(batches) if exists(spark, f"{path}/part={p}")]
    parts = [_dealt(part) for part in parts]
    runs = [_Training(n, np.zeros(len(n.weights)), np.zeros(len(n.weights))) for n in nets]
    try:
        for turn in range(1, rounds + 1):
            live = [r for r in runs if r.open]
            if not live or not parts:
                break
            start, seen = [r.net for r in live], np.zeros((len(live), 4))
            for part in parts:
                for i, (run, sums) in enumerate(zip(live, pass_sums(*part, [r.net for r in live]))):
                    seen[i] += sums[-4:]
                    if sums[-3]:
                        run.step(sums[:-4] / sums[-3], rate / (1 + decay * run.steps))
            for run, net, (loss, n, held_loss, held) in zip(live, start, seen.tolist()):
                train = loss / n if n else math.nan
                run.note(turn, train, held_loss / held if held else train, gain, patience, net)
    finally:
        for part, _ in parts:
            part.unpersist()
    history = [[(i, *losses, i == r.best_round) for i, losses in enumerate(r.history, 1)] for r in runs]
    return [r.best or r.net for r in runs], history


def history_table(spark, histories: Sequence[Sequence[tuple]]) -> DataFrame:
    """The histories of several networks as rows; ``layout`` counts from 1."""
    rows = [(number, *row) for number, history in enumerate(histories, 1) for row in history]
    return spark.createDataFrame(rows, "layout int, round int, train_loss double, valid_loss double, is_best boolean")


def forward(nets: Sequence[DenseNet]) -> Callable[[Column], Column]:
    """The networks as a column function of an array of inputs: for each the likeliest class (ties to the lower one), or
    the one output; null for a row with a null or no number."""

    @F.arrow_udf("array<double>")
    def run(x: pa.Array) -> pa.Array:
        rows, room = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), nets[0].layers[0]), Room()
        found = np.empty((len(x), len(nets)))
        for at in range(0, len(x), BLOCK_ROWS):
            own = slice(at, at + BLOCK_ROWS)
            for i, net in enumerate(nets):
                out = outputs(net, rows[own], room)[-1].astype(np.float64)
                if net.loss == "entropy":
                    out = np.exp(out - out.max(axis=1, keepdims=True))
                    out /= out.sum(axis=1, keepdims=True)
                    found[own, i] = np.where(np.isnan(out).any(axis=1), np.nan, out.argmax(axis=1))
                else:
                    found[own, i] = out[:, 0]
        return pa.ListArray.from_arrays(np.arange(0, found.size + 1, len(nets), dtype=np.int32), pa.array(found.ravel(), from_pandas=True))

    return run


def predict_dense(
    df: DataFrame, net: DenseNet | Sequence[DenseNet], columns: Sequence[str], prediction: str | Sequence[str] = "prediction"
) -> DataFrame:
    """``df`` with the likeliest class (ties to the lower one) or the number the network gives.

    Several networks, with a name of a prediction each, run in one pass over the rows.
    """
    nets, names = ([net], [prediction]) if isinstance(net, DenseNet) else (net, prediction)
    scored = df.withColumn("_out", forward(nets)(F.array(*[F.col(c).cast("double") for c in columns])))
    return scored.withColumns({name: F.col("_out")[i] for i, name in enumerate(names)}).drop("_out")
