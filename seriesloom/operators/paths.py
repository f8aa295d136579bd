"""Linear fits over many settings from one scan.

The scan sums, per split, the products of all terms and the label. Fits and R2 on any split are arithmetic on
those few numbers, so a sweep costs one job whatever the number of degrees or penalties.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.regress import ALPHAS
from seriesloom.operators.sums import numbers, summed

PARTS = ("train", "test")
BLOCK_ROWS = 4096
#: Rounds of coordinate descent, and after how many the set of non-zero terms is tried for an exact answer.
MAX_ROUNDS, TRY_EVERY = 20_000, 25
TOLERANCE = 1e-10


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred sums of products of the terms, with the label as the last one."""

    rows: int
    mean: np.ndarray
    scatter: np.ndarray

    def terms(self, chosen: Sequence[int]) -> Moments:
        """The moments of some of the terms, and of the label."""
        at = [*chosen, len(self.mean) - 1]
        return Moments(self.rows, self.mean[at], self.scatter[np.ix_(at, at)])


def products(inputs: int, degree: int) -> list[tuple[int, ...]]:
    """The columns each term multiplies: all products of up to ``degree`` inputs, shorter ones first."""
    return [t for d in range(1, degree + 1) for t in combinations_with_replacement(range(inputs), d)]


def split_moments(df: DataFrame, degree: int = 1, features: str = "features", label: str = "label", split: str = "split") -> dict[str, Moments]:
    """Moments of all products of the features up to a degree, for ``train`` and ``test``; one scan.

    Sums are taken around the first row found, so a large offset costs no digits. Rows with a null in the
    features, the label or the split count nowhere; a split without rows has none in the result.
    """
    known = df.where(F.col(split).isin(*PARTS) & F.col(features).isNotNull() & F.col(label).isNotNull())
    rows = known.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), (F.col(split) == PARTS[1]).alias("test"))
    first = rows.first()
    if first is None:
        return {}
    wanted = products(len(first["x"]), degree)

    def expanded(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.empty((len(y), len(wanted) + 1))
        for i, term in enumerate(wanted):
            z[:, i] = x[:, term].prod(axis=1)
        z[:, -1] = y
        return z

    origin = expanded(np.array([first["x"]]), np.array([first["y"]]))
    size = len(wanted) + 2

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        held = np.array(batch.column(2).to_pylist(), dtype=bool)
        y, x = batch.column(1).to_numpy(zero_copy_only=False), numbers(batch.column(0), batch.num_rows)
        sums = total.reshape(2, size, size)
        for at in range(0, len(y), BLOCK_ROWS):
            span = slice(at, at + BLOCK_ROWS)
            z = np.concatenate([np.ones((len(y[span]), 1)), expanded(x[span], y[span]) - origin], axis=1)
            for part, chosen in enumerate((~held[span], held[span])):
                sums[part] += z[chosen].T @ z[chosen]

    found = {}
    for name, sums in zip(PARTS, summed(rows, add, 2 * size * size).reshape(2, size, size)):
        n = sums[0, 0]
        if n:
            shift = sums[0, 1:] / n
            found[name] = Moments(int(round(n)), shift + origin[0], sums[1:, 1:] - n * np.outer(shift, shift))
    return found


def least_squares(train: Moments) -> np.ndarray:
    """Coefficients of least squares; of those that fit alike the shortest in units of the deviations."""
    width = np.sqrt(np.maximum(np.diag(train.scatter)[:-1], 0))
    width[width == 0] = 1
    scaled = train.scatter[:-1, :-1] / np.outer(width, width)
    return np.linalg.lstsq(scaled, train.scatter[:-1, -1] / width, rcond=1e-13)[0] / width


def ridge_path(train: Moments, alphas: Sequence[float]) -> list[np.ndarray]:
    """Minimisers of ``|y - Xw|^2 + alpha |w|^2`` for each alpha."""
    size = len(train.mean) - 1
    return [np.linalg.solve(train.scatter[:-1, :-1] + a * np.eye(size), train.scatter[:-1, -1]) if a else least_squares(train) for a in alphas]


def _at_minimum(gram: np.ndarray, toward: np.ndarray, w: np.ndarray, alpha: float) -> np.ndarray | None:
    """The exact minimum over the non-zero terms of ``w`` if its signs and the other terms agree with it."""
    active, out = np.flatnonzero(w), np.zeros(len(w))
    if len(active):
        signs = np.sign(w[active])
        solved, *_ = np.linalg.lstsq(gram[np.ix_(active, active)], toward[active] - alpha * signs, rcond=1e-14)
        if (np.sign(solved) != signs).any():
            return None
        out[active] = solved
    slope, slack = toward - gram @ out, 1e-7 * max(alpha, np.abs(toward).max(initial=0) * 1e-6)
    return out if (np.abs(slope) <= alpha + slack).all() else None


def lasso_path(train: Moments, alphas: Sequence[float]) -> list[np.ndarray]:
    """Minimisers of ``|y - Xw|^2 / (2n) + alpha |w|_1`` for each alpha, by coordinate descent.

    The largest alpha comes first and each starts from the one before; a constant term keeps 0.
    """
    gram, toward = train.scatter[:-1, :-1] / train.rows, train.scatter[:-1, -1] / train.rows
    # In units of its deviation every term has slope 1; the penalty then differs by term.
    width = np.sqrt(np.maximum(np.diag(gram), 0))
    used = np.flatnonzero(width > 0)
    gram, toward, width = gram[np.ix_(used, used)], toward[used], width[used]
    found, w = {}, np.zeros(len(used))
    for alpha in sorted(set(map(float, alphas)), reverse=True):
        for turn in range(1, MAX_ROUNDS + 1):
            moved = 0.0
            for j in range(len(w)):
                rest = toward[j] - gram[j] @ w + gram[j, j] * w[j]
                new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / gram[j, j]
                moved = max(moved, abs(new - w[j]) * width[j])
                w[j] = new
            exact = _at_minimum(gram, toward, w, alpha) if turn % TRY_EVERY == 0 or moved == 0 else None
            if exact is not None:
                w = exact
                break
            if moved <= TOLERANCE * max(1e-300, (np.abs(w) * width).max(initial=0)):
                break
        full = np.zeros(len(train.mean) - 1)
        full[used] = w
        found[alpha], w = full, w.copy()
    return [found[float(a)] for a in alphas]


def r_squared(of: Moments | None, train: Moments, w: np.ndarray) -> float | None:
    """R2 on the rows behind ``of`` of the line with slopes ``w`` through the means of ``train``."""
    if of is None or of.scatter[-1, -1] <= 0:
        return None
    gap = of.mean - train.mean
    v = np.append(-w, 1.0)
    return float(1 - (v @ of.scatter @ v + of.rows * (v @ gap) ** 2) / of.scatter[-1, -1])


def _scores(found: dict[str, Moments], w: np.ndarray, chosen: Sequence[int]) -> tuple[float | None, float | None]:
    train, test = (found[p].terms(chosen) if p in found else None for p in PARTS)
    return r_squared(train, train, w), r_squared(test, train, w)


def alpha_path(df: DataFrame, alphas: Sequence[float] = ALPHAS, penalty: str = "absolute") -> DataFrame:
    """``(alpha, train_score, test_score, log_alpha)`` of a line with a penalty on ``absolute`` or ``squared`` slopes."""
    found = split_moments(df)
    if "train" not in found:
        raise ValueError("no training rows")
    fit = {"absolute": lasso_path, "squared": ridge_path}[penalty]
    every = range(len(found["train"].mean) - 1)
    rows = [(float(a), *_scores(found, w, every)) for a, w in zip(alphas, fit(found["train"], alphas))]
    table = df.sparkSession.createDataFrame(rows, "alpha double, train_score double, test_score double")
    return table.withColumn("log_alpha", F.log10("alpha"))


def degree_path(df: DataFrame, degrees: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """``(degree, train_score, test_score)`` of least squares on all products of the features up to a degree."""
    found = split_moments(df, max(degrees))
    if "train" not in found:
        raise ValueError("no training rows")
    inputs = len(df.where("features is not null").select(vector_to_array("features").alias("x")).first()["x"])
    rows = []
    for degree in degrees:
        chosen = range(len(products(inputs, degree)))
        rows.append((int(degree), *_scores(found, least_squares(found["train"].terms(chosen)), chosen)))
    return df.sparkSession.createDataFrame(rows, "degree int, train_score double, test_score double")
