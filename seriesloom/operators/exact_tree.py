"""Gini trees whose cuts are tried between all values that occur.

A level is one job: rows find their node where they lie and are counted per (node, feature, value, class). The
values of a feature are dealt into ranges, from their number, so that running counts over all values are
running counts over ranges plus those within one. The best cut per node is all that reaches the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesloom.operators.sums import numbers
from seriesloom.session import materialise

# Executors need no install of the kernels: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct values of a feature that are counted up in one task.
RANGE_VALUES = 100_000
KEYS = ["node", "feature"]


@dataclass
class ExactTree:
    """Nodes in the order in which they were made; a leaf has feature -1. ``counts`` are rows per class."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    counts: list[list[int]] = field(default_factory=list)

    def grow(self, counts: Sequence[int], depth: int) -> int:
        """A new leaf; its number."""
        for values, value in ((self.feature, -1), (self.threshold, math.nan), (self.left, -1), (self.right, -1), (self.depth, depth)):
            values.append(value)
        self.counts.append([int(c) for c in counts])
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Feature, threshold, left and right as arrays, for the tasks."""
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)


def gini(counts: Sequence[int]) -> float:
    """Impurity of a node."""
    n = sum(counts)
    return 1 - sum((c / n) ** 2 for c in counts) if n else 0.0


def places(arrays: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The leaf of every row: left where the value is at most the threshold."""
    feature, threshold, left, right = arrays
    node = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = np.flatnonzero(feature[node] >= 0)
        if not len(inner):
            return node
        at = node[inner]
        node[inner] = np.where(x[inner, feature[at]] <= threshold[at], left[at], right[at])


def value_counts(rows: DataFrame, tree: ExactTree, open_nodes: Sequence[int], cuts: Sequence[np.ndarray], classes: int) -> DataFrame:
    """``node``, ``feature``, ``range``, ``value`` and rows per class ``c0``, ``c1`` .. of the open nodes."""
    arrays, wanted = tree.arrays(), np.zeros(len(tree.feature), dtype=bool)
    wanted[list(open_nodes)] = True

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            if not batch.num_rows:
                continue
            x, y = numbers(batch.column(0), batch.num_rows), batch.column(1).to_numpy(zero_copy_only=False)
            node = places(arrays, x)
            kept = wanted[node]
            x, y, node = x[kept], y[kept], node[kept]
            for j in range(x.shape[1]):
                counted = pd.DataFrame({"node": node, "value": x[:, j], "y": y}).groupby(["node", "value", "y"], sort=False).size().reset_index(name="n")
                value = counted["value"].to_numpy()
                columns = [counted["node"], np.full(len(counted), j), np.searchsorted(cuts[j], value, side="left"), value, counted["y"], counted["n"]]
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "feature", "range", "value", "y", "n"])

    long = rows.mapInArrow(run, "node int, feature int, `range` int, value double, y int, n long")
    sums = [F.coalesce(F.sum(F.when(F.col("y") == k, F.col("n"))), F.lit(0)).alias(f"c{k}") for k in range(classes)]
    return long.groupBy(*KEYS, "range", "value").agg(*sums)


def best_cuts(counts: DataFrame, classes: int, min_leaf: int) -> DataFrame:
    """Per node the cut of least impurity: ``feature``, ``threshold`` and rows per class left of it.

    Of cuts that are equally good (to twelve digits) the one of the first feature, then of the smallest value.
    """
    names = [f"c{k}" for k in range(classes)]
    ranges = counts.groupBy(*KEYS, "range").agg(*[F.sum(c).alias(c) for c in names], F.min("value").alias("least"))
    by_range = Window.partitionBy(*KEYS).orderBy("range")
    before, everything = by_range.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*KEYS)
    ranges = ranges.select(
        *KEYS, "range", F.lead("least").over(by_range).alias("after"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b{c}") for c in names],
        *[F.sum(c).over(everything).alias(f"t{c}") for c in names],
    )
    within = Window.partitionBy(*KEYS, "range").orderBy("value")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    left = [(F.col(f"b{c}") + F.sum(c).over(so_far)).alias(f"l{c}") for c in names]
    cut = counts.join(ranges, [*KEYS, "range"]).select(
        *KEYS, "value", F.coalesce(F.lead("value").over(within), "after").alias("next"), *left, *[f"t{c}" for c in names]
    )

    def total(columns: Sequence[Column]) -> Column:
        return sum(columns[1:], columns[0])

    lefts, rights = [F.col(f"l{c}") for c in names], [F.col(f"t{c}") - F.col(f"l{c}") for c in names]
    n_left, n_right = total(lefts), total(rights)
    purity = total([c.cast("double") * c for c in lefts]) / n_left + total([c.cast("double") * c for c in rights]) / n_right
    tried = cut.where(F.col("next").isNotNull() & (n_left >= min_leaf) & (n_right >= min_leaf))
    # Halves first: the sum of two large values may be beyond the largest number.
    middle = F.col("value") / 2 + F.col("next") / 2
    threshold = F.when(middle < F.col("next"), middle).otherwise(F.col("value"))
    order = F.struct((-F.round(purity / (n_left + n_right), 12)).alias("cost"), "feature", "value", threshold.alias("threshold"), F.array(*lefts).alias("lefts"))
    return tried.groupBy("node").agg(F.min(order).alias("best")).select("node", "best.feature", "best.threshold", "best.lefts")


def _cut_points(rows: DataFrame, inputs: int) -> list[np.ndarray]:
    """Per feature the values that part its ranges, as many as its distinct values ask for."""
    x = [F.col("x")[j] for j in range(inputs)]
    found = rows.agg(*[F.approx_count_distinct(c).alias(f"d{j}") for j, c in enumerate(x)]).first()
    parts = [math.ceil(found[f"d{j}"] / RANGE_VALUES) for j in range(inputs)]
    wide = [j for j in range(inputs) if parts[j] > 1]
    cuts = [np.zeros(0) for _ in range(inputs)]
    if wide:
        shares = {j: [i / parts[j] for i in range(1, parts[j])] for j in wide}
        row = rows.agg(*[F.percentile_approx(x[j], shares[j], 100 * parts[j]).alias(f"q{j}") for j in wide]).first()
        for j in wide:
            cuts[j] = np.unique(row[f"q{j}"])
    return cuts


def fit_exact_tree(
    train: DataFrame, columns: Sequence[str], label: str = "label", max_depth: int | None = None, min_leaf: int = 1
) -> ExactTree:
    """A gini tree over numeric ``columns`` for classes 0, 1, 2 .. in ``label``.

    A node is cut while it is impure, has two parts of ``min_leaf`` rows and, if given, ``max_depth`` is not
    reached, whether or not the cut lowers the impurity. Thresholds lie midway between neighbouring values; equal
    cuts go to the first column, then the smallest value. Rows with a null or not-a-number are left out; no rows
    are an error. The tree itself is held by the driver.
    """
    x, y = F.array(*[F.col(c).cast("double") for c in columns]), F.col(label).cast("double").cast("int")
    known = F.lit(True)
    for c in (*columns, label):
        known = known & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    # Minus zero and zero are one value.
    rows = materialise(train.where(known).select(F.transform(x, lambda v: v + 0.0).alias("x"), y.alias("y")))
    per_class = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not per_class:
        raise ValueError("no rows to grow a tree from")
    classes = max(per_class) + 1
    cuts, tree = _cut_points(rows, len(columns)), ExactTree()
    level = [tree.grow([per_class.get(k, 0) for k in range(classes)], 0)]
    while level:
        level = [n for n in level if max(tree.counts[n]) < sum(tree.counts[n]) >= 2 * min_leaf and (max_depth is None or tree.depth[n] < max_depth)]
        if not level:
            break
        counts = materialise(value_counts(rows, tree, level, cuts, classes))
        grown: list[int] = []
        for r in sorted(best_cuts(counts, classes, min_leaf).collect(), key=lambda r: r["node"]):
            node, left = r["node"], list(r["lefts"])
            tree.feature[node], tree.threshold[node] = r["feature"], r["threshold"]
            tree.left[node] = tree.grow(left, tree.depth[node] + 1)
            tree.right[node] = tree.grow([a - b for a, b in zip(tree.counts[node], left)], tree.depth[node] + 1)
            grown += [tree.left[node], tree.right[node]]
        level = grown
    return tree


def predict_tree(df: DataFrame, tree: ExactTree, columns: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """``df`` with the commonest class of each row's leaf, ties to the lower class; null where an input is null."""
    arrays, common = tree.arrays(), np.array([float(np.argmax(c)) for c in tree.counts])

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=x.index, dtype=object)
        known = x.notna()
        if known.any():
            out[known] = common[places(arrays, np.stack(x[known].to_list()).astype(np.float64))]
        return out.where(known, None)

    values = [F.col(c).cast("double") for c in columns]
    complete = F.lit(True)
    for v in values:
        complete = complete & v.isNotNull()
    return df.withColumn(prediction, run(F.when(complete, F.array(*values))))


def exact_tree_nodes(tree: ExactTree, spark: SparkSession, features: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """One row per node, numbered from the root down its left side first: path, rule, gini, rows, class, children."""
    numbers_of: dict[int, int] = {}
    rows, stack = [], [(0, "")]
    while stack:
        node, path = stack.pop()
        numbers_of[node] = len(numbers_of)
        rows.append((node, path))
        if tree.feature[node] >= 0:
            stack += [(tree.right[node], path + "r"), (tree.left[node], path + "l")]
    table = []
    for node, path in rows:
        inner, counts = tree.feature[node] >= 0, tree.counts[node]
        rule = (features[tree.feature[node]], float(tree.threshold[node])) if inner else (None, None)
        children = (numbers_of[tree.left[node]], numbers_of[tree.right[node]]) if inner else (None, None)
        table.append((numbers_of[node], path, *rule, gini(counts), sum(counts), counts, classes[int(np.argmax(counts))], *children))
    schema = "node int, path string, feature string, threshold double, gini double, samples long, value array<long>, class string, left int, right int"
    return spark.createDataFrame(table, schema)
