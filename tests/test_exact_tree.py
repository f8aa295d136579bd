import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import exact_tree

RNG = np.random.default_rng(8)


def brute(x, y, classes, depth, min_leaf, path=""):
    """Every cut tried, rows split, recursion; {path: (feature, threshold, counts)}."""
    counts = [int((y == k).sum()) for k in range(classes)]
    nodes = {path: (None, None, counts)}
    if max(counts) == len(y) or len(y) < 2 * min_leaf or depth == 0:
        return nodes
    best = None
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for a, b in zip(values, values[1:]):
            low = x[:, j] <= a
            if min(low.sum(), (~low).sum()) < min_leaf:
                continue
            purity = sum(sum(int((y[s] == k).sum()) ** 2 for k in range(classes)) / s.sum() for s in (low, ~low))
            key = (-round(purity / len(y), 12), j, a)
            if best is None or key < best[0]:
                best = key, (a + b) / 2, low
    if best is None:
        return nodes
    nodes[path] = (best[0][1], best[1], counts)
    nodes |= brute(x[best[2]], y[best[2]], classes, depth - 1, min_leaf, path + "l")
    return nodes | brute(x[~best[2]], y[~best[2]], classes, depth - 1, min_leaf, path + "r")


@pytest.fixture(scope="module")
def table(spark):
    x = np.stack([RNG.integers(0, 12, 300), RNG.integers(0, 3, 300), np.round(RNG.normal(size=300), 2)], axis=1).astype(float)
    y = ((x[:, 0] > 5).astype(int) + (x[:, 2] > 0.3) + (RNG.random(300) < 0.1)).clip(0, 2).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(x, y)], "a double, b double, c double, label int").repartition(5).persist()
    return df, x, y


def as_nodes(tree, spark):
    names = ["a", "b", "c"]
    rows = exact_tree.exact_tree_nodes(tree, spark, names, ["0", "1", "2"]).collect()
    return {r["path"]: (names.index(r["feature"]) if r["feature"] else None, r["threshold"], r["value"]) for r in rows}, rows


@pytest.mark.parametrize("depth,leaf,values", [(2, 5, 100_000), (4, 1, 100_000), (3, 7, 4), (30, 20, 9)])
def test_equals_brute_force(spark, table, monkeypatch, depth, leaf, values):
    """Also with ranges of few values, so that cuts lie across their borders."""
    monkeypatch.setattr(exact_tree, "RANGE_VALUES", values)
    df, x, y = table
    got, rows = as_nodes(exact_tree.fit_exact_tree(df, ["a", "b", "c"], max_depth=depth, min_leaf=leaf), spark)
    expected = brute(x, y, 3, depth, leaf)
    assert got.keys() == expected.keys()
    for path, (feature, threshold, counts) in expected.items():
        assert got[path][0] == feature and got[path][2] == counts
        assert got[path][1] == (pytest.approx(threshold) if threshold is not None else None)
    assert [r["node"] for r in rows] == list(range(len(rows)))
    by_node = {r["node"]: r for r in rows}
    assert all(by_node[r["left"]]["path"] == r["path"] + "l" for r in rows if r["left"] is not None)


def test_grown_out_tree_tells_all_rows(table):
    df, x, y = table
    distinct = df.groupBy("a", "b", "c").agg(F.min("label").alias("label"))
    tree = exact_tree.fit_exact_tree(distinct, ["a", "b", "c"])
    wrong = exact_tree.predict_tree(distinct, tree, ["a", "b", "c"]).where("prediction != label").count()
    assert wrong == 0


def test_a_cut_without_gain_is_taken(spark):
    """Exclusive or: no single cut helps, two do."""
    df = spark.createDataFrame([(a, b, a ^ b) for a in (0, 1) for b in (0, 1)] * 3, "a int, b int, label int")
    tree = exact_tree.fit_exact_tree(df, ["a", "b"], max_depth=2)
    assert exact_tree.predict_tree(df, tree, ["a", "b"]).where("prediction = label").count() == 12


def test_odd_rows(spark):
    schema = "a double, label int"
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (None, 1), (float("nan"), 1), (3.0, None), (-0.0, 0), (0.0, 0)], schema)
    tree = exact_tree.fit_exact_tree(df, ["a"])
    assert tree.counts[0] == [3, 1] and tree.threshold[0] == 1.5
    got = exact_tree.predict_tree(df.withColumn("prediction", F.lit("clash")), tree, ["a"]).collect()
    assert [r["prediction"] for r in got if r["a"] is None] == [None]
    assert exact_tree.fit_exact_tree(df.where("label = 1"), ["a"]).feature == [-1]
    with pytest.raises(ValueError):
        exact_tree.fit_exact_tree(df.limit(0), ["a"])
