import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from seriesloom.operators import classify, cluster, evaluate, prepare, regress, sweeps

RNG = np.random.default_rng(11)
X = RNG.normal(size=(120, 3)) * [1.0, 2.0, 0.5]
Y = X @ [3.0, -1.0, 0.0] + 4 + RNG.normal(size=120) * 0.1
SPLIT = ["test" if i % 4 == 0 else "train" for i in range(120)]


@pytest.fixture(scope="module")
def line(spark):
    rows = [(Vectors.dense(x), float(y), s) for x, y, s in zip(X, Y, SPLIT)]
    return spark.createDataFrame(rows, ["features", "label", "split"]).coalesce(1).persist()


def closed_form(alpha):
    xc, yc = X - X.mean(0), Y - Y.mean()
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)


def test_least_squares_and_ridge(line):
    assert np.allclose(regress.fit_ols(line).coefficients, closed_form(0), atol=1e-8)
    ridge = regress.fit_ridge(line, 5.0)
    assert np.allclose(ridge.coefficients, closed_form(5.0), atol=1e-8)
    assert ridge.intercept == pytest.approx(Y.mean() - X.mean(0) @ closed_form(5.0))


def test_lasso_is_at_its_minimum(line):
    model = regress.fit_lasso(line, 0.3)
    w = np.array(model.coefficients)
    residual = Y - X @ w - model.intercept
    gradient = -(X - X.mean(0)).T @ residual / len(Y)
    for g, c in zip(gradient, w):
        assert abs(g + 0.3 * np.sign(c)) < 1e-5 if c else abs(g) <= 0.3 + 1e-5
    assert w[2] == 0


def test_targets(spark):
    df = prepare.assemble(spark.createDataFrame([(float(i), 2.0 * i + 1, -3.0 * i) for i in range(9)], "x double, a double, b double"), ["x"])
    models = regress.fit_ols_per_target(df, ["a", "b"])
    assert models["a"].coefficients[0] == pytest.approx(2) and models["b"].coefficients[0] == pytest.approx(-3)
    assert {"predicted_a", "predicted_b"} <= set(regress.predict_targets(df, models).columns)


def test_boosting_stops(spark, line):
    train, valid = line.where("split = 'train'"), line.where("split = 'test'")
    model, history = regress.fit_boosted_mae(train, valid, max_iter=8, patience=2, depth=2)
    rows = history.orderBy("round").collect()
    losses = [r["valid_loss"] for r in rows]
    best = next(r["round"] for r in rows if r["is_best"])
    assert losses[best - 1] == min(losses) and model.getNumTrees == best
    assert len(rows) == 8 or len(rows) == best + 2


def test_first_trees_equal_a_shorter_run(line):
    train = line.where("split = 'train'")

    def grown(rounds):
        return GBTRegressor(lossType="absolute", maxIter=rounds, maxDepth=2, seed=1).fit(train)

    short, cut = grown(3), regress.first_trees(grown(7), 3)
    assert cut.getNumTrees == 3
    predicted = short.transform(line).select("label", F.col("prediction").alias("own"), "features")
    both = cut.transform(predicted).select("own", "prediction").collect()
    assert len(both) == line.count() and all(r.own == r.prediction for r in both)


def test_scores(spark):
    df = spark.createDataFrame([("a", 1.0, 1.5), ("a", 3.0, 2.5), ("b", 2.0, 2.0)], "split string, label double, prediction double")
    got = {r["split"]: (r["n"], r["r2"], r["mae"]) for r in evaluate.regression_scores(df).collect()}
    assert got == {"a": (2, 0.75, 0.5), "b": (1, None, 0.0)}
    hits = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 1.0)], "split string, label int, prediction double")
    assert evaluate.accuracy_scores(hits).first()["accuracy"] == 0.5


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(2)
    rows = [(float(c * 3 + rng.gauss(0, 0.6)), float((c % 2) * 4 + rng.gauss(0, 0.6)), c, "test" if i % 4 == 0 else "train") for i in range(60) for c in (0, 1, 2)]
    df = spark.createDataFrame(rows, "x double, y double, c int, split string")
    return classify.with_features(df, ["x", "y"], "c").coalesce(1).persist()


def test_linear_svc_objective(blobs):
    two = blobs.where("c < 2")
    model = classify.fit_linear_svc(two)
    x = np.array([r[0] for r in two.select(vector_to_array("features")).collect()])
    y = np.array([r["label"] for r in two.select("label").collect()]) * 2 - 1

    def objective(w, b):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w + b)).sum()

    w, b = np.array(model.coefficients), model.intercept
    best = objective(w, b)
    for _ in range(500):
        assert objective(w + RNG.normal(size=2) * 0.05, b + RNG.normal() * 0.05) > best - 1e-2
    margins = classify.margins(model.transform(two), ["x", "y"], model)
    for r in margins.select("margin", vector_to_array("rawPrediction").alias("raw")).limit(20).collect():
        assert r["margin"] == pytest.approx(r["raw"][1])


def test_multi_class(blobs):
    train = blobs.where("split = 'train'")
    models = classify.fit_one_vs_one(train, [0, 1, 2], max_iter=10)
    assert sorted(models) == [(0, 1), (0, 2), (1, 2)]
    predicted = classify.predict_one_vs_one(blobs, models)
    assert min(r["accuracy"] for r in evaluate.accuracy_scores(predicted).collect()) > 0.9
    for fit in (lambda t: classify.fit_one_vs_rest(t, max_iter=10), lambda t: classify.fit_softmax(t, max_iter=20), lambda t: classify.fit_dense(t, 2, 3, [5], 30)):
        assert min(r["accuracy"] for r in evaluate.accuracy_scores(fit(train).transform(blobs)).collect()) > 0.6


def test_votes_tie_to_the_lower_class(spark):
    w = classify.LinearWeights
    cycle = {(0, 1): w([0.0], 1.0), (1, 2): w([0.0], 1.0), (0, 2): w([0.0], -1.0)}
    df = spark.createDataFrame([(Vectors.dense([1.0]),)], ["features"])
    assert classify.predict_one_vs_one(df, cycle).first()["prediction"] == 0.0


def test_tree_as_rows(spark, blobs):
    model = classify.fit_tree(blobs, 3, 6)
    nodes = {r["node"]: r for r in classify.tree_nodes(model, spark, ["x", "y"], ["zero", "one", "two"]).collect()}
    root = nodes[0]
    assert root["samples"] == 180 and root["value"] == [60, 60, 60] and root["gini"] == pytest.approx(2 / 3)
    for node in nodes.values():
        assert node["samples"] == sum(node["value"]) >= 6
        assert node["gini"] == pytest.approx(1 - sum((v / node["samples"]) ** 2 for v in node["value"]))
        if node["left"] is not None:
            assert nodes[node["left"]]["samples"] + nodes[node["right"]]["samples"] == node["samples"]
            assert node["feature"] in ("x", "y") and node["threshold"] is not None
        else:
            assert node["feature"] is None and node["right"] is None


def test_margin_grid(spark):
    got = classify.margin_grid(spark, ((0.0, 1.0), (2.0, 3.0)), classify.LinearWeights([1.0, 10.0], 0.5), ["a", "b"], steps=3)
    values = {(r["a"], r["b"]): r["margin"] for r in got.collect()}
    assert len(values) == 9 and values[(0.5, 3.0)] == 31.0 and values[(0.0, 2.0)] == 20.5


def test_clusters(spark):
    rng = random.Random(4)
    rows = [(c, float(u + rng.gauss(0, 0.05)), float(d + rng.gauss(0, 0.05))) for c, (u, d) in enumerate([(0, 1), (0.5, 0.5), (1, 0)]) for _ in range(30)]
    df = prepare.assemble(spark.createDataFrame(rows, "c int, up double, down double"), ["up", "down"]).persist()
    model = cluster.fit_kmeans(df, 3, seed=1)
    scored = cluster.cluster_scores(df, model, 0, 1)
    assert scored.where("score = c").count() == 90
    step = cluster.lloyd_step(df, ["up", "down"], model.clusterCenters())
    for r in step.collect():
        assert (r["centre_up"], r["centre_down"]) == pytest.approx(tuple(model.clusterCenters()[r["cluster"]]), abs=1e-3)


def test_sweeps(line, blobs):
    degree = sweeps.sweep_degree(line, lambda t, f: regress.fit_ols(t, f), (1, 2)).collect()
    assert [r["degree"] for r in degree] == [1, 2] and all(r["train_score"] > 0.99 for r in degree)
    alpha = sweeps.sweep_alpha(line, (0.01, 10.0)).collect()
    assert [round(r["log_alpha"]) for r in alpha] == [-2, 1] and alpha[0]["test_score"] > alpha[1]["test_score"]
    tree = sweeps.sweep_tree(blobs.select("features", "label", "split"), (1, 3), (1, 4)).collect()
    assert [(r["max_depth"], r["min_leaf"]) for r in tree] == [(1, 1), (1, 4), (3, 1), (3, 4)]
    assert tree[2]["train_score"] > tree[0]["train_score"]
