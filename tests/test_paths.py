import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from seriesloom.operators import classify, pairwise, paths, regress, sums, sweeps

RNG = np.random.default_rng(5)
X = RNG.normal(size=(200, 3)) * [1.0, 2.0, 0.5] + [1e4, 0.0, -3.0]
Y = (X - X.mean(0)) @ [3.0, -1.0, 0.0] + 1e5 + RNG.normal(size=200) * 0.3
SPLIT = ["test" if i % 4 == 0 else "train" for i in range(200)]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(Vectors.dense(x), float(y), s) for x, y, s in zip(X, Y, SPLIT)]
    return spark.createDataFrame(data, ["features", "label", "split"]).repartition(5).persist()


def test_moments(rows):
    found = paths.split_moments(rows, 2)
    for name, m in found.items():
        x, y = X[np.array(SPLIT) == name], Y[np.array(SPLIT) == name]
        z = np.stack([*(x[:, t].prod(axis=1) for t in map(list, paths.products(3, 2))), y], axis=1)
        assert m.rows == len(x) and np.allclose(m.mean, z.mean(0), rtol=1e-12)
        assert np.allclose(m.scatter, (z - z.mean(0)).T @ (z - z.mean(0)), rtol=1e-6, atol=1e-3)


def test_alpha_paths_equal_the_fits(rows):
    for penalty, fit in (("absolute", regress.fit_lasso), ("squared", regress.fit_ridge)):
        alphas = (0.01, 0.5, 10.0)
        got = {r["alpha"]: r for r in paths.alpha_path(rows, alphas, penalty).collect()}
        for r in sweeps.sweep_alpha(rows, alphas, fit).collect():
            assert got[r["alpha"]]["train_score"] == pytest.approx(r["train_score"], abs=1e-6)
            assert got[r["alpha"]]["test_score"] == pytest.approx(r["test_score"], abs=1e-6)
            assert got[r["alpha"]]["log_alpha"] == r["log_alpha"]


def test_lasso_conditions(rows):
    train = paths.split_moments(rows)["train"]
    for alpha, w in zip((0.001, 0.3, 2.0, 1e6), paths.lasso_path(train, (0.001, 0.3, 2.0, 1e6))):
        slope = (train.scatter[:-1, -1] - train.scatter[:-1, :-1] @ w) / train.rows
        for g, v in zip(slope, w):
            assert abs(g - alpha * np.sign(v)) < 1e-6 if v else abs(g) <= alpha + 1e-6
    assert not w.any()


def test_degree_path_equals_the_fits(spark):
    x = RNG.normal(size=(150, 2))
    y = x[:, 0] ** 2 - x[:, 0] * x[:, 1] + RNG.normal(size=150) * 0.1
    data = [(Vectors.dense(a), float(b), SPLIT[i]) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, ["features", "label", "split"])
    got = paths.degree_path(df, (1, 2, 3)).orderBy("degree").collect()
    fits = sweeps.sweep_degree(df, lambda t, f: regress.fit_ols(t, f), (1, 2, 3)).orderBy("degree").collect()
    for a, b in zip(got, fits):
        assert a["train_score"] == pytest.approx(b["train_score"], abs=1e-8) and a["test_score"] == pytest.approx(b["test_score"], abs=1e-8)


def test_odd_rows(spark, rows):
    nulls = rows.union(spark.createDataFrame([(None, 1.0, "train"), (Vectors.dense([1.0, 2.0, 3.0]), None, "test"), (Vectors.dense([1.0, 2.0, 3.0]), 1.0, None)], rows.schema))
    assert paths.split_moments(nulls)["train"].rows == paths.split_moments(rows)["train"].rows
    constant = rows.withColumn("label", F.lit(2.0))
    assert paths.alpha_path(constant, (1.0,)).first()["train_score"] is None
    with pytest.raises(ValueError):
        paths.alpha_path(rows.limit(0))
    only = paths.alpha_path(rows.where("split = 'train'"), (1.0,)).first()
    assert only["test_score"] is None and only["train_score"] is not None


def test_sums_are_merged_by_tasks(spark):
    df = spark.range(0, 1000, 1, 70).select(F.col("id").cast("double").alias("v"))

    def add(total, batch):
        total[0] += batch.column(0).to_numpy().sum()

    assert sums.summed(df, add, 1)[0] == 499500
    with pytest.raises(ValueError):
        sums.summed(df, add, sums.MAX_NUMBERS + 1)


def hinge(w, b, x, y, c):
    return 0.5 * w @ w + c * np.maximum(0, 1 - y * (x @ w + b)).sum()


def test_all_pairs_are_at_their_minimum(spark):
    centres, rng = {0: (0, 0), 1: (2, 1), 3: (0, 2.5)}, np.random.default_rng(6)
    data = [(Vectors.dense(rng.normal(size=2) + m), k) for k, m in centres.items() for _ in range(80)]
    df = spark.createDataFrame(data, ["features", "label"]).repartition(3).persist()
    models = pairwise.fit_all_pairs(df)
    assert sorted(models) == [(0, 1), (0, 3), (1, 3)]
    single = classify.fit_one_vs_one(df)
    for (low, high), m in models.items():
        x = np.array([r[0].toArray() for r in data_of(df, low, high)])
        y = np.array([1.0 if r[1] == high else -1.0 for r in data_of(df, low, high)])
        w, b = np.array(m.coefficients), m.intercept
        best = hinge(w, b, x, y, 1.0)
        other = single[low, high]
        assert best <= hinge(np.array(other.coefficients), other.intercept, x, y, 1.0) + 1e-3
        for _ in range(300):
            assert hinge(w + rng.normal(size=2) * 0.02, b + rng.normal() * 0.02, x, y, 1.0) > best - 1e-3
    # Both fits have the same minimum, so they decide alike but for rows on the border.
    both = classify.predict_one_vs_one(classify.predict_one_vs_one(df, models), single, prediction="other")
    assert both.where("prediction = other").count() >= 0.98 * 240


def data_of(df, low, high):
    return [(r["features"], r["label"]) for r in df.where(F.col("label").isin(low, high)).collect()]


def test_all_pairs_takes_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(7)
    data = [(Vectors.dense(rng.normal(size=2) + [k, 0]), k) for k in range(5) for _ in range(40)]
    df = spark.createDataFrame(data, ["features", "label"]).coalesce(2).persist()
    calls = []
    monkeypatch.setattr(pairwise, "summed", lambda *a: calls.append(1) or sums.summed(*a))
    assert len(pairwise.fit_all_pairs(df)) == 10 and len(calls) < 100
    assert pairwise.fit_all_pairs(df.limit(0)) == {}


def test_all_pairs_read_blocks_of_rows(spark, monkeypatch):
    """A pass reads a few blocks of numbers; the rows themselves are read once."""
    data = [(Vectors.dense([float(i % 7), float(i % 5)]), i % 3) for i in range(600)]
    df = spark.createDataFrame(data, ["features", "label"]).coalesce(1).persist()
    seen = []
    monkeypatch.setattr(pairwise, "summed", lambda rows, *a: seen.append(rows.count()) or sums.summed(rows, *a))
    pairwise.fit_all_pairs(df)
    assert set(seen) == {3}
