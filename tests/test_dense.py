"""The dense trainer: gradients, histories, independence of the partitioning, and known optima."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import dense

RNG = np.random.default_rng(5)


@pytest.mark.parametrize("activation", ["tanh", "relu"])
@pytest.mark.parametrize("loss,outs", [("entropy", 3), ("absolute", 1)])
@pytest.mark.parametrize("hidden", [(), (5,), (6, 4, 3)])
def test_gradient_equals_finite_differences(activation, loss, outs, hidden):
    net = dense.new_net([4, *hidden, outs], activation, loss, 7, np.float64)
    # Away from zero biases, where a unit without input stands on its kink.
    net = dense.DenseNet(net.layers, net.weights + RNG.normal(size=len(net.weights)) * 0.3, activation, loss)
    x = RNG.normal(size=(20, 4))
    y = RNG.integers(0, 3, 20) if loss == "entropy" else RNG.normal(size=20)
    _, gradient = dense.loss_and_gradient(net, x, y)
    for i in range(len(net.weights)):
        sides = []
        for step in (1e-6, -1e-6):
            moved = net.weights.copy()
            moved[i] += step
            sides.append(dense.loss_and_gradient(dense.DenseNet(net.layers, moved, activation, loss), x, y)[0])
        assert gradient[i] == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-4)


@pytest.fixture(scope="module")
def rings(spark):
    """Three classes that no line parts: by distance from the middle."""
    rng = random.Random(2)
    rows = []
    for i in range(900):
        c, turn = i % 3, rng.uniform(0, 6.3)
        r = c + 0.5 + rng.uniform(-0.2, 0.2)
        rows.append((r * np.cos(turn).item(), r * np.sin(turn).item(), c, ("train", "train", "valid", "test")[i // 3 % 4]))
    return spark.createDataFrame(rows, "a double, b double, label int, split string").repartition(5).persist()


def test_classes_that_no_line_parts(spark, rings):
    nets = [dense.new_net([2, *h, 3], "tanh", "entropy", 3) for h in ((), (24, 12))]
    (line, deep), histories = dense.fit_dense_nets(rings, ["a", "b"], nets, rounds=60, batches=2, rate=0.03)

    def accuracy(net):
        hit = (F.col("prediction") == F.col("label")).cast("double")
        return dense.predict_dense(rings.where("split = 'test'"), net, ["a", "b"]).agg(F.avg(hit)).first()[0]

    assert accuracy(deep) > 0.95 > 0.7 > accuracy(line)
    table = dense.history_table(spark, histories).collect()
    assert {r.layout for r in table} == {1, 2} and sum(r.is_best for r in table) == 2
    best = {r.layout: r for r in table if r.is_best}
    assert best[2].valid_loss < 0.3 and all(r.valid_loss >= best[r.layout].valid_loss * (1 - 1e-4) for r in table)
    assert all(max(r.round for r in table if r.layout == k) in (60, best[k].round + 10) for k in (1, 2))
    # The kept weights are those of the best round.
    held = rings.where("split = 'valid'").select("a", "b", "label").toPandas()
    loss, _ = dense.loss_and_gradient(deep, held[["a", "b"]].to_numpy(), held["label"].to_numpy())
    assert loss / len(held) == pytest.approx(best[2].valid_loss, rel=1e-4)


def test_sums_do_not_depend_on_the_tasks(rings, monkeypatch):
    net = dense.new_net([2, 4, 3], "relu", "entropy", 1, np.float64)
    rows = rings.select(F.array("a", "b").alias("x"), F.col("label").cast("double").alias("y"), (F.col("split") == "valid").alias("valid"))
    one = dense.pass_sums(rows.coalesce(1), 1, [net, net])
    monkeypatch.setattr(dense, "FAN_IN", 2)
    many = dense.pass_sums(rows.repartition(9), 9, [net, net])
    assert np.allclose(one[0], many[0]) and np.allclose(one[0], one[1])
    assert one[0][-3] + one[0][-1] == 900


def test_absolute_loss_finds_the_median(spark):
    rows = [(float(g), float(v), "train") for g, values in ((0, range(0, 21)), (1, [5, 5, 6, 40, 100])) for v in values]
    table = spark.createDataFrame(rows, "g double, label double, split string")
    (net,), _ = dense.fit_dense_nets(table, ["g"], [dense.new_net([1, 1], "relu", "absolute", 1)], rounds=60, patience=60, batches=1, rate=1.5, decay=0.1)
    got = {r.g: r.prediction for r in dense.predict_dense(table, net, ["g"]).collect()}
    assert got[0.0] == pytest.approx(10, abs=0.6) and got[1.0] == pytest.approx(6, abs=0.6)


def test_odd_rows(spark):
    schema = "a double, label double, split string"
    net = dense.new_net([1, 2], "tanh", "entropy", 1)
    fitted, history = dense.fit_dense_nets(spark.createDataFrame([], schema), ["a"], [net], rounds=3)
    assert history == [[]] and fitted[0] is net
    odd = spark.createDataFrame([(1.0, 1.0, "train"), (1.0, 1.0, "train"), (None, 1.0, "train"), (2.0, None, "train"), (3.0, 0.0, None), (4.0, 0.0, "test")], schema)
    _, history = dense.fit_dense_nets(odd, ["a"], [net], rounds=2)
    assert len(history[0]) == 2 and history[0][0][1] == history[0][0][2]


def test_the_driver_gets_one_row_of_sums(spark, monkeypatch):
    net = dense.new_net([2, 3, 2], "tanh", "entropy", 1)
    made = [([i / 40, 1 - i / 30], float(i % 2), i % 5 == 0) for i in range(60)]
    rows = spark.createDataFrame(made, "x array<double>, y double, valid boolean")
    taken, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: taken.append(collect(df)) or taken[-1])
    x, y, held = np.array([m[0] for m in made]), np.array([m[1] for m in made]), np.array([m[2] for m in made])
    loss, gradient = dense.loss_and_gradient(net, x[~held], y[~held])
    for tasks in (1, 6, dense.FAN_IN + 4):
        (sums,) = dense.pass_sums(rows.repartition(tasks), tasks, [net])
        assert len(taken[-1]) == 1
        np.testing.assert_allclose(sums[:-4], gradient, rtol=1e-4, atol=1e-5)
        assert sums[-4] == pytest.approx(loss, rel=1e-5) and sums[[-3, -1]].tolist() == [48, 12]


def test_rows_are_packed_and_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(dense, "BLOCK_ROWS", 10)
    monkeypatch.setattr(dense, "OWN_BLOCKS", 2)
    made = [([i / 100, 1 - i / 90], float(i % 3), i % 5 == 0) for i in range(10 * 64)]
    rows = spark.createDataFrame(made, "x array<double>, y double, valid boolean").coalesce(1)
    blocks, tasks = dense._dealt(rows)
    cores = spark.sparkContext.defaultParallelism
    per_task = [len(p) for p in blocks.rdd.glom().collect()]
    assert tasks == len(per_task) == min(max(min(64 // (2 * cores), dense.CORE_TASKS), 1) * cores, 64)
    assert max(per_task) - min(per_task) <= 1
    found = [(list(x), y, v) for r in blocks.collect() for x, y, v in zip(np.frombuffer(r.x).reshape(-1, 2), np.frombuffer(r.y), np.frombuffer(r.valid, dtype=bool))]
    assert sorted(found) == sorted(made) and {len(r.valid) for r in blocks.collect()} == {10}
    net = dense.new_net([2, 3, 3], "tanh", "entropy", 1, np.float64)
    assert np.allclose(dense.pass_sums(blocks, tasks, [net])[0], dense.pass_sums(rows, 1, [net])[0])
    blocks.unpersist()
    odd = dense.packed(rows.limit(23).coalesce(1)).collect()
    assert [len(r.valid) for r in odd] == [10, 10, 3]
    assert dense._dealt(rows.limit(0))[0].count() == 0


@pytest.mark.parametrize("activation", ["tanh", "relu"])
def test_a_room_changes_no_bit(activation):
    room = dense.Room()
    for hidden, n in (((6, 4), 20), ((9,), 33), ((6, 4), 7)):
        net = dense.new_net([4, *hidden, 3], activation, "entropy", 7)
        x, y = RNG.normal(size=(n, 4)), RNG.integers(0, 3, n)
        for (loss, gradient), (alone, fresh) in ((dense.loss_and_gradient(net, x, y, room), dense.loss_and_gradient(net, x, y)),):
            assert loss == alone and (gradient == fresh).all()


def test_all_networks_predict_in_one_pass(spark, rings):
    nets = [dense.new_net([2, *h, 3], "tanh", "entropy", k) for k, h in enumerate(((4,), (), (5, 3)))]
    odd = rings.union(spark.createDataFrame([(None, 1.0, 0, "test")], rings.schema))
    names = ["p0", "p1", "p2"]
    together = dense.predict_dense(odd, nets, ["a", "b"], names)
    assert dense.predict_dense(rings, nets, ["a", "b"], names)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    for k, net in enumerate(nets):
        alone = dense.predict_dense(odd, net, ["a", "b"])
        assert alone.groupBy("a", "b", "prediction").count().exceptAll(together.groupBy("a", "b", F.col(f"p{k}")).count()).count() == 0
        x = np.array([[r.a, r.b] for r in rings.collect()])
        assert [r[f"p{k}"] for r in together.where("a is not null").collect()] == dense.outputs(net, x)[-1].argmax(axis=1).tolist()
    assert together.where("a is null").select(*names).first() == (None, None, None)
    assert dense.predict_dense(odd.limit(0), net, ["a", "b"]).count() == 0
