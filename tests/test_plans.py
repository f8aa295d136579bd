import datetime

import pytest
from pyspark.sql import functions as F

from seriesloom.plans import news_score, next_day, species


def day(n):
    return datetime.date(2021, 1, 1) + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def panel(spark):
    """Two series whose next value is three times today's feature minus the other one."""
    rows = []
    for s in (1, 2):
        x = [(7 * i * i + s) % 23 + 0.0 for i in range(80)]
        z = [(5 * i + s) % 11 + 0.0 for i in range(80)]
        rows += [(s, day(i), 3 * x[i - 1] - z[i - 1] if i else 0.0, x[i], z[i]) for i in range(80)]
    return spark.createDataFrame(rows, "series int, date date, cap double, x double, z double").persist()


@pytest.mark.parametrize("kind", ["ols", "poly"])
def test_forecast_finds_the_rule(panel, kind):
    run = next_day.run(panel, "series", "date", "cap", ["x", "z"], kind)
    scores = {r["split"]: r for r in run.scores.collect()}
    assert scores["train"]["n"] == 118 and scores["test"]["n"] == 40
    assert scores["test"]["r2"] > 0.999999 and scores["test"]["mae"] < 1e-4
    newest = {r["series"]: r for r in panel.where(F.col("date") == day(79)).collect()}
    got = {r["series"]: r for r in run.next_day.collect()}
    for s, row in newest.items():
        assert got[s]["date"] == day(80)
        assert got[s]["prediction"] == pytest.approx(3 * row["x"] - row["z"], abs=1e-3)


@pytest.mark.parametrize("kind", ["lasso", "ridge"])
def test_penalised_forecasts_run(panel, kind):
    scores = {r["split"]: r["r2"] for r in next_day.run(panel, "series", "date", "cap", ["x"], kind).scores.collect()}
    assert scores["train"] > 0.5


def test_imputation(spark, panel):
    score = panel.where("series = 1").select("date", (F.col("x") * 2 - F.col("z")).alias("score"))
    table = panel.where("series = 1")
    known = score.where(F.dayofmonth("date") % 3 != 0).where(F.col("date") != day(79))
    keys, columns = ["series", "date"], ["x", "z"]
    full = news_score.impute_scores(table, known, keys, "date", columns, ["score"])
    assert full.where("score is null").count() == 0 and full.count() == 80
    worst = full.join(score.withColumnRenamed("score", "true"), "date").agg(F.max(F.abs(F.col("score") - F.col("true")))).first()[0]
    assert worst < 1e-6
    none = news_score.impute_scores(table, score.where("false"), keys, "date", columns, ["score"])
    assert none.where("score is null").count() == 80
    every = news_score.impute_scores(table, score, keys, "date", columns, ["score"])
    assert every.select("date", "score").exceptAll(score).count() == 0


def test_corpus_to_scores(spark):
    texts = ["stocks rise stocks grow", "stocks fall markets fall", "markets rise", "!!", "grow stocks rise"] * 6
    docs = spark.createDataFrame([(i, day(i % 7), t) for i, t in enumerate(texts)], "doc_id int, date date, text string")
    right = spark.createDataFrame([("s", 1), ("", 1)], "r string, polarity int")
    corpus = news_score.clean_corpus(docs, "doc_id", "text", right, min_frequency=3).persist()
    assert corpus.count() == 24
    vocabulary = news_score.corpus_vocabulary(corpus, max_df=1.0, min_df=0.0)
    words = news_score.corpus_in_vocabulary(corpus, vocabulary, "doc_id").persist()
    terms = sorted(r["term"] for r in vocabulary.collect())
    assert len(terms) >= 4
    anchors = dict(zip(terms[:3], ["up", "flat", "down"]))
    similar = news_score.similarity_table(words, "doc_id", anchors, size=6).join(docs.select("doc_id", "date"), "doc_id").persist()
    assert similar.where("coverage = 1").count() == 24
    daily = news_score.score_v2(similar, "date", ["up", "flat", "down"])
    assert daily.count() == 7 and daily.where("up is null").count() == 0
    clustered = news_score.score_v1(similar, "date", ["up", "flat", "down"], k=2)
    assert clustered.count() == 7 and clustered.where("score < 0 or score > 1").count() == 0


def test_clean_corpus_cleans_each_text_once(spark):
    docs = spark.createDataFrame([(1, "a!! b?c !! rise-s  %"), (2, "!! ?"), (3, None), (4, "x.y\u3000\uac00z")], "doc_id int, text string")
    right = spark.createDataFrame([("s", 1)], "r string, polarity int")
    corpus = news_score.clean_corpus(docs, "doc_id", "text", right)
    assert {r["doc_id"]: r["tokens"] for r in corpus.collect()} == {1: ["a", "bc", "rise"], 4: ["x.y", "\uac00z"]}
    plan = corpus._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_species(spark):
    rows = [(i, "abc"[i % 3], float(i % 3) * 10 + (i * 7 % 5), float(i * 3 % 7)) for i in range(90)]
    table = spark.createDataFrame(rows, "id int, kind string, w double, l double")
    profile = {r["kind"]: r for r in species.profile_table(table, "kind", ["w"]).collect()}
    assert profile["a"]["share_pct"] == 33.3 and profile["b"]["mean_w"] == pytest.approx(12.0)
    binary = species.binary_rows(table, "kind", "a", "c", ["w", "l"], "id")
    assert binary.count() == 60 and binary.where("split = 'test'").count() == 15
    parts, dictionary = species.multi_rows(table, "kind", ["w", "l"], "id", valid=True)
    assert {r["kind"]: r["label_index"] for r in dictionary.collect()} == {"a": 0, "b": 1, "c": 2}
    assert {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()} == {"test": 23, "valid": 14, "train": 53}


def test_each_score_is_filled_where_it_is_missing(spark, panel):
    table = panel.where("series = 1")
    full = table.select("date", (F.col("x") * 2 - F.col("z")).alias("a"), (F.col("z") + 1).alias("b"))
    known = full.withColumn("b", F.when(F.dayofmonth("date") % 5 != 0, F.col("b"))).where(F.dayofmonth("date") % 3 != 0)
    got = news_score.impute_scores(table, known, ["series", "date"], "date", ["x", "z"], ["a", "b"])
    gap = F.greatest(F.abs(F.col("a") - (F.col("x") * 2 - F.col("z"))), F.abs(F.col("b") - F.col("z") - 1))
    assert got.where("a is null or b is null").count() == 0 and got.agg(F.max(gap)).first()[0] < 1e-6


def test_stages_are_built_once(spark, tmp_path, monkeypatch):
    texts = ["stocks rise stocks grow", "stocks fall markets fall", "markets rise", "grow stocks rise", "tulips bloom"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    right = spark.createDataFrame([("s", 1)], "r string, polarity int")
    calls = []
    clean = news_score.clean_corpus
    monkeypatch.setattr(news_score, "clean_corpus", lambda *a: calls.append(1) or clean(*a))
    monkeypatch.setattr(news_score, "corpus_vocabulary", lambda c: news_score.tfidf.fit_tfidf(c.select(F.array_join("tokens", " ").alias("text")), max_df=1.0, min_df=0.0))
    first, again = (news_score.corpus_stages(spark, str(tmp_path), docs, "doc_id", "text", right, size=4, anchors=None) for _ in range(2))
    assert len(calls) == 1 and sorted(first.collect()) == sorted(again.collect())


def test_dense_layouts_stop_on_the_validation_part(spark):
    rows = [(i, "abc"[i % 3], float(i % 3) * 10 + (i * 7 % 5), float(i * 3 % 7)) for i in range(120)]
    table = spark.createDataFrame(rows, "id int, kind string, w double, l double")
    parts, _ = species.multi_rows(table, "kind", ["w", "l"], "id", valid=True)
    scores, history = species.dense_fits(parts, ["w", "l"], [(4,), ()], rounds=6, patience=2, gain=0.0)
    assert {(r["layout"], r["split"]) for r in scores.collect()} == {(k, s) for k in (1, 2) for s in ("train", "valid", "test")}
    for layout in (1, 2):
        losses = [r for r in history.where(F.col("layout") == layout).orderBy("round").collect()]
        best = min(r["valid_loss"] for r in losses)
        assert [r["valid_loss"] for r in losses if r["is_best"]] == [best]
        assert len(losses) == 6 or losses[-1]["round"] == next(r["round"] for r in losses if r["is_best"]) + 2


def test_dense_queries_train_on_all_orders(spark, monkeypatch):
    from seriesloom.registry import modelling

    seen = []

    def fits(rows, columns):
        seen.append((rows.count(), rows.select("label").distinct().count(), sorted(r[0] for r in rows.select("split").distinct().collect()), columns))
        history = spark.createDataFrame([(1, 1, 0.5, 0.5, True)], "layout int, round int, train_loss double, valid_loss double, is_best boolean")
        return spark.createDataFrame([(1, "test", 1, 0.5)], "layout int, split string, n long, accuracy double"), history

    monkeypatch.setattr(modelling.species, "dense_fits", fits)
    folder = "/root/testdata/sf0.001/"  # a name of its own, since runs are kept by folder
    modelling.dense_network(spark, folder)
    modelling.dense_history(spark, folder)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    want = (orders.count(), orders.select("o_orderstatus").distinct().count(), ["test", "train", "valid"], ["o_totalprice", "month", "year"])
    assert seen == [want]  # trained once, read twice
