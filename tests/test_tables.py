import datetime
import random

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import lookup, profile, relational, series
from seriesloom.operators.lookup import fits_broadcast, lookup_join, salted_join, word_lookup


def day(n):
    return datetime.date(2021, 1, 1) + datetime.timedelta(days=n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, how):
    facts = [("hot", i) for i in range(400)] + [(f"k{i}", i) for i in range(300)] + [(None, i) for i in range(50)]
    facts = spark.createDataFrame(facts, "k string, i int")
    dim = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 400, 3)], "k string, v double")
    salted = salted_join(facts, dim, "k", how, ["i"], partitions=7)
    assert rows(salted) == rows(facts.join(dim, "k", how))


def test_salted_join_spreads_the_hot_key(spark):
    facts = spark.range(5000).select(F.lit("hot").alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1)], "k string, v int")
    # A join without broadcast keeps its rows in the partitions the salt gave them.
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = salted_join(facts, dim, "k", "inner", ["id"], partitions=64).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(p["count"] for p in parts) == 5000
    assert len(parts) == 4 and max(p["count"] for p in parts) < 2500


def test_a_key_above_a_mean_partition_is_hot(spark):
    """Below a thousandth of all rows, but more than a partition's worth."""
    facts = spark.range(20_000).select(F.when(F.col("id") < 15, F.lit("warm")).otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    dim = spark.createDataFrame([("warm", 1)], "k string, v int")
    plan = salted_join(facts, dim, "k", "inner", ["id"], partitions=4000)
    assert plan.count() == 15
    assert salted_join(facts, dim, "k", "left", ["id"], partitions=4000).count() == 20_000
    salts = salted_join(facts.where("k = 'warm'"), dim, "k", "inner", ["id"], partitions=5)
    assert salts.count() == 15


def test_label_index_broadcasts_the_dictionary(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("c"), F.col("id") % 7).alias("c"))
    from seriesloom.operators.prepare import label_dictionary

    indexed = relational.label_index(df, label_dictionary(df, "c", "id"), "c")
    plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert indexed.where("label_index = id % 7").count() == 1000


def test_names_from_a_table(spark):
    names = spark.createDataFrame([("b",), ("a",), ("b",)], "n string")
    got = relational.every_pairing(spark.range(2).withColumnRenamed("id", "x"), names, "press")
    assert rows(got) == [(0, "a"), (0, "b"), (1, "a"), (1, "b")]


def test_lookup_paths_agree(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "c c"), (3, "")], "doc_id int, text string")
    dim = spark.createDataFrame([("a", 1), ("c", 3)], "w string, v int")
    words = F.split("text", " ")
    small = word_lookup(docs, "doc_id", words, dim, "w", "left")
    large = word_lookup(docs, "doc_id", words, dim, "w", "left", max_rows=1)
    assert rows(small) == rows(large) and small.count() == 7
    facts = small.select("doc_id", "pos", "w")
    assert rows(lookup_join(facts, dim, "w", "inner", ["doc_id", "pos"])) == rows(
        lookup_join(facts, dim, "w", "inner", ["doc_id", "pos"], max_rows=1)
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_common_words_of_a_large_lookup_do_not_move(spark, monkeypatch, how):
    """Only words that are not among the commonest are shuffled, in the lookup or not."""
    docs = spark.createDataFrame([(i, ["in", "out", None, f"rare{i}", f"own{i}"] * 3) for i in range(40)], "doc_id int, words array<string>")
    dim = spark.createDataFrame([("in", 1)] + [(f"rare{i}", i) for i in range(40)], "w string, v int")
    moved = []
    monkeypatch.setattr(lookup, "salted_join", lambda facts, *a: moved.append(facts.count()) or salted_join(facts, *a))
    want = rows(word_lookup(docs, "doc_id", F.col("words"), dim, "w", how))
    monkeypatch.setattr(lookup, "COMMON_ROWS", 20)
    assert rows(word_lookup(docs, "doc_id", F.col("words"), dim, "w", how, max_rows=1)) == want
    assert moved == [40 * 9]
    monkeypatch.setattr(lookup, "COMMON_ROWS", 0)
    assert rows(word_lookup(docs, "doc_id", F.col("words"), dim, "w", how, max_rows=1)) == want


def test_fits_broadcast_counts_rows_and_bytes(spark):
    dim = spark.createDataFrame([("x" * 1000, [1.0, 2.0])] * 10, "w string, v array<double>")
    assert fits_broadcast(dim)
    assert not fits_broadcast(dim, max_rows=9)
    assert not fits_broadcast(dim, max_bytes=10_000)


def literal_batches(dates):
    """Newest first: take a day, then up to four more while each is one day earlier."""
    out, i = [], 0
    while i < len(dates):
        batch = [dates[i]]
        i += 1
        while i < len(dates) and len(batch) < 5 and (batch[-1] - dates[i]).days == 1:
            batch.append(dates[i])
            i += 1
        out.append((batch[-1], batch[0], len(batch)))
    return out


def test_consecutive_batches(spark):
    rng = random.Random(5)
    calendars = {"runs": [0, 2, 3, 4, 5, 6] + list(range(20, 26)) + list(range(40, 51))}
    for k in range(4):
        calendars[f"r{k}"] = sorted(rng.sample(range(120), 70))
    data = [(s, day(n)) for s, days in calendars.items() for n in days]
    rng.shuffle(data)
    got = series.consecutive_batches(spark.createDataFrame(data, "series string, date date"), "series", "date")
    want = [(s, *b) for s, days in calendars.items() for b in literal_batches([day(n) for n in sorted(days, reverse=True)])]
    assert rows(got) == sorted(want, key=str)


def test_next_day_label_and_chart(spark):
    panel = spark.createDataFrame([("a", day(0), 1.0), ("a", day(3), 2.0), ("a", day(4), 4.0), ("b", day(1), 9.0)], "series string, date date, cap double")
    labelled = series.labelled_rows(panel, "series", "date", "cap")
    assert rows(labelled) == [("a", day(0), 1.0, 2.0, day(3)), ("a", day(3), 2.0, 4.0, day(4))]
    predicted = labelled.withColumn("prediction", F.col("cap") * 10)
    assert rows(series.actual_and_predicted(predicted, "series", "date", "cap", limit=1)) == [("a", day(4), 4.0, 20.0)]
    assert rows(series.actual_and_predicted(predicted, "series", "date", "cap", as_plotted=True))[0] == ("a", day(0), 1.0, 10.0)
    assert rows(relational.latest_row(panel, "series", "date")) == [("a", day(5), 4.0), ("b", day(2), 9.0)]


def test_fill_merge_and_index(spark):
    left = spark.createDataFrame([(1, None, 5.0), (2, 3.0, None), (3, None, None)], "id int, a double, b double")
    right = spark.createDataFrame([(1, 7.0, 8.0), (2, 7.0, 8.0)], "id int, a double, b double")
    assert rows(relational.fill_from(left, right, ["id"], ["a", "b"])) == [(1, 7.0, 5.0), (2, 3.0, 8.0), (3, None, None)]
    nouns = spark.createDataFrame([("x", 0.5), ("y", 0.4)], "token string, score double")
    cohesion = spark.createDataFrame([("y", 0.25), ("z", 0.125)], "token string, score double")
    assert rows(relational.merge_score_tables(nouns, cohesion)) == [("x", 0.5), ("y", 0.65), ("z", 0.125)]
    named = spark.createDataFrame([("KBS",), ("other",), (None,)], "press string")
    assert {r["press"]: r["i"] for r in relational.fixed_index(named, ["A", "KBS"], "press", "i").collect()} == {"KBS": 1, "other": None, None: None}
    assert rows(relational.every_pairing(named.where("press = 'KBS'"), ["p", "q"], "name")) == [("KBS", "p"), ("KBS", "q")]


def test_nulls_and_slices(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0), (3, "a", None)], "id int, c string, v double")
    assert rows(relational.complete_rows(df)) == [(1, "a", 2.0)]
    assert rows(relational.missing_rows(df, "v")) == [(3, "a", None)]
    assert rows(relational.class_slice(df, "c", "a", ["id"])) == [(1,), (3,)]
    assert relational.drop_columns(df, "c").columns == ["id", "v"]
    assert [r["id"] for r in relational.first_rows(df, [F.desc("id")], 2).collect()] == [3, 2]
    union = relational.labelled_union({1: df.select("id"), 0: df.select("id")})
    assert union.where("label = 1").count() == 3 and union.count() == 6


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 9.99, 10, 5]], "v double")
    assert [r["n"] for r in profile.histogram(df, "v", 10).orderBy("bin").collect()] == [1, 2, 0, 0, 0, 1, 0, 0, 0, 2]
    flat = profile.histogram(df.where("v = 1"), "v", 10).orderBy("bin").collect()
    assert sum(r["n"] for r in flat) == 2 and flat[0]["bin_low"] == 0.5


def test_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "c string, v double")
    assert rows(profile.class_share(df, "c")) == [("a", 2, 66.7), ("b", 1, 33.3)]
    assert rows(profile.class_means(df, "c", ["v"])) == [("a", 2.0), ("b", 5.0)]
    assert profile.mean_and_std(df, ["v"]).first()["std_v"] == pytest.approx((8 / 3) ** 0.5)
    scored = spark.createDataFrame([(day(0), 1.0, None), (day(0), 3.0, 4.0)], "date date, up double, down double")
    assert rows(profile.daily_means(scored, "date", ["up", "down"])) == [(day(0), 2.0, 4.0)]
