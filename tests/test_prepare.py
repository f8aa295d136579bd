import datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seriesloom.operators import prepare, split

# Rows per class of the measurement table, in order of first appearance, and the split they must give.
SIZES = [35, 20, 6, 11, 56, 17, 14]
TRAIN = [26, 15, 5, 8, 42, 13, 10]
TRAIN_OF_TRAIN = [21, 12, 4, 6, 34, 10, 8]


@pytest.fixture(scope="module")
def classes(spark):
    rows = [(f"c{c}-{i}", c) for c, n in enumerate(SIZES) for i in range(n)]
    return spark.createDataFrame(rows, "key string, label int").persist()


def counts(df, part):
    by = {r["label"]: r["count"] for r in df.where(F.col("split") == part).groupBy("label").count().collect()}
    return [by.get(c, 0) for c in range(len(SIZES))]


def test_stratified_sizes(classes):
    parts = split.stratified_split(classes, "key", "label", 346672)
    assert counts(parts, "train") == TRAIN
    three = split.three_way_split(classes, "key", 346672, "label")
    assert counts(three, "train") == TRAIN_OF_TRAIN
    assert counts(three, "test") == [n - t for n, t in zip(SIZES, TRAIN)]
    assert three.count() == three.select("key").distinct().count() == sum(SIZES)


@pytest.mark.parametrize("n, test", [(1, 1), (4, 1), (5, 2), (159, 40), (1000, 250)])
def test_exact_sizes(spark, n, test):
    parts = split.exact_split(spark.range(n), "id", 7)
    assert parts.where("split = 'test'").count() == test
    assert parts.count() == n
    again = split.exact_split(spark.range(n).repartition(5), "id", 7)
    assert parts.exceptAll(again).count() == 0


def test_split_with_a_full_prefix(spark):
    """With one hash digit many rows share a prefix; the cut is exact with and without longer prefixes."""
    usual = split.exact_split(spark.range(999), "id", 7).persist()
    assert split.exact_split(spark.range(999), "id", 7, digits=1).exceptAll(usual).count() == 0
    assert split.exact_split(spark.range(999), "id", 7, digits=1, bucket_rows=5).exceptAll(usual).count() == 0


def test_strata_with_a_full_prefix(classes):
    usual = split.stratified_split(classes, "key", "label", 7)
    assert split.stratified_split(classes, "key", "label", 7, digits=1, bucket_rows=1).exceptAll(usual).count() == 0


def test_threshold_split_is_close(spark):
    n = split.threshold_split(spark.range(20000), "id", 7).where("split = 'test'").count()
    assert 4700 < n < 5300


def test_single_row_class(spark):
    df = spark.createDataFrame([(f"k{i}", int(i > 0)) for i in range(9)], "key string, label int")
    parts = split.stratified_split(df, "key", "label", 1)
    assert parts.where("split = 'test'").count() == 3


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (8.0, 5.0)], "a double, b double")
    z = prepare.fit_zscore(df, ["a", "b"])
    got = z.transform(df).collect()
    assert [r["a"] for r in got] == pytest.approx([-3 / 8.666666**0.5, -1 / 8.666666**0.5, 4 / 8.666666**0.5], abs=1e-5)
    assert [r["b"] for r in got] == [0.0, 0.0, 0.0]
    m = prepare.fit_minmax(df.limit(2), ["a", "b"])
    assert [r["a"] for r in m.transform(df).collect()] == [0.0, 1.0, 3.5]
    assert m.transform(df).first()["b"] == 0.0


@pytest.mark.parametrize("degree, terms", [(1, 10), (2, 65), (3, 285)])
def test_polynomial_size(spark, degree, terms):
    df = spark.createDataFrame([tuple(float(i + 2) for i in range(10))], ", ".join(f"x{i} double" for i in range(10)))
    table, names = prepare.polynomial_columns(df, df.columns, degree)
    assert len(names) == terms and table.select(*names).first()[-1] == 11.0**degree


def test_label_dictionary_and_one_hot(spark):
    days = [datetime.date(2021, 1, d) for d in (5, 3, 4, 3)]
    df = spark.createDataFrame(list(zip(days, ["c", "b", "a", "b"])), "day date, label string").repartition(4)
    found = prepare.label_dictionary(df, "label", "day")
    assert {r["label"]: r["label_index"] for r in found.collect()} == {"b": 0, "a": 1, "c": 2}
    hot = prepare.one_hot(found, "label_index").select(vector_to_array("one_hot").alias("v"))
    assert sorted(r["v"] for r in hot.collect()) == [[0, 0, 1], [0, 1, 0], [1, 0, 0]]


def test_null_feature_is_an_error(spark):
    with pytest.raises(Exception):
        prepare.assemble(spark.createDataFrame([(None,)], "a double"), ["a"]).collect()
