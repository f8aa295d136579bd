from pyspark.sql import functions as F

from seriesloom.operators.vectors import train_word_vectors
from seriesloom.session import spread
from seriesloom.sources import readers, schemas, store
from seriesloom.streaming import ingest


def test_csv_with_mark_and_missing_values(spark, tmp_path):
    path = tmp_path / "measurements.csv"
    # Fixed value: the header must match.
    header = "Species,Weight,Length1,Length2,Length3,Height,Width"
    path.write_text(f"\ufeff{header}\nalpha,100,1.5,2.5,3.5,4.5,5.5\nbeta,,1,NaN,3,4,5\n", encoding="utf-8")
    rows = readers.read_measurements(spark, str(path)).collect()
    assert rows[0]["Species"] == "alpha" and rows[0]["Weight"] == 100.0
    assert rows[1]["Weight"] is None and rows[1]["Length2"] is None and rows[1]["Width"] == 5.0


def test_daily_table(spark, tmp_path):
    path = tmp_path / "daily.csv"
    path.write_text("day,cap,f1\n2021/9/4,10,1\n2021/09/03,9,2\n")
    rows = readers.read_daily(spark, str(path), "day", "cap", ["f1"]).orderBy("day").collect()
    assert [str(r["day"]) for r in rows] == ["2021-09-03", "2021-09-04"] and rows[1]["cap"] == 10.0


def test_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    path = str(tmp_path / "t")
    assert store.read_or_build(spark, path, build).count() == 5
    assert store.read_or_build(spark, path, build).count() == 5
    assert len(calls) == 1


def test_unfinished_table_is_built_again(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "part-0.parquet").write_text("torn")
    assert store.read_or_build(spark, str(path), lambda: spark.range(3)).count() == 3


def test_append_new(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "url string, n int")
    store.append_new(spark, batch, path, "url")
    store.append_new(spark, spark.createDataFrame([("b", 9), ("c", 3)], "url string, n int"), path, "url")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 2), ("c", 3)]


def articles(spark, *urls):
    return spark.createDataFrame([("2021.09.24.", u, "KBS", "t", "s") for u in urls], schemas.ARTICLES)


def test_stream_ingest(spark, tmp_path):
    incoming, path, offsets = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run():
        ingest.ingest_articles(spark, incoming, path, offsets, schemas.ARTICLES, files_per_batch=1).awaitTermination()
        return sorted(r["url"] for r in ingest.read_store(spark, path).collect())

    store.write_table(articles(spark, "a", "b", "a").coalesce(1), incoming, mode="append")
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    store.write_table(articles(spark, "b", "c").coalesce(1), incoming, mode="append")
    assert run() == ["a", "b", "c"]


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    incoming, path = str(tmp_path / "in"), str(tmp_path / "out")

    def run(checkpoint):
        ingest.ingest_articles(spark, incoming, path, str(tmp_path / checkpoint), schemas.ARTICLES, files_per_batch=1).awaitTermination()
        return sorted(r["url"] for r in ingest.read_store(spark, path).collect())

    store.write_table(articles(spark, "a", "b").coalesce(1), incoming, mode="append")
    assert run("one") == ["a", "b"]
    store.write_table(articles(spark, "b", "c").coalesce(1), incoming, mode="append")
    assert run("two") == ["a", "b", "c"]
    assert run("one") == ["a", "b", "c"]
    store.write_table(articles(spark, "d").coalesce(1), incoming, mode="append")
    assert run("two") == run("one") == ["a", "b", "c", "d"]


def test_replayed_batch_adds_nothing(spark, tmp_path):
    path, checkpoint = str(tmp_path / "out"), tmp_path / "check"
    checkpoint.mkdir()
    (checkpoint / "metadata").write_text('{"id": "one"}')
    write = ingest._write_batch(path, str(checkpoint), schemas.ARTICLES, "url")
    write(articles(spark, "a"), 0)
    write(articles(spark, "a", "b"), 1)
    write(articles(spark, "a", "b"), 1)
    assert sorted(r["url"] for r in ingest.read_store(spark, path).collect()) == ["a", "b"]
    write(articles(spark, "a"), 0)
    assert sorted(r["url"] for r in ingest.read_store(spark, path).collect()) == ["a", "b"]


def test_empty_store(spark, tmp_path):
    incoming, path = str(tmp_path / "in"), str(tmp_path / "out")
    store.write_table(articles(spark).coalesce(1), incoming)
    ingest.ingest_articles(spark, incoming, path, str(tmp_path / "check"), schemas.ARTICLES).awaitTermination()
    assert ingest.read_store(spark, path, schemas.ARTICLES).count() == 0


def test_word_vectors_round_trip(spark, tmp_path):
    model = train_word_vectors(spark.createDataFrame([(["a", "b", "a"],)], "words array<string>"), size=4)
    store.save_word_vectors(model, str(tmp_path / "m"), str(tmp_path / "v"))
    loaded, table = store.load_word_vectors(spark, str(tmp_path / "m"), str(tmp_path / "v"))
    first = {r["word"]: r["vector"] for r in store.vector_table(loaded).collect()}
    assert first == {r["word"]: r["vector"] for r in table.collect()} and set(first) == {"a", "b"}


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    spark.range(20_000).selectExpr("id", "sha2(cast(id as string), 512) as t").coalesce(1).write.parquet(str(tmp_path / "one"))
    own = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(900_000))
        table = spark.read.parquet(str(tmp_path / "one"))
        assert 1 < table.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
        sizes = [r[0] for r in spread(table).groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)


def test_stream_of_a_table_of_one_file_or_of_a_folder(spark, tmp_path):
    from seriesloom.registry.tables import stream_ingest

    docs = spark.range(7).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'web' AS source", "id * 10 AS n_chars")
    (tmp_path / "folder").mkdir()
    (tmp_path / "single").mkdir()
    docs.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    docs.toPandas().to_parquet(tmp_path / "single" / "documents.parquet")
    for kind in ("folder", "single"):
        got = sorted(map(tuple, stream_ingest(spark, str(tmp_path / kind)).collect()))
        assert got == [(i, "web", i * 10) for i in range(7)]
