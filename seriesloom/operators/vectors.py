"""Word vectors and anchor similarities."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.numeric import dot
from seriesloom.operators import pairvectors
from seriesloom.operators.lookup import word_lookup
from seriesloom.session import scratch_path

#: Least parts of a training, and the tokens that ask for one more.
TRAINING_PARTS, PART_TOKENS = 4, 1_000_000
PASSES = 5
#: Tokens from which pairs are counted, and the pairs a token is in on average.
COUNTED_TOKENS, TOKEN_PAIRS = 1_000_000, 6


def train_word_vectors(
    corpus: DataFrame, words: str = "words", size: int = 200, min_count: int = 1, partitions: int | None = None, seed: int = 346672, max_iter: int = PASSES
) -> Word2VecModel:
    """Skip-gram word vectors of a tokenised corpus, by hierarchical softmax.

    The trainer keeps ``vocabulary x size`` floats on every executor, so train on the corpus cut to a
    fitted vocabulary (``checked_corpus``) and not on raw tokens. Each of ``max_iter`` passes trains
    ``partitions`` parts and averages their vectors; unless given, there is one per ``PART_TOKENS`` tokens,
    ``TRAINING_PARTS`` at least. Reruns differ where several parts run at a time in one executor.

    A corpus of ``COUNTED_TOKENS`` tokens or more, for which no ``partitions`` are given, has its pairs counted
    where that is less work than the passes (``counting_pays``): the same loss over all tokens, in steps whose
    cost does not grow with the corpus, and reruns agree.
    """
    tokens = None
    if partitions is None:
        tokens = corpus.agg(F.sum(F.greatest(F.size(words), F.lit(0)).cast("long"))).first()[0] or 0
        partitions = max(TRAINING_PARTS, math.ceil(tokens / PART_TOKENS))
    if tokens is not None and tokens >= COUNTED_TOKENS:
        once = corpus.select(F.explode(words).alias("word")).where("word is not null").groupBy("word").agg(F.count("*").alias("n"))
        counted = once.where(F.col("n") >= min_count).persist()
        try:
            if counting_pays(tokens, counted.count()):
                counts = {r["word"]: r["n"] for r in counted.collect()}
                return model_of(corpus, words, *pairvectors.train_counted(corpus, words, counts, size, max_iter, seed), min_count, seed, max_iter)
        finally:
            counted.unpersist()
    trainer = Word2Vec(
        vectorSize=size, minCount=min_count, numPartitions=partitions, inputCol=words, outputCol="_v", seed=seed, maxIter=max_iter
    )
    return trainer.fit(corpus)


def counting_pays(tokens: int, words: int) -> bool:
    """Whether the steps on counted pairs touch fewer cells than a pass touches nodes of the tree."""
    return words > 0 and TOKEN_PAIRS * tokens * math.log2(max(words, 2)) >= pairvectors.STEPS * words**2


def model_of(corpus: DataFrame, column: str, names: Sequence[str], table: np.ndarray, min_count: int, seed: int, max_iter: int) -> Word2VecModel:
    """A model with the given vectors.

    A model of the bare vocabulary is fitted and saved; the vectors take the place
    of its own in the saved table, and the model is loaded again.
    """
    spark, size = corpus.sparkSession, table.shape[1]
    words = spark.createDataFrame(pa.table({"word": pa.array(names, pa.string())}), "word string")
    bare = Word2Vec(vectorSize=size, minCount=min_count, numPartitions=1, inputCol=column, outputCol="_v", seed=seed, maxIter=max_iter)
    path = scratch_path(spark, "vectors")
    bare.fit(words.select(F.array_repeat("word", max(min_count, 1)).alias(column))).write().save(path)
    lists = pa.ListArray.from_arrays(np.arange(0, table.size + 1, size, dtype=np.int32), pa.array(table.ravel()))
    vectors = spark.createDataFrame(pa.table({"word": pa.array(names, pa.string()), "vector": lists}), "word string, vector array<float>")
    vectors.write.mode("overwrite").parquet(f"{path}/data")
    return Word2VecModel.load(path)


def overlay_vectors(trained: DataFrame, pretrained: DataFrame) -> DataFrame:
    """All words of both tables; a pretrained vector replaces the trained one."""
    left = trained.select("word", F.col("vector").alias("_trained"))
    right = pretrained.select("word", F.col("vector").alias("_pretrained"))
    return left.join(right, "word", "full_outer").select("word", F.coalesce("_pretrained", "_trained").alias("vector"))


def element_means(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``(label, position, mean)``: every element's mean per class."""
    return class_centroids(df, label, vector).select(label, F.posexplode("vector").alias("position", "mean"))


def class_centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """``(label, vector ARRAY<DOUBLE>)``: mean vector per class, partial means per task."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(label).agg(vector_to_array(mean).alias("vector"))


def anchor_similarity(df: DataFrame, vector: str, anchors: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Adds the cosine of each row's vector to each anchor vector.

    ``anchors(name, vector)`` holds the anchors; ``names`` maps an anchor to its output column. The few
    anchor vectors reach the rows as one subquery result. An anchor that is missing, or a vector of
    zeros, gives null.
    """
    wide = anchors.where(F.col("name").isin(list(names))).select("name", F.col("vector").cast("array<double>").alias("v"))
    picked = [F.max(F.when(F.col("name") == a, F.col("v"))).alias(f"a{i}") for i, a in enumerate(names)]
    table = wide.agg(*picked)
    norms = [F.sqrt(dot(F.col(f"a{i}"), F.col(f"a{i}"))).alias(f"n{i}") for i in range(len(names))]
    fixed = F.col("_anchors")
    packed = table.select(F.struct("*", *norms).alias("anchors")).scalar()
    with_norm = df.withColumns({"_v": F.col(vector).cast("array<double>"), "_anchors": packed})
    with_norm = with_norm.withColumn("_norm", F.sqrt(dot(F.col("_v"), F.col("_v"))))
    cosines = {
        column: dot(F.col("_v"), fixed[f"a{i}"]) / F.nullif(F.col("_norm") * fixed[f"n{i}"], F.lit(0.0))
        for i, column in enumerate(names.values())
    }
    return with_norm.withColumns(cosines).drop("_v", "_norm", "_anchors")


def document_similarity(
    corpus: DataFrame, doc_id: str, words: str, word_scores: DataFrame, scores: Sequence[str]
) -> DataFrame:
    """Mean anchor similarity over the words of each document.

    ``word_scores`` has one row per word, computed once per word and not once per occurrence. Words
    without a vector are skipped; ``coverage`` is the share of words that have one, and a document
    without any has null scores. ``word_scores`` is read twice: pass a stored or checkpointed table.
    """
    marked = word_scores.select("word", *scores, F.lit(1).alias("_known"))
    joined = word_lookup(corpus, doc_id, F.col(words), marked, "word", "left")
    coverage = F.count("_known") / F.count("*")
    return joined.groupBy(doc_id).agg(*[F.avg(s).alias(s) for s in scores], coverage.alias("coverage"))
