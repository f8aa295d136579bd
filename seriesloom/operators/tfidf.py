"""TF-IDF over whole documents.

Fitting counts each term once per document inside the row, so the only shuffle carries one partial
count per term and task. The transform drops words outside the vocabulary where the texts are read; what
moves is one count per document and kept term.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesloom.functions.text import split_words, word_tokens
from seriesloom.operators.lookup import elements, fits_broadcast, salted_join, word_lookup

# Share of documents a term may and must occur in.
MAX_DF = 0.2
MIN_DF = 0.011
# Most terms of a term map: their square is held by the driver.
MAP_TERMS = 2000


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(term, df)``: documents each term occurs in."""
    once = F.array_distinct(word_tokens(F.col(text)))
    return elements(docs, [], once, "term").groupBy("term").agg(F.count("*").alias("df"))


def term_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(term, df, total)`` from one scan: a word's first occurrence in its document counts for ``df``."""

    def marked(words: Column) -> Column:
        return F.transform(words, lambda w, i: F.struct(w.alias("term"), ((i == 0) | (F.get(words, i - 1) != w)).cast("int").alias("first")))

    # The array in between has the words worked out once for all their positions.
    ranked = F.get(F.transform(F.array(F.sort_array(word_tokens(F.col(text)))), marked), F.lit(0))
    found = elements(docs, [], ranked, "w").select("w.term", "w.first")
    return found.groupBy("term").agg(F.sum("first").alias("df"), F.count("*").alias("total"))


def fit_tfidf(
    docs: DataFrame, text: str = "text", max_df: float = MAX_DF, min_df: float = MIN_DF, max_features: int | None = None
) -> DataFrame:
    """Vocabulary ``(term, df, idf)`` with ``idf = ln((1 + n) / (1 + df)) + 1``.

    Terms in fewer than ``min_df * n`` or more than ``max_df * n`` documents are left out. With
    ``max_features`` only the terms with the largest ``total`` count stay, ties by term.
    """
    n = docs.agg(F.count("*").alias("n")).scalar()
    counted = document_frequencies(docs, text) if max_features is None else term_statistics(docs, text)
    kept = counted.where((F.col("df") >= n * F.lit(min_df)) & (F.col("df") <= n * F.lit(max_df)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("total"), "term").limit(max_features)
    return kept.withColumn("idf", F.log((n + 1) / (F.col("df") + 1)) + 1)


def rank_by_idf(vocabulary: DataFrame, n: int | None = None, rarest_first: bool = False) -> DataFrame:
    """Terms in order of idf, ties by term; the first ``n`` when given."""
    order = [F.desc("idf"), F.desc("term")] if rarest_first else [F.asc("idf"), F.asc("term")]
    ordered = vocabulary.select("term", "idf").orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def term_counts(docs: DataFrame, doc_id: str, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, term, idf, tf)`` of the vocabulary's terms.

    A small vocabulary meets the words where the texts are read; a large one meets one count per
    document and word.
    """
    idf = vocabulary.select("term", "idf")
    words = elements(docs, [doc_id], word_tokens(F.col(text)), "term")
    if fits_broadcast(idf):
        return words.join(F.broadcast(idf), "term").groupBy(doc_id, "term", "idf").agg(F.count("*").alias("tf"))
    counted = words.groupBy(doc_id, "term").agg(F.count("*").alias("tf"))
    return salted_join(counted, idf, "term", "inner", [doc_id])


def transform_tfidf(docs: DataFrame, vocabulary: DataFrame, doc_id: str, text: str = "text") -> DataFrame:
    """``(doc_id, term, tfidf)``: ``(1 + ln tf) * idf``, scaled to length 1 per document.

    ``vocabulary`` is read twice: pass a stored table.
    """
    weighted = term_counts(docs, doc_id, vocabulary, text).withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc_id)))
    return weighted.select(doc_id, "term", (F.col("w") / norm).alias("tfidf"))


def keep_vocabulary(
    docs: DataFrame, vocabulary: DataFrame, doc_id: str, words: Column, term: str = "term", normalize: bool = False
) -> DataFrame:
    """Words of each document found in the vocabulary, in order and with repeats.

    The vocabulary is lower-cased and words are compared as written, so capitalised words drop out;
    ``normalize`` lower-cases them first. Documents left without a word have no row.
    """
    if normalize:
        words = F.transform(words, lambda w: F.lower(w))
    terms = vocabulary.select(F.col(term).alias("word")).distinct()
    kept = word_lookup(docs, doc_id, words, terms, "word", "left_semi")
    return kept.groupBy(doc_id).agg(F.sort_array(F.collect_list(F.struct("pos", "word")))["word"].alias("words"))


def checked_corpus(docs: DataFrame, vocabulary: DataFrame, doc_id: str, text: str = "text", normalize: bool = False) -> DataFrame:
    """:func:`keep_vocabulary` over the single-space words of a text column."""
    return keep_vocabulary(docs, vocabulary, doc_id, split_words(F.col(text)), normalize=normalize)


def term_map(weights: DataFrame, vocabulary: DataFrame, doc_id: str, k: int = 2) -> DataFrame:
    """Coordinates of the terms on the ``k`` main axes of the document-term matrix.

    The right singular vectors times the singular values, each axis turned so that its largest entry
    is positive. Documents become vectors over the numbered terms, and one pass over them sums the
    term-by-term products; what is left is a matrix of the size of ``vocabulary`` squared. A
    vocabulary above ``MAP_TERMS`` terms is refused.
    """
    spark = weights.sparkSession
    rows = vocabulary.select("term").distinct().orderBy("term").limit(MAP_TERMS + 1).collect()
    if len(rows) > MAP_TERMS:
        raise ValueError(f"a term map takes up to {MAP_TERMS} terms")
    terms = [row["term"] for row in rows]
    numbers = spark.createDataFrame(list(enumerate(terms)), "number int, term string")
    cells = weights.join(F.broadcast(numbers), "term").groupBy(doc_id).agg(F.sort_array(F.collect_list(F.struct("number", "tfidf"))).alias("cells"))
    vectors = cells.select(_entries(len(terms), F.col("cells.number"), F.col("cells.tfidf")).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix().toArray()
    power, axes = np.linalg.eigh(gram)
    axes, power = axes[:, ::-1][:, :k], power[::-1][:k]
    turn = np.sign(axes[np.abs(axes).argmax(axis=0), range(axes.shape[1])])
    points = axes * turn * np.sqrt(np.maximum(power, 0.0))
    names = ["term"] + [f"axis{j + 1}" for j in range(points.shape[1])]
    return spark.createDataFrame(
        [(t, *map(float, points[i])) for i, t in enumerate(terms)], ", ".join([f"{names[0]} string"] + [f"{c} double" for c in names[1:]])
    )


def _entries(size: int, numbers: Column, values: Column) -> Column:
    """A dense vector column from a row's cells; the other entries are 0."""
    at = F.map_from_arrays(numbers, values)
    return array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit(0.0))))
