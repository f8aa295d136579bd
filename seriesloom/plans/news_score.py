"""Articles to a daily score, and the score into the next-day forecast.

Two forms of the score: ``score_v1`` clusters the documents' anchor similarities and averages the
ordered cluster number per day, ``score_v2`` averages the three similarities themselves. Days without
articles get a predicted score before the forecast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.text import join_words, keep_text_characters, spaced_tokens, split_words
from seriesloom.operators import cluster, prepare, profile, regress, split, tfidf, vectors, wordstats
from seriesloom.operators.lookup import elements
from seriesloom.operators.relational import complete_rows, fill_from, merge_score_tables, missing_rows, with_daily_score
from seriesloom.plans.next_day import SEED, add_date_feature
from seriesloom.session import materialise
from seriesloom.sources.store import read_or_build, vector_table

# Anchor words and the score column each one gives.
ANCHORS = {"증가": "up", "유지": "flat", "감소": "down"}


def token_scores(
    counts: DataFrame, right_parts: DataFrame, min_frequency: int = wordstats.MIN_FREQUENCY, min_cohesion: float = wordstats.MIN_COHESION
) -> DataFrame:
    """Combined noun and cohesion score per word."""
    cohesion = wordstats.cohesion_scores(counts, min_frequency, min_cohesion)
    nouns = wordstats.noun_scores(counts, right_parts)
    return merge_score_tables(nouns, cohesion)


def clean_corpus(docs: DataFrame, doc_id: str, text: str, right_parts: DataFrame, min_frequency: int = wordstats.MIN_FREQUENCY) -> DataFrame:
    """``(doc_id, tokens)``: left parts of every token, kept characters only."""
    counts = materialise(wordstats.token_counts(docs, spaced_tokens(F.col(text))))
    scores = materialise(token_scores(counts, right_parts, min_frequency))
    lefts = materialise(wordstats.left_parts(counts, scores))
    tokens = wordstats.tokenise(docs, doc_id, spaced_tokens(F.col(text)), lefts, counts)
    # No token has a space in it: one pass over the joined text cleans them all. The outer explode holds the
    # filter back, which would otherwise clean every text a second time.
    kept = F.array_remove(split_words(keep_text_characters(join_words(F.col("tokens")))), "")
    return elements(tokens, [doc_id], F.array(kept), "tokens").where(F.size("tokens") > 0)


def corpus_vocabulary(corpus: DataFrame, max_df: float = tfidf.MAX_DF, min_df: float = tfidf.MIN_DF) -> DataFrame:
    """TF-IDF vocabulary of a token table."""
    return materialise(tfidf.fit_tfidf(corpus.select(join_words(F.col("tokens")).alias("text")), "text", max_df, min_df))


def corpus_in_vocabulary(corpus: DataFrame, vocabulary: DataFrame, doc_id: str, normalize: bool = False) -> DataFrame:
    """Token table cut to the vocabulary."""
    return tfidf.keep_vocabulary(corpus, vocabulary, doc_id, F.col("tokens"), normalize=normalize)


def similarity_table(
    corpus: DataFrame, doc_id: str, anchors: Mapping[str, str] = ANCHORS, pretrained: DataFrame | None = None, size: int = 200
) -> DataFrame:
    """Mean similarity of each document's words to the anchor words, by vectors trained on the corpus."""
    model = vectors.train_word_vectors(corpus, size=size)
    table = vector_table(model)
    if pretrained is not None:
        table = vectors.overlay_vectors(table, pretrained)
    named = table.select(F.col("word").alias("name"), "vector")
    word_scores = materialise(vectors.anchor_similarity(table, "vector", named, anchors).drop("vector"))
    return vectors.document_similarity(corpus, doc_id, "words", word_scores, list(anchors.values()))


def score_v1(similar: DataFrame, date: str, columns: Sequence[str], k: int = 3, seed: int = SEED) -> DataFrame:
    """Daily mean of the ordered cluster number. ``columns`` are up, flat, down in that order."""
    known = complete_rows(similar, columns)
    scaled = prepare.fit_zscore(known, columns).transform(known)
    ready = materialise(prepare.assemble(scaled, columns))
    model = cluster.fit_kmeans(ready, k, seed=seed)
    return profile.daily_means(cluster.cluster_scores(ready, model, 0, len(columns) - 1), date, ["score"])


def score_v2(similar: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """Daily means of the similarities."""
    return profile.daily_means(complete_rows(similar, columns), date, columns)


def impute_scores(panel: DataFrame, scores: DataFrame, keys: Sequence[str], date: str, features: Sequence[str], targets: Sequence[str], seed: int = SEED) -> DataFrame:
    """Panel with a score on every day: known ones as they are, missing ones from least squares.

    One model per score, fitted on the train part of the days that have it; each score is filled where
    it is missing itself. ``panel`` and ``scores`` are read several times: pass stored tables. A score
    that no day has keeps its nulls, since there is nothing to learn from.
    """
    joined = add_date_feature(with_daily_score(panel, scores, date), date)
    columns = [*features, "date_int"]
    for target in targets:
        known = complete_rows(joined, [*columns, target]).withColumn("row_key", F.concat_ws("|", *keys))
        train = materialise(split.exact_split(known, "row_key", seed).where("split = 'train'"))
        if train.isEmpty():
            continue
        scaling = prepare.fit_zscore(train, columns)
        models = regress.fit_ols_per_target(prepare.assemble(scaling.transform(train), columns), [target])
        gaps = complete_rows(missing_rows(joined, target).select(*keys, *columns))
        scored = regress.predict_targets(prepare.assemble(_scaled_copy(gaps, scaling, keys), columns), models)
        joined = fill_from(joined, scored.select(*keys, F.col(f"predicted_{target}").alias(target)), keys, [target])
    return joined.drop("date_int")


def _scaled_copy(df: DataFrame, scaling: prepare.Scaling, keys: Sequence[str]) -> DataFrame:
    columns: list[Column] = [scaling.column(c).alias(c) for c in scaling.shift]
    return df.select(*keys, *columns)


def corpus_stages(spark: SparkSession, folder: str, docs: DataFrame, doc_id: str, text: str, right_parts: DataFrame, size: int = 200, anchors: Mapping[str, str] | None = ANCHORS) -> DataFrame:
    """Documents to anchor similarities, each stage stored under ``folder`` and loaded if it is there.

    Without ``anchors`` the three commonest vocabulary words by documents stand in.
    """
    corpus = read_or_build(spark, f"{folder}/corpus", lambda: clean_corpus(docs, doc_id, text, right_parts))
    vocabulary = read_or_build(spark, f"{folder}/vocabulary", lambda: corpus_vocabulary(corpus))
    words = read_or_build(spark, f"{folder}/words", lambda: corpus_in_vocabulary(corpus, vocabulary, doc_id, normalize=True))
    if anchors is None:
        names = [r["term"] for r in vocabulary.orderBy("df", "term").limit(3).collect()]
        anchors = dict(zip(names, ANCHORS.values()))
    return read_or_build(spark, f"{folder}/similar", lambda: similarity_table(words, doc_id, anchors, size=size))
