"""Corpus statistics over space-delimited tokens, and the left-part tokeniser built on them.

Everything is scored on distinct tokens with their counts: the counts come from one aggregate with
partial sums per task, so a token that makes up a third of the corpus is one row from then on. Scores
travel back to the documents through :func:`seriesloom.operators.lookup.lookup_join`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.lookup import elements, lookup_join, numbered_elements, word_lookup
from seriesloom.session import materialise

# The thresholds the score tables are built with.
MIN_FREQUENCY = 100
MIN_COHESION = 0.05
MIN_NOUN_SCORE = 0.3
CHUNK_CHARS = 500
PREFIX_STEP = 8


def token_counts(docs: DataFrame, tokens: Column) -> DataFrame:
    """``(token, n)`` over all documents."""
    return elements(docs, [], tokens, "token").groupBy("token").agg(F.count("*").alias("n"))


def top_words(docs: DataFrame, tokens: Column, k: int) -> DataFrame:
    """The ``k`` most frequent tokens, ties by token."""
    return token_counts(docs, tokens).orderBy(F.desc("n"), "token").limit(k)


def prefix_counts(counts: DataFrame, min_frequency: int, step: int = PREFIX_STEP) -> DataFrame:
    """``(prefix, freq)`` of every token prefix whose shorter forms all reach ``min_frequency``.

    Prefixes grow ``step`` characters per round, and only tokens whose prefix so far is frequent go on:
    a longer prefix is never more frequent. So a token is cut no further than its frequent part and
    ``step`` characters, however long it is, and the rounds end by themselves. Prefixes below the
    frequency are in the result where their shorter form reaches it. ``counts`` is read once a round:
    pass a stored or checkpointed table.
    """
    rounds, active, at = [], counts.select("token", "n"), 1
    while True:
        ends = F.sequence(F.lit(at), F.least(F.length("token"), F.lit(at + step - 1)))
        grown = elements(active.where(F.length("token") >= at), ["token", "n"], ends, "k")
        found = materialise(grown.groupBy(F.expr("substring(token, 1, k)").alias("prefix")).agg(F.sum("n").alias("freq")))
        rounds.append(found)
        at += step
        edge = found.where((F.length("prefix") == at - 1) & (F.col("freq") >= min_frequency)).select("prefix")
        if not edge.take(1):
            break
        longer = active.where(F.length("token") >= at).withColumn("prefix", F.substring("token", 1, at - 1))
        active = materialise(lookup_join(longer, edge, "prefix", "left_semi", spread=["token"]).select("token", "n"))
    return reduce(DataFrame.unionByName, rounds)


def cohesion_scores(counts: DataFrame, min_frequency: int = MIN_FREQUENCY, min_cohesion: float = MIN_COHESION) -> DataFrame:
    """Forward cohesion of every token prefix of two or more characters.

    ``(freq(prefix) / freq(first character)) ** (1 / (length - 1))``. The first-character table has
    one row per character in use, which Unicode bounds, so it may be broadcast. ``counts`` is read
    several times: pass a stored or checkpointed table.
    """
    freq = prefix_counts(counts, min_frequency)
    first_counts = freq.where(F.length("prefix") == 1).select(F.col("prefix").alias("first"), F.col("freq").alias("first_n"))
    frequent = freq.where((F.length("prefix") >= 2) & (F.col("freq") >= min_frequency)).withColumn("first", F.substring("prefix", 1, 1))
    scored = frequent.join(F.broadcast(first_counts), "first").withColumn(
        "score", F.pow(F.col("freq") / F.col("first_n"), 1.0 / (F.length("prefix") - 1))
    )
    return scored.where(F.col("score") >= min_cohesion).select(F.col("prefix").alias("token"), "freq", "score")


def right_branching_entropy(counts: DataFrame, min_entropy: float = 0.0, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """Entropy of the character that follows each frequent prefix, over tokens that go on after it.

    A prefix and its next character are a prefix one longer, whose count is at hand. ``-sum p ln p``
    is written as ``ln N - sum(c ln c) / N``, so one pass over the counts is enough. ``freq`` counts
    the tokens that go on; ``min_frequency`` is on all tokens with the prefix.
    """
    freq = prefix_counts(counts, min_frequency)
    pairs = freq.where(F.length("prefix") > 1).select(F.expr("substring(prefix, 1, length(prefix) - 1)").alias("token"), F.col("freq").alias("c"))
    sums = pairs.groupBy("token").agg(
        F.sum("c").alias("freq"), F.count("*").alias("n_next"), F.sum(F.col("c") * F.log(F.col("c"))).alias("s")
    )
    frequent = freq.where(F.col("freq") >= min_frequency).select(F.col("prefix").alias("token"))
    entropy = F.when(F.col("n_next") == 1, F.lit(0.0)).otherwise(F.log("freq") - F.col("s") / F.col("freq"))
    scored = sums.join(frequent, "token", "left_semi").select("token", "freq", "n_next", entropy.alias("entropy"))
    return scored.where(F.col("entropy") >= min_entropy)


def noun_scores(counts: DataFrame, right_parts: DataFrame, min_score: float = MIN_NOUN_SCORE, min_frequency: int = 1) -> DataFrame:
    """Noun score of left parts by what follows them.

    Each token is cut where a right part of a listed length begins. A right part listed in
    ``right_parts(r, polarity)`` speaks for (+1) or against (-1) its left part being a noun:
    ``(pos - neg) / (pos + neg)``, weighted by token counts.
    """
    lengths = right_parts.agg(F.collect_set(F.length("r")).alias("lengths")).scalar()
    cuts = F.filter(F.transform("lengths", lambda size: F.length("token") - size), lambda k: k > 0)
    pairs = elements(counts.withColumn("lengths", lengths), ["token", "n"], cuts, "k").select(
        F.expr("substring(token, 1, k)").alias("l"), F.expr("substring(token, k + 1)").alias("r"), "n", "token"
    )
    known = lookup_join(pairs, right_parts.select("r", "polarity"), "r", "inner", spread=["token", "l"])
    positive = F.sum(F.when(F.col("polarity") > 0, F.col("n")).otherwise(0))
    negative = F.sum(F.when(F.col("polarity") < 0, F.col("n")).otherwise(0))
    sums = known.groupBy("l").agg(positive.alias("pos"), negative.alias("neg"))
    seen = F.col("pos") + F.col("neg")
    scored = sums.where(seen >= min_frequency).withColumn("score", (F.col("pos") - F.col("neg")) / seen)
    return scored.where(F.col("score") >= min_score).select(F.col("l").alias("token"), "pos", "neg", "score")


def flag_compounds(nouns: DataFrame, shortest: int = 2) -> DataFrame:
    """Adds ``is_compound``: the noun can be cut into two listed nouns of ``shortest`` or more characters.

    ``nouns`` is read three times: pass a stored or checkpointed table.
    """
    names = nouns.select("token")
    cuts = F.sequence(F.lit(shortest), F.length("token") - shortest)
    halves = (
        elements(names.where(F.length("token") >= 2 * shortest), ["token"], cuts, "k")
        .select("token", F.expr("substring(token, 1, k)").alias("a"), F.expr("substring(token, k + 1)").alias("b"))
    )
    first = lookup_join(halves, names.select(F.col("token").alias("a")), "a", "left_semi", spread=["token"])
    both = lookup_join(first, names.select(F.col("token").alias("b")), "b", "left_semi", spread=["token"])
    compounds = both.select("token").distinct().withColumn("is_compound", F.lit(True))
    return nouns.join(compounds, "token", "left").withColumn("is_compound", F.coalesce("is_compound", F.lit(False)))


def left_parts(counts: DataFrame, scores: DataFrame) -> DataFrame:
    """``(token, left)``: the best-scoring prefix of two or more characters, ties to the longer one.

    A prefix without a score counts 0. Only prefixes as long as some scored word can have one. Of the
    others the longest wins: the whole token, or what is one shorter than a scored word. So those are
    the only candidates. Tokens of one or two characters stay whole.
    """
    size = F.explode(F.array(F.length("token"), F.length("token") - 1))
    lengths = scores.select(size.alias("size")).agg(F.collect_set("size").alias("lengths")).scalar()
    whole = F.length("token")
    ends = F.array_union(F.filter("lengths", lambda k: (k >= 2) & (k <= whole)), F.array(whole))
    candidates = (
        elements(counts.where(whole > 2).withColumn("lengths", lengths), ["token"], ends, "k")
        .select("token", F.expr("substring(token, 1, k)").alias("prefix"))
    )
    prefix_scores = scores.select(F.col("token").alias("prefix"), "score")
    scored = lookup_join(candidates, prefix_scores, "prefix", "left", spread=["token"])
    # Beside scores of 0 and more, a prefix without one never beats the whole token.
    negative = scores.agg(F.coalesce(F.min("score") < 0, F.lit(False)).alias("negative")).scalar()
    scored = scored.where(F.col("score").isNotNull() | (F.length("prefix") == F.length("token")) | negative)
    rank = F.struct(F.coalesce("score", F.lit(0.0)), F.length("prefix"))
    best = scored.groupBy("token").agg(F.max_by("prefix", rank).alias("left"))
    return best.unionByName(counts.where(whole <= 2).select("token", F.col("token").alias("left")))


def tokenise(docs: DataFrame, doc_id: str, tokens: Column, lefts: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Documents as arrays of left parts, in order.

    Only tokens that lose a right part need to be looked up. ``lefts`` is read twice: pass a stored or
    checkpointed table. Documents without a token are left out.
    """
    shortened = lefts.where(F.col("left") != F.col("token"))
    found = word_lookup(docs, doc_id, tokens, shortened, "token", "left", counts)
    part = F.struct("pos", F.coalesce("left", "token").alias("part"))
    return found.groupBy(doc_id).agg(F.sort_array(F.collect_list(part))["part"].alias("tokens"))


def pack_words(text: Column, limit: int = CHUNK_CHARS) -> Column:
    """Text of ``limit`` or more characters cut at words into pieces of fewer than ``limit`` letters.

    Word lengths are added up without the spaces. A shorter text is one piece; a single word longer
    than the limit is a piece of its own.
    """
    start = F.struct(F.lit(0).alias("size"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("cuts"))

    def add(acc: Column, word: Column) -> Column:
        size, after = acc["size"] + F.length(word), (acc["i"] + 1).alias("i")
        cut = F.struct(F.length(word).alias("size"), after, F.array_append(acc["cuts"], acc["i"]).alias("cuts"))
        return F.when(size >= limit, cut).otherwise(F.struct(size.alias("size"), after, acc["cuts"].alias("cuts")))

    def pieces(words: Column, end: Column) -> Column:
        inner = F.array_remove(end["cuts"], 0)
        last = F.when(end["size"] > 0, F.array(F.size(words))).otherwise(F.array().cast("array<int>"))
        spans = F.arrays_zip(F.concat(F.array(F.lit(0)), inner).alias("a"), F.concat(inner, last).alias("b"))
        spans = F.filter(spans, lambda s: s["b"].isNotNull())
        return F.transform(spans, lambda s: F.array_join(F.slice(words, s["a"] + 1, s["b"] - s["a"]), " "))

    def pack(words: Column) -> Column:
        end = F.array(F.aggregate(words, start, add))
        return F.get(F.transform(end, lambda e: pieces(words, e)), F.lit(0))

    words = F.array(F.split(text, " ", -1))
    return F.when(F.length(text) < limit, F.array(text)).otherwise(F.get(F.transform(words, pack), F.lit(0)))


def chunks(docs: DataFrame, doc_id: str, text: str, limit: int = CHUNK_CHARS) -> DataFrame:
    """One row per piece of each document, with its position."""
    return numbered_elements(docs, [doc_id], pack_words(F.col(text), limit), "chunk", "piece")
