"""Skip-gram word vectors with negative samples that start from given vectors.

Words with a given vector keep it; the others learn theirs beside them. The corpus is dealt into parts of a
fixed number of tokens, so there are as many tasks as the corpus asks for. A pass trains every part from the
same vectors, and a word's vector moves by the mean of its parts' moves, weighted by how often each saw it.

For a long corpus the pairs are counted once instead (``pairvectors``). The mean of the passes' loss over windows
and negative samples depends on the counts alone, so a step sees all pairs of the whole corpus and costs the
square of the vocabulary, however long the corpus is.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators import pairvectors
from seriesloom.operators.vectors import COUNTED_TOKENS, PART_TOKENS, TOKEN_PAIRS, overlay_vectors
from seriesloom.session import materialise

# Executors need no install of the kernels: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a text that are trained as one; longer texts are cut.
PIECE = 10_000
#: Numbers of both vector tables; more are refused, as every task holds them.
MAX_NUMBERS = 1 << 26
#: Moves of one row within a step that add up in full.
REPEATS = 8
#: Cells of a step on counts that take as long as one sample of a pass.
SAMPLE_CELLS = 40
#: Steps on counts that stand for a pass, and the rate of the first one as a multiple of the passes' rate.
STEPS, COUNTED_RATE = 40, 2
# The exponent of the word counts for negative samples, and the pairs of one step.
FLATTEN, STEP_PAIRS = 0.75, 256


def window_pairs(sentence: np.ndarray, reach: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of (centre, neighbour) in one text; each centre looks ``reach`` words to both sides.

    ``sentence`` numbers the text each token belongs to; pairs never cross texts.
    """
    centres, others, at = [], [], np.arange(len(sentence))
    for gap in range(1, window + 1):
        low = at[:-gap] if gap < len(at) else at[:0]
        same = sentence[low] == sentence[low + gap]
        for centre, other in ((low, low + gap), (low + gap, low)):
            kept = same & (reach[centre] >= gap)
            centres.append(centre[kept])
            others.append(other[kept])
    centre, other = np.concatenate(centres), np.concatenate(others)
    order = np.argsort(centre, kind="stable")
    return centre[order], other[order]


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds rows to the rows ``at`` of a table; repeated ones add up, to at most ``REPEATS`` times their mean.

    One by one, each would have seen the move of those before it; summed without bound they overshoot.
    """
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    often = np.diff(np.append(first, len(at)))
    table[at[first]] += np.add.reduceat(rows[order], first, axis=0) * np.minimum(1, REPEATS / often)[:, None].astype(table.dtype)


def train_part(
    ids: np.ndarray, sentence: np.ndarray, vectors: np.ndarray, contexts: np.ndarray, frozen: np.ndarray, shares: np.ndarray,
    window: int, negatives: int, rate: float, rng: np.random.Generator,
) -> None:
    """One pass over a part's tokens; moves ``vectors`` (but for ``frozen`` rows) and ``contexts`` in place.

    ``shares`` are the running shares of the words among negative samples.
    """
    centre, other = window_pairs(sentence, rng.integers(1, window + 1, len(ids)), window)
    order = rng.permutation(len(centre))
    for at in range(0, len(order), STEP_PAIRS):
        some = order[at : at + STEP_PAIRS]
        word, near = ids[other[some]], ids[centre[some]]
        wrong = np.minimum(np.searchsorted(shares, rng.random((len(some), negatives)), side="right"), len(shares) - 1)
        target = np.concatenate([near[:, None], wrong], axis=1)
        h, t = vectors[word], contexts[target]
        z = np.clip(np.einsum("bs,bks->bk", h, t), -30, 30)
        pull = -1 / (1 + np.exp(-z))
        pull[:, 0] += 1
        pull[:, 1:][wrong == near[:, None]] = 0
        pull = (pull * rate).astype(vectors.dtype)
        _add_rows(contexts, target.ravel(), (pull[:, :, None] * h[:, None, :]).reshape(-1, h.shape[1]))
        moves = ~frozen[word]
        if moves.any():
            _add_rows(vectors, word[moves], np.einsum("bk,bks->bs", pull[moves], t[moves]))


def _encoded(corpus: DataFrame, words: str, numbers: dict[str, int]) -> DataFrame:
    """``ids``: the known words of each text as numbers, long texts in pieces; texts without any are left out."""
    held = corpus.sparkSession.sparkContext.broadcast(numbers)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in tables:
            found = []
            for text in batch.column(0):
                ids = [known[w] for w in (text.as_py() or ()) if w in known]
                found += [ids[a : a + PIECE] for a in range(0, len(ids), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["ids"])

    return corpus.select(F.col(words).alias("words")).mapInArrow(run, "ids array<int>")


def _moves(encoded: DataFrame, held: Broadcast, window: int, negatives: int, rate: float, seed: list[int]) -> DataFrame:
    """Per part and word that moved: ``id``, ``side`` (0 vector, 1 context), ``n`` tokens of it and by how much it ``moved``."""

    def run(texts: pd.DataFrame) -> pd.DataFrame:
        texts = texts.sort_values("row")
        lengths = texts["ids"].map(len).to_numpy()
        ids, sentence = np.concatenate(texts["ids"].to_list()).astype(np.int64), np.repeat(np.arange(len(texts)), lengths)
        vectors, contexts, frozen, shares = held.value
        own = vectors.copy(), contexts.copy()
        train_part(ids, sentence, *own, frozen, shares, window, negatives, rate, np.random.default_rng([*seed, int(texts["part"].iloc[0])]))
        seen = np.maximum(np.bincount(ids, minlength=len(frozen)), 1).astype(np.float64)
        found = []
        for side, (new, old) in enumerate(zip(own, (vectors, contexts))):
            at = np.flatnonzero((new != old).any(axis=1))
            found.append(pd.DataFrame({"id": at, "side": side, "n": seen[at], "moved": list((new[at] - old[at]).astype(np.float64))}))
        return pd.concat(found)

    return encoded.groupBy("part").applyInPandas(run, "id long, side int, n double, moved array<double>")


def counting_pays(tokens: int, words: int, negatives: int) -> bool:
    """Whether the steps on counted pairs cost less than a pass over the tokens."""
    return SAMPLE_CELLS * TOKEN_PAIRS * tokens * (1 + negatives) >= STEPS * words**2


def _count_blocks(pairs: DataFrame, words: int) -> DataFrame:
    """``block`` and ``near``: how often each word is near each word of a block, a matrix of 4-byte floats; all blocks."""
    rows = pairvectors.block_rows(words)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        start = int(block["word"].iloc[0]) // rows * rows
        own = min(rows, words - start)
        at = (block["word"].to_numpy() - start) * words + block["other"].to_numpy()
        near = np.bincount(at, block["n"].to_numpy(), own * words).astype(np.float32)
        return pd.DataFrame({"block": [start // rows], "near": [near.tobytes()]})

    # A word without a neighbour is still drawn as a negative sample.
    alone = pairs.sparkSession.range(words).select(F.col("id").alias("word"), F.col("id").alias("other"), F.lit(0).cast("long").alias("n"))
    both = pairvectors.both_ways(pairs).unionByName(alone)
    return both.groupBy((F.col("word") / rows).cast("long").alias("key")).applyInPandas(run, "block long, near binary")


def count_slopes(near: np.ndarray, start: int, vectors: np.ndarray, contexts: np.ndarray, drawn: np.ndarray, seen: np.ndarray) -> list[np.ndarray]:
    """Slopes of the whole loss in a block's rows of ``vectors`` and of ``contexts``.

    ``near`` counts the pairs of the words from ``start`` on with every word, ``seen`` the pairs of every word;
    ``drawn`` is how often each word is drawn as a negative sample of a pair, which does not count where it is the neighbour.
    """
    own, slopes = slice(start, start + len(near)), []
    for side, (rows, others) in enumerate(((vectors, contexts), (contexts, vectors))):
        wrong = (seen - near) * drawn[own, None] if side else (seen[own, None] - near) * drawn
        share = rows[own] @ others.T
        np.clip(share, -30, 30, out=share)
        np.exp(np.negative(share, out=share), out=share)
        share += 1
        np.divide(np.add(wrong, near, out=wrong), share, out=share)
        share -= near
        slopes.append(share @ others)
    return slopes


def _train_passes(
    corpus: DataFrame, words: str, names: list[str], vectors: np.ndarray, frozen: np.ndarray, shares: np.ndarray,
    parts: int, window: int, negatives: int, passes: int, rate: float, seed: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Both tables after ``passes`` over the texts in ``parts`` parts."""
    spark, contexts = corpus.sparkSession, np.zeros_like(vectors)
    row = F.monotonically_increasing_id()
    encoded = materialise(_encoded(corpus, words, {w: i for i, w in enumerate(names)}))
    encoded = materialise(encoded.select("ids", row.alias("row"), F.pmod(F.xxhash64(row), F.lit(parts)).cast("int").alias("part")))
    for turn in range(passes):
        held = spark.sparkContext.broadcast((vectors, contexts, frozen, shares))
        step = rate * max(1 - turn / passes, 1e-4)

        moves = _moves(encoded, held, window, negatives, step, [seed, turn])
        mean = moves.groupBy("side", "id").agg(vector_to_array(Summarizer.mean(array_to_vector("moved"), F.col("n"))).alias("moved"))
        moved = materialise(mean).toArrow().to_pandas()
        vectors, contexts = vectors.copy(), contexts.copy()
        for side, table in enumerate((vectors, contexts)):
            of = moved[moved["side"] == side]
            if len(of):
                table[of["id"].to_numpy()] += np.stack(of["moved"].to_list()).astype(np.float32)
        held.unpersist()
    return vectors, contexts


def _train_counts(
    corpus: DataFrame, words: str, names: list[str], vectors: np.ndarray, frozen: np.ndarray, shares: np.ndarray,
    window: int, negatives: int, passes: int, rate: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Both tables after ``passes * STEPS`` steps down the whole slope with two moments.

    A row's slope is worked out in one task from exact counts, so neither the cores nor the order of the texts matter.
    """
    spark, size, rows = corpus.sparkSession, vectors.shape[1], pairvectors.block_rows(len(names))
    pairs = materialise(pairvectors.pair_counts(corpus, words, names, window))
    seen = np.zeros(len(names), dtype=np.float32)
    for r in pairvectors.both_ways(pairs).groupBy("word").agg(F.sum("n").alias("n")).collect():
        seen[r["word"]] = r["n"]
    drawn = (negatives * np.diff(shares, prepend=0)).astype(np.float32)
    tasks = max(spark.sparkContext.defaultParallelism, -(-4 * len(names) ** 2 // pairvectors.TASK_BYTES))
    blocks = materialise(_count_blocks(pairs, len(names)).repartition(tasks))

    def slopes(held: Broadcast) -> DataFrame:
        def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in tables:
                for number, near in zip(batch.column(0).to_pylist(), batch.column(1)):
                    counted = np.frombuffer(near.as_buffer(), dtype=np.float32).reshape(-1, len(held.value[0]))
                    found = [pa.array([f.tobytes()], pa.binary()) for f in count_slopes(counted, number * rows, *held.value)]
                    yield pa.RecordBatch.from_arrays([pa.array([number]), *found], names=["block", "vectors", "contexts"])

        return blocks.mapInArrow(run, "block long, vectors binary, contexts binary")

    tables = [vectors, np.zeros_like(vectors)]
    moments = [[np.zeros_like(t), np.zeros_like(t)] for t in tables]
    for step in range(passes * STEPS):
        held = spark.sparkContext.broadcast((*tables, drawn, seen))
        found = [np.zeros_like(t) for t in tables]
        for row in slopes(held).collect():
            for slope, name in zip(found, ("vectors", "contexts")):
                part = np.frombuffer(row[name], dtype=np.float32).reshape(-1, size)
                slope[row["block"] * rows : row["block"] * rows + len(part)] = part
        held.destroy()
        found[0][frozen] = 0
        now = COUNTED_RATE * rate * (1 - step / (passes * STEPS))
        tables = [(t - pairvectors.move(slope, *m, step, now)).astype(np.float32) for t, slope, m in zip(tables, found, moments)]
    return tables[0], tables[1]


def continue_vectors(
    corpus: DataFrame, given: DataFrame, words: str = "words", size: int = 200, window: int = 5, negatives: int = 5, min_count: int = 1,
    passes: int = 5, rate: float = 0.025, seed: int = 346672, part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """``word`` and ``vector`` of all words of ``given`` and all words ``min_count`` times in ``corpus``.

    ``given`` has ``word`` and ``vector`` of length ``size``; its vectors come out as they are, to the last bit,
    whether or not the corpus has the word (of a repeated word the smallest). Other words start at random.
    Null texts, null words and given words without a vector are left out; a given vector of another length is
    an error. Both tables of the corpus' words travel to every task, so ``MAX_NUMBERS`` bounds them: cut the
    corpus to a fitted vocabulary (``checked_corpus``). Results do not depend on the number of cores.

    From ``COUNTED_TOKENS`` tokens on, pairs are counted where that is less work than the passes
    (``counting_pays``): the same loss over all pairs of all texts, in steps that do not grow with the corpus.
    """
    spark = corpus.sparkSession
    given = given.where("word is not null and vector is not null").groupBy("word").agg(F.min("vector").alias("vector"))
    odd = given.where(F.size("vector") != size).first()
    if odd is not None:
        raise ValueError(f"the vector of {odd['word']!r} has {len(odd['vector'])} numbers, not {size}")
    counted = corpus.select(F.explode(words).alias("word")).where("word is not null").groupBy("word").agg(F.count("*").alias("n"))
    counted = materialise(counted.where(F.col("n") >= min_count))
    total = counted.agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).first()
    if 2 * total["words"] * size > MAX_NUMBERS:
        raise ValueError(f"{total['words']} words of {size} numbers, twice, are more than {MAX_NUMBERS}: cut the vocabulary")
    if not total["words"]:
        return given.select("word", F.col("vector").cast("array<double>").alias("vector"))
    parts = math.ceil(total["tokens"] / part_tokens)

    known = counted.join(given, "word", "left").orderBy("word").select("word", "n", F.col("vector").cast("array<double>").alias("vector")).toArrow().to_pandas()
    names, frozen = known["word"].tolist(), known["vector"].notna().to_numpy()
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((len(names), size)) - 0.5) / size).astype(np.float32)
    if frozen.any():
        vectors[frozen] = np.stack(known["vector"][frozen].to_list()).astype(np.float32)
    counts = known["n"].to_numpy().astype(np.float64) ** FLATTEN
    shares = np.cumsum(counts) / counts.sum()

    if total["tokens"] >= COUNTED_TOKENS and counting_pays(total["tokens"], len(names), negatives):
        vectors, _ = _train_counts(corpus, words, names, vectors, frozen, shares, window, negatives, passes, rate)
    else:
        vectors, _ = _train_passes(corpus, words, names, vectors, frozen, shares, parts, window, negatives, passes, rate, seed)
    # Arrow tables go both ways whatever the session's setting for pandas, which may be off.
    lists = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, size, dtype=np.int32), pa.array(vectors.ravel().astype(np.float64)))
    trained = spark.createDataFrame(pa.table({"word": pa.array(names, pa.string()), "vector": lists}), "word string, vector array<double>")
    return overlay_vectors(trained, given.select("word", F.col("vector").cast("array<double>").alias("vector")))
