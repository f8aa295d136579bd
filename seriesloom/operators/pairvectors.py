"""Skip-gram word vectors under a tree of words, trained on counted pairs.

The loss is that of ``Word2Vec``: every word of a text foretells, along its path in a Huffman tree, from each
word around it. The corpus is read once, and every pair of words within the window counts with the share of
the random windows that hold it. From then on the loss and its slope depend on the counts alone, so a step sees
all pairs of the whole corpus and costs the square of the vocabulary, however long the corpus is. The counts stay
on the cluster in blocks; the driver holds the two vector tables.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.session import materialise

# Executors need no install of the kernels: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Steps that stand for a pass over the corpus, and the rate of the first one; it falls to 0 in a straight line.
STEPS, RATE = 16, 0.05
WINDOW = 5
#: Tokens whose pairs are counted at a time, and distinct pairs a task holds before it hands them on.
PIECE, HELD_PAIRS = 1 << 20, 1 << 22
#: Rows of a block of counts and their cells, at most; bytes of blocks a task reads in a step.
BLOCK_ROWS, BLOCK_CELLS, TASK_BYTES = 64, 1 << 20, 1 << 26
# Decay of the two moments of a step.
FIRST, SECOND = 0.9, 0.99


def word_tree(counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Left and right child of the inner nodes of the Huffman tree, in the order they are made.

    A child below ``len(counts)`` is a word, ``len(counts) + k`` the ``k``-th inner node.
    """
    heap = [(n, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    left, right = [], []
    while len(heap) > 1:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a + b, len(counts) + len(left)))
        left.append(i)
        right.append(j)
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _compact(codes: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and their summed counts."""
    code, n = np.concatenate(codes), np.concatenate(sums)
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else order
    return code[first], np.add.reduceat(n[order], first) if len(code) else n


def window_counts(ids: np.ndarray, text: np.ndarray, words: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes ``smaller * words + larger`` of the pairs within the window, and their counts in ``1 / window``.

    A random window of 1 to ``window`` words holds a pair ``gap`` words apart ``window + 1 - gap`` times out of
    ``window``. ``text`` numbers the text each token belongs to; pairs never cross texts.
    """
    for at in range(0, len(ids), PIECE):
        for gap in range(1, window + 1):
            low, high = ids[at : at + PIECE], ids[at + gap : at + gap + PIECE]
            low = low[: len(high)]
            same = text[at : at + len(low)] == text[at + gap : at + gap + len(high)]
            low, high = low[same], high[same]
            code, n = np.unique(np.minimum(low, high) * words + np.maximum(low, high), return_counts=True)
            yield code, n * (window + 1 - gap)


def pair_counts(corpus: DataFrame, words: str, names: list[str], window: int = WINDOW) -> DataFrame:
    """``first``, ``second`` and ``n``: numbers of two words of ``names``, the smaller first, and their count in ``1 / window``.

    Words that are not in ``names`` are left out before pairs are formed; texts are taken whole.
    """
    held = corpus.sparkSession.sparkContext.broadcast(names)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = pa.array(held.value, pa.string()), len(held.value)
        codes, sums, least = [], [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(codes[0]), PIECE):
                code, n = codes[0][at : at + PIECE], sums[0][at : at + PIECE]
                yield pa.RecordBatch.from_arrays([pa.array(code // size), pa.array(code % size), pa.array(n)], names=["first", "second", "n"])

        for batch in tables:
            texts = batch.column(0)
            found = pc.index_in(texts.flatten(), value_set=known)
            text = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False))
            text = text[found.is_valid().to_numpy(zero_copy_only=False)]
            for code, n in window_counts(found.drop_null().to_numpy().astype(np.int64), text, size, window):
                codes.append(code)
                sums.append(n.astype(np.int64))
                if sum(map(len, codes)) > least + HELD_PAIRS // 4:
                    merged = _compact(codes, sums)
                    codes, sums, least = [merged[0]], [merged[1]], len(merged[0])
                if least > HELD_PAIRS:
                    yield from rows()
                    codes, sums, least = [], [], 0
        if codes:
            merged = _compact(codes, sums)
            codes, sums = [merged[0]], [merged[1]]
            yield from rows()

    found = corpus.select(F.col(words).cast("array<string>").alias("words")).mapInArrow(run, "first long, second long, n long")
    return found.groupBy("first", "second").agg(F.sum("n").alias("n"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """``word``, ``other`` and ``n``: every pair from both of its words, one of a word with itself twice."""
    ways = F.array(F.struct(F.col("first").alias("word"), F.col("second").alias("other")), F.struct(F.col("second").alias("word"), F.col("first").alias("other")))
    return pairs.select(F.explode(ways).alias("way"), "n").select("way.word", "way.other", "n")


def block_rows(words: int) -> int:
    """Words of a block of counts."""
    return max(1, min(BLOCK_ROWS, BLOCK_CELLS // words))


def word_blocks(pairs: DataFrame, left: np.ndarray, right: np.ndarray) -> DataFrame:
    """``block``, ``total`` and ``right``: per word of a block and inner node, how often a word below the node, or below
    its right child, is near that word; matrices of 4-byte floats. Blocks without a pair are left out."""
    inner = len(left)
    words, rows = inner + 1, block_rows(inner + 1)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        start = int(block["word"].iloc[0]) // rows * rows
        own = min(rows, words - start)
        near = np.zeros((words + inner, own))
        at = block["other"].to_numpy() * own + (block["word"].to_numpy() - start)
        near[:words] = np.bincount(at, block["n"].to_numpy(), words * own).reshape(words, own)
        for node in range(inner):
            near[words + node] = near[left[node]] + near[right[node]]
        tables = [np.ascontiguousarray(t.T, dtype=np.float32).tobytes() for t in (near[words:], near[right])]
        return pd.DataFrame({"block": [start // rows], "total": [tables[0]], "right": [tables[1]]})

    return both_ways(pairs).groupBy((F.col("word") / rows).cast("long").alias("key")).applyInPandas(run, "block long, total binary, right binary")


def node_blocks(blocks: DataFrame, words: int) -> DataFrame:
    """The same counts with the inner nodes as rows and the words as columns, tile by tile."""
    inner, rows = words - 1, block_rows(words)

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for i, block in enumerate(batch.column(0).to_pylist()):
                total, right = (np.frombuffer(c[i].as_buffer(), dtype=np.float32).reshape(-1, inner) for c in batch.columns[1:])
                starts = range(0, inner, rows)
                tiles = [pa.array([t[:, a : a + rows].T.tobytes() for a in starts], pa.binary()) for t in (total, right)]
                numbers = pa.array(range(len(starts)), pa.int64()), pa.array([block] * len(starts), pa.int64())
                yield pa.RecordBatch.from_arrays([*numbers, *tiles], names=["block", "part", "total", "right"])

    def join(tiles: pd.DataFrame) -> pd.DataFrame:
        block = int(tiles["block"].iloc[0])
        own, out = min(rows, inner - block * rows), []
        for name in ("total", "right"):
            table = np.zeros((own, words), dtype=np.float32)
            for part, tile in zip(tiles["part"], tiles[name]):
                tile = np.frombuffer(tile, dtype=np.float32).reshape(own, -1)
                table[:, part * rows : part * rows + tile.shape[1]] = tile
            out.append(table.tobytes())
        return pd.DataFrame({"block": [block], "total": [out[0]], "right": [out[1]]})

    tiles = blocks.select("block", "total", "right").mapInArrow(cut, "block long, part long, total binary, right binary")
    return tiles.groupBy("block").applyInPandas(join, "block long, total binary, right binary")


def block_slopes(blocks: DataFrame, held: Broadcast, rows: int) -> DataFrame:
    """``side``, ``block`` and ``slope`` of the loss in the rows of each block: words on side 0, inner nodes on side 1."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            sides, numbers, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i, (side, block) in enumerate(zip(sides, numbers)):
                own, other = held.value[side][block * rows : (block + 1) * rows], held.value[1 - side]
                total, right = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.float32).reshape(len(own), -1) for c in (2, 3))
                share = own @ other.T
                np.clip(share, -30, 30, out=share)
                np.exp(np.negative(share, out=share), out=share)
                share += 1
                np.divide(total, share, out=share)
                share -= right
                out.append((share @ other).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["side", "block", "slope"])

    return blocks.mapInArrow(run, "side int, block long, slope binary")


def move(slope: np.ndarray, first: np.ndarray, second: np.ndarray, step: int, rate: float) -> np.ndarray:
    """How far a table moves down its slope in the ``step``-th step; takes the slope into both moments in place."""
    first += (1 - FIRST) * (slope - first)
    second += (1 - SECOND) * (slope * slope - second)
    whole = np.sqrt(second / (1 - SECOND ** (step + 1))) + 1e-12
    return rate * first / (1 - FIRST ** (step + 1)) / whole


def train_counted(corpus: DataFrame, words: str, counts: dict[str, int], size: int, passes: int, seed: int, window: int = WINDOW) -> tuple[list[str], np.ndarray]:
    """The words of ``counts``, commonest first, and their vectors as rows.

    ``passes * STEPS`` steps down the whole slope with two moments. A row's slope is worked out in one task from exact
    counts, so the result depends on neither the cores nor the order of the texts. Two tables of vocabulary times
    ``size`` numbers travel to every task.
    """
    spark = corpus.sparkSession
    names = sorted(counts, key=lambda w: (-counts[w], w))
    rng = np.random.default_rng(seed)
    sides = [((rng.random((len(names), size)) - 0.5) / size).astype(np.float32), np.zeros((len(names) - 1, size), dtype=np.float32)]
    if len(names) < 2:
        return names, sides[0]
    rows = block_rows(len(names))
    of_words = materialise(word_blocks(pair_counts(corpus, words, names, window), *word_tree([counts[w] for w in names])))
    both = [t.select(F.lit(side).alias("side"), "block", "total", "right") for side, t in enumerate((of_words, node_blocks(of_words, len(names))))]
    tasks = max(spark.sparkContext.defaultParallelism, -(-16 * len(names) ** 2 // TASK_BYTES))
    blocks = materialise(both[0].union(both[1]).repartition(tasks))
    moments = [[np.zeros_like(t), np.zeros_like(t)] for t in sides]
    for step in range(passes * STEPS):
        held = spark.sparkContext.broadcast(sides)
        slopes = [np.zeros_like(t) for t in sides]
        for row in block_slopes(blocks, held, rows).collect():
            found = np.frombuffer(row["slope"], dtype=np.float32).reshape(-1, size)
            slopes[row["side"]][row["block"] * rows : row["block"] * rows + len(found)] = found
        held.destroy()
        rate = RATE * (1 - step / (passes * STEPS))
        sides = [(t - move(slope, *m, step, rate)).astype(np.float32) for t, slope, m in zip(sides, slopes, moments)]
    return names, sides[0]
