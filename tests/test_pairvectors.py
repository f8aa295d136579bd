from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import pairvectors, vectors
from seriesloom.sources import store

RNG = np.random.default_rng(5)


def counted(texts, window):
    """Twice the shares of all windows per (word, word near it), pair by pair."""
    found = Counter()
    for text in texts:
        for i, a in enumerate(text):
            for j in range(max(0, i - window), min(len(text), i + window + 1)):
                if i != j:
                    found[a, text[j]] += window + 1 - abs(i - j)
    return found


def test_tree_is_shortest():
    counts = [40, 9, 9, 5, 2, 1]
    left, right = pairvectors.word_tree(counts)
    depth = np.zeros(len(counts) + len(left), dtype=int)
    for node in reversed(range(len(left))):
        depth[[left[node], right[node]]] = depth[len(counts) + node] + 1
    assert sorted([*left, *right]) == list(range(len(counts) + len(left) - 1))
    # The length of the path is the sum of the weights of the inner nodes: 3, 8, 17, 26 (or 17 + 9) and 66.
    assert np.dot(depth[: len(counts)], counts) == 3 + 8 + 17 + 26 + 66


@pytest.mark.parametrize("held, piece", [(1 << 22, 1 << 20), (8, 7)])
def test_pair_counts(spark, monkeypatch, held, piece):
    """All pairs of whole texts, also where a task hands on what it holds; other words and nulls are left out before."""
    monkeypatch.setattr(pairvectors, "HELD_PAIRS", held)
    monkeypatch.setattr(pairvectors, "PIECE", piece)
    texts = [[str(w) for w in RNG.choice(list("abcdx"), n)] for n in (0, 1, 2, 30, 1500)] + [["a", None, "b"], None, ["x"]]
    frame = spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(2)
    names = list("dbca")
    got = {(names[r["first"]], names[r["second"]]): r["n"] for r in pairvectors.pair_counts(frame, "words", names, 3).collect()}
    want = counted([[w for w in t or () if w in names] for t in texts], 3)
    for a in names:
        for b in names:
            low, high = sorted((a, b), key=names.index)
            assert want[a, b] == got.get((low, high), 0) * (2 if a == b else 1)


def test_slopes_are_those_of_the_loss(spark, monkeypatch):
    """Blocks of both sides give the slope of the summed log likelihood of all paths."""
    monkeypatch.setattr(pairvectors, "BLOCK_ROWS", 2)
    names = list("abcde")
    texts = [[str(w) for w in RNG.choice(names, 20, p=[0.4, 0.3, 0.1, 0.1, 0.1])] for _ in range(6)]
    counts = Counter(w for t in texts for w in t)
    left, right = pairvectors.word_tree([counts[w] for w in names])
    paths = {n: [] for n in range(len(names) + len(left))}
    for node in reversed(range(len(left))):
        for child, way in ((left[node], 0), (right[node], 1)):
            paths[child] = [*paths[len(names) + node], (node, way)]
    pairs = counted(texts, pairvectors.WINDOW)

    def loss(words, nodes):
        total = 0.0
        for (centre, near), n in pairs.items():
            for node, way in paths[names.index(centre)]:
                z = words[names.index(near)] @ nodes[node]
                total += n * (np.log1p(np.exp(z)) - way * z)
        return total

    frame = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    of_words = pairvectors.word_blocks(pairvectors.pair_counts(frame, "words", names), left, right).persist()
    both = [t.select(F.lit(i).alias("side"), "block", "total", "right") for i, t in enumerate((of_words, pairvectors.node_blocks(of_words, 5)))]
    sides = [RNG.normal(size=(5, 3)).astype(np.float32), RNG.normal(size=(4, 3)).astype(np.float32)]
    held = spark.sparkContext.broadcast(sides)
    got = [np.full_like(t, np.nan) for t in sides]
    for row in pairvectors.block_slopes(both[0].union(both[1]), held, 2).collect():
        found = np.frombuffer(row["slope"], dtype=np.float32).reshape(-1, 3)
        got[row["side"]][row["block"] * 2 : row["block"] * 2 + len(found)] = found
    wide = [t.astype(float) for t in sides]
    for side in (0, 1):
        for at in np.ndindex(*wide[side].shape):
            ends = []
            for step in (1e-5, -1e-5):
                moved = [t.copy() for t in wide]
                moved[side][at] += step
                ends.append(loss(*moved))
            assert got[side][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-3, abs=1e-2)


def test_a_long_corpus_is_trained_on_its_pairs(spark, tmp_path):
    """Over a million tokens of two topics and a rare word: reruns agree to the bit, and topics part."""
    topics = F.array(*[F.array(*map(F.lit, t.split())) for t in ("apple pear plum fig grape melon", "iron steel zinc lead brass tin")])
    word = lambda i: F.get(F.get(topics, F.pmod("id", F.lit(2)).cast("int")), F.pmod(F.hash("id", i), F.lit(6)))
    texts = spark.range(90_000).select(F.transform(F.sequence(F.lit(1), F.lit(12)), word).alias("words"))
    corpus = texts.union(spark.createDataFrame([(["rare", "apple"],), (None,)], "words array<string>")).persist()
    models = [vectors.train_word_vectors(corpus, size=16, min_count=2, max_iter=2) for _ in range(2)]
    runs = [{r["word"]: r["vector"] for r in store.vector_table(m).collect()} for m in models]
    assert runs[0] == runs[1] and len(runs[0]) == 12 and models[0].getVectorSize() == 16 and models[0].getMinCount() == 2

    def cosine(a, b):
        a, b = np.array(runs[0][a]), np.array(runs[0][b])
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    assert min(cosine("pear", w) for w in ("plum", "fig", "grape")) > max(cosine("pear", w) for w in ("iron", "zinc", "tin")) + 0.5
    store.save_word_vectors(models[0], str(tmp_path / "m"), str(tmp_path / "v"))
    loaded, _ = store.load_word_vectors(spark, str(tmp_path / "m"), str(tmp_path / "v"))
    assert {r["word"]: r["vector"] for r in store.vector_table(loaded).collect()} == runs[0]


def test_one_word_and_wide_vocabularies(spark):
    """A single word has no tree; a vocabulary too wide for its corpus is left to the passes."""
    names, table = pairvectors.train_counted(spark.createDataFrame([(["a", "a"],)], "words array<string>"), "words", {"a": 2}, 4, 1, 1)
    assert names == ["a"] and table.shape == (1, 4)
    assert vectors.counting_pays(7_502_134, 3652) and not vectors.counting_pays(1_119_698, 100_000) and not vectors.counting_pays(1_000_000, 0)
