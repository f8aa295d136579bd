import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import skipgram, vectors

RNG = np.random.default_rng(3)
TOPICS = ["apple pear plum fig grape melon".split(), "iron steel zinc lead brass tin".split()]


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [[str(w) for w in RNG.choice(TOPICS[i % 2], 12)] for i in range(600)]
    return spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(4).persist()


def cosine(a, b):
    return a @ b / np.linalg.norm(a) / np.linalg.norm(b)


def test_window_pairs():
    sentence, reach = np.array([0, 0, 0, 1, 1]), np.array([2, 1, 1, 1, 2])
    centre, other = skipgram.window_pairs(sentence, reach, 2)
    assert sorted(zip(centre.tolist(), other.tolist())) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 1), (3, 4), (4, 3)]
    assert len(skipgram.window_pairs(np.zeros(1, int), np.ones(1, int), 5)[0]) == 0


def test_rows_add_up():
    table = np.zeros((3, 2))
    skipgram._add_rows(table, np.array([2, 0, 2]), np.array([[1.0, 1], [2, 2], [3, 3]]))
    assert table.tolist() == [[2, 2], [0, 0], [4, 4]]


def test_a_step_follows_the_slope():
    """One pair and its negatives: the move is the rate times the slope of the log likelihood."""
    rng = np.random.default_rng(0)
    start, contexts = rng.normal(size=(4, 3)), rng.normal(size=(4, 3))
    ids, sentence, shares = np.array([0, 1]), np.zeros(2, int), np.cumsum([0.0, 0.0, 0.5, 0.5])

    def likelihood(v, wrong):
        def side(word, near, bad):
            z = contexts[bad] @ v[word]
            return -np.log1p(np.exp(-contexts[near] @ v[word])) - np.log1p(np.exp(z)).sum()
        return side(1, 0, wrong[0]) + side(0, 1, wrong[1])

    # The samples the pass draws: reach, order of the pairs, then the negatives in that order.
    twin = np.random.default_rng(7)
    reach = twin.integers(1, 2, 2)
    order = twin.permutation(2)
    drawn = np.searchsorted(shares, twin.random((2, 2)), side="right")
    wrong = {int(o): drawn[i] for i, o in enumerate(order)}
    moved, own = start.copy(), contexts.copy()
    skipgram.train_part(ids, sentence, moved, own, np.zeros(4, bool), shares, 1, 2, 1e-3, np.random.default_rng(7))
    assert reach.tolist() == [1, 1]
    for word in (0, 1):
        for axis in range(3):
            up, down = start.copy(), start.copy()
            up[word, axis] += 1e-6
            down[word, axis] -= 1e-6
            slope = (likelihood(up, wrong) - likelihood(down, wrong)) / 2e-6
            assert moved[word, axis] - start[word, axis] == pytest.approx(1e-3 * slope, rel=1e-4)


def test_given_vectors_stay_and_topics_part(spark, corpus):
    fruit, metal = np.linspace(-0.5, 0.7, 16), np.linspace(0.6, -0.4, 16)
    given = spark.createDataFrame(
        [("apple", fruit.tolist()), ("pear", (fruit * 1.01).tolist()), ("iron", metal.tolist()), ("steel", (metal * 0.97).tolist()), ("absent", [1 / 3] * 16)],
        "word string, vector array<double>",
    )
    before = {r["word"]: r["vector"] for r in given.collect()}
    result = skipgram.continue_vectors(corpus, given, size=16, passes=6, rate=0.1, part_tokens=1500)
    got = {r["word"]: r["vector"] for r in result.collect()}
    assert set(got) == {*TOPICS[0], *TOPICS[1], "absent"}
    for word, vector in before.items():
        assert got[word] == vector
    apart = np.mean([cosine(np.array(got[a]), np.array(got[b])) for a in TOPICS[0][2:] for b in TOPICS[1][2:]])
    within = np.mean([cosine(np.array(got[a]), np.array(got[b])) for t in TOPICS for a in t[2:] for b in t[2:] if a != b])
    assert within > apart + 0.5
    # New words side with the given words of their topic.
    assert cosine(np.array(got["plum"]), fruit) > cosine(np.array(got["plum"]), metal)
    assert cosine(np.array(got["zinc"]), metal) > cosine(np.array(got["zinc"]), fruit)


def test_reruns_agree(spark, corpus):
    given = spark.createDataFrame([], "word string, vector array<double>")
    one = corpus.coalesce(1).persist()
    runs = [{r["word"]: r["vector"] for r in skipgram.continue_vectors(one, given, size=4, passes=1).collect()} for _ in range(2)]
    assert runs[0] == runs[1]


def test_odd_rows(spark):
    given = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [0.5, 2.0]), (None, [1.0, 1.0]), ("b", None)], "word string, vector array<double>")
    corpus = spark.createDataFrame([(["a", None, "b", "c"],), (None,), ([],), (["c"] * 25_000,)], "words array<string>").withColumn("word", F.lit("clash"))
    got = {r["word"]: r["vector"] for r in skipgram.continue_vectors(corpus, given, size=2, passes=1, min_count=2).collect()}
    assert got["a"] == [0.5, 2.0] and set(got) == {"a", "c"}
    assert {r["word"] for r in skipgram.continue_vectors(corpus.limit(0), given, size=2).collect()} == {"a"}
    with pytest.raises(ValueError):
        skipgram.continue_vectors(corpus, given, size=3)


def test_parts_grow_with_the_corpus(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(vectors, "Word2Vec", lambda **o: seen.append(o["numPartitions"]) or type("T", (), {"fit": staticmethod(lambda c: None)}))
    monkeypatch.setattr(vectors, "PART_TOKENS", 10)
    corpus = spark.createDataFrame([(["a"] * 30,), (["b"] * 71,), (None,)], "words array<string>")
    vectors.train_word_vectors(corpus)
    vectors.train_word_vectors(corpus.limit(0))
    assert seen == [11, vectors.TRAINING_PARTS]


def test_a_session_without_arrow_for_pandas(spark):
    words = spark.createDataFrame([(["a", "b", "a", "c"],), (["b", "c"],)], "words array<string>")
    given = spark.createDataFrame([("a", [1 / 3, 0.5])], "word string, vector array<double>")
    setting = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        got = {r["word"]: r["vector"] for r in skipgram.continue_vectors(words, given, size=2, passes=2).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", setting)
    assert set(got) == {"a", "b", "c"} and got["a"] == [1 / 3, 0.5] and all(len(v) == 2 for v in got.values())


def test_slopes_on_counts_are_the_mean_of_the_passes(monkeypatch):
    """Over many draws of windows and samples, a pass moves as the slope on the counts says."""
    monkeypatch.setattr(skipgram, "REPEATS", 10**6)
    rng = np.random.default_rng(0)
    vectors, contexts = rng.normal(size=(6, 3)), rng.normal(size=(6, 3))
    ids, sentence = np.array([0, 1, 2, 1, 3, 4]), np.array([0, 0, 0, 0, 1, 1])
    share, window, negatives, rate, turns = np.array([0.1, 0.2, 0.3, 0.1, 0.1, 0.2]), 2, 2, 1e-4, 6000
    near = np.zeros((6, 6))
    for i in range(6):
        for j in range(6):
            if i != j and sentence[i] == sentence[j] and abs(i - j) <= window:
                near[ids[i], ids[j]] += window + 1 - abs(i - j)
    seen, drawn = near.sum(axis=1), negatives * share
    blocks = [skipgram.count_slopes(near[a : a + 4], a, vectors, contexts, drawn, seen) for a in (0, 4)]
    moved = [np.zeros_like(vectors), np.zeros_like(contexts)]
    for turn in range(turns):
        own = vectors.copy(), contexts.copy()
        skipgram.train_part(ids, sentence, *own, np.zeros(6, bool), np.cumsum(share), window, negatives, rate, np.random.default_rng(turn))
        for total, new, old in zip(moved, own, (vectors, contexts)):
            total += new - old
    for side, total in enumerate(moved):
        slope = np.concatenate([b[side] for b in blocks]) / window
        np.testing.assert_allclose(total / rate / turns, -slope, atol=0.1)
    assert np.abs(blocks[1][1][1]).max() > 0.1  # a word without a neighbour is drawn too


def test_a_long_corpus_is_counted(spark, corpus, monkeypatch):
    monkeypatch.setattr(skipgram, "COUNTED_TOKENS", 1000)
    monkeypatch.setattr(skipgram, "_moves", None)  # no pass over the texts
    monkeypatch.setattr(skipgram.pairvectors, "BLOCK_ROWS", 5)
    fruit, metal = np.linspace(-0.5, 0.7, 16), np.linspace(0.6, -0.4, 16)
    given = spark.createDataFrame([("apple", fruit.tolist()), ("iron", metal.tolist()), ("absent", [1 / 3] * 16)], "word string, vector array<double>")
    texts = corpus.union(spark.createDataFrame([(["alone"],), (None,), ([None, "fig"],)], "words array<string>"))
    runs = [{r["word"]: r["vector"] for r in skipgram.continue_vectors(t, given, size=16, passes=2).collect()} for t in (texts, texts.repartition(3))]
    assert runs[0] == runs[1]
    got = {w: np.array(v) for w, v in runs[0].items()}
    assert set(got) == {*TOPICS[0], *TOPICS[1], "absent", "alone"}
    assert all(got[r["word"]].tolist() == r["vector"] for r in given.collect())
    assert cosine(got["plum"], fruit) > cosine(got["plum"], metal) and cosine(got["zinc"], metal) > cosine(got["zinc"], fruit)
    # The pairs are worth more than the steps from a length on, which grows with the square of the vocabulary.
    assert skipgram.counting_pays(10**7, 3_600, 5) and not skipgram.counting_pays(10**7, 10**5, 5)
