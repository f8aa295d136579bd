import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from seriesloom.functions.text import spaced_tokens
from seriesloom.operators import tfidf, vectors, wordstats

TEXTS = ["banana bandana ban band bananas", "banana band ban cat cats catnap", "nap naps banana  ban", "a bb cat"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").persist()


@pytest.fixture(scope="module")
def counts(docs):
    return wordstats.token_counts(docs, spaced_tokens(F.col("text"))).persist()


def plain_counts():
    return collections.Counter(w for t in TEXTS for w in t.split())


def test_cohesion(counts):
    freq = collections.Counter()
    for w, n in plain_counts().items():
        for k in range(1, len(w) + 1):
            freq[w[:k]] += n
    want = {p: (f / freq[p[0]]) ** (1 / (len(p) - 1)) for p, f in freq.items() if len(p) > 1 and f >= 2}
    want = {p: s for p, s in want.items() if s >= 0.5}
    got = {r["token"]: r["score"] for r in wordstats.cohesion_scores(counts, 2, 0.5).collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def test_branching_entropy(counts):
    after = collections.defaultdict(collections.Counter)
    for w, n in plain_counts().items():
        for k in range(1, len(w)):
            after[w[:k]][w[k]] += n
    got = {r["token"]: r["entropy"] for r in wordstats.right_branching_entropy(counts, min_frequency=1).collect()}
    assert got.keys() == after.keys()
    for p, c in after.items():
        total = sum(c.values())
        assert got[p] == pytest.approx(-sum(v / total * math.log(v / total) for v in c.values()), abs=1e-12)
    assert math.copysign(1, got["c"]) == 1


LONG = ["internationalisation", "internationalisations", "internationalise", "international", "counterrevolutionaries"]


def test_no_length_is_cut_off(spark):
    words = LONG * 3 + [LONG[0] + "undanderes"] * 2
    docs = spark.createDataFrame([(0, " ".join(words))], "doc_id int, text string")
    counts = wordstats.token_counts(docs, spaced_tokens(F.col("text"))).persist()
    freq, after = collections.Counter(), collections.defaultdict(collections.Counter)
    for w in words:
        for k in range(1, len(w) + 1):
            freq[w[:k]] += 1
            if k < len(w):
                after[w[:k]][w[k]] += 1
    for step in (1, 3, 8):
        found = {r["prefix"]: r["freq"] for r in wordstats.prefix_counts(counts, 4, step).collect()}
        assert {p: n for p, n in found.items() if n >= 4} == {p: n for p, n in freq.items() if n >= 4}
    scores = {r["token"] for r in wordstats.cohesion_scores(counts, 5, 0.0).collect()}
    assert scores == {p for p, n in freq.items() if n >= 5 and len(p) > 1} and LONG[0] in scores
    entropy = {r["token"]: r["freq"] for r in wordstats.right_branching_entropy(counts, min_frequency=5).collect()}
    assert entropy == {p: sum(c.values()) for p, c in after.items() if freq[p] >= 5}
    right = spark.createDataFrame([("undanderes", 1), ("s", -1)], "r string, polarity int")
    nouns = {r["token"]: (r["pos"], r["neg"]) for r in wordstats.noun_scores(counts, right, min_score=-1).collect()}
    assert nouns[LONG[0]] == (2, 3) and nouns["counterrevolutionarie"] == (0, 3)


def test_noun_scores_and_compounds(spark, counts):
    right = spark.createDataFrame([("", 1), ("s", 1), ("ana", -1)], "r string, polarity int")
    got = {r["token"]: (r["pos"], r["neg"], r["score"]) for r in wordstats.noun_scores(counts, right, min_score=-1).collect()}
    assert got["banana"] == (4, 0, 1.0) and got["ban"] == (3, 3, 0.0) and got["cat"] == (3, 0, 1.0) and got["nap"] == (2, 0, 1.0)
    assert got["band"] == (2, 1, pytest.approx(1 / 3))
    nouns = wordstats.noun_scores(counts, right, min_score=0.3).persist()
    flags = {r["token"]: r["is_compound"] for r in wordstats.flag_compounds(nouns).collect()}
    assert flags["catnap"] and not flags["banana"] and not flags["cat"]


def plain_left(token, scores):
    if len(token) <= 2:
        return token
    return max((token[:k] for k in range(2, len(token) + 1)), key=lambda p: (scores.get(p, 0.0), len(p)))


@pytest.mark.parametrize("scores", [{"ban": 0.9, "band": 0.9, "cat": 0.5}, {"ba": -1.0, "banana": -0.5}, {}, {"catnap": 0.2, "ca": 0.2}])
def test_left_parts(spark, docs, counts, scores):
    table = spark.createDataFrame(list(scores.items()), "token string, score double")
    lefts = wordstats.left_parts(counts, table).persist()
    assert {r["token"]: r["left"] for r in lefts.collect()} == {t: plain_left(t, scores) for t in plain_counts()}
    got = wordstats.tokenise(docs, "doc_id", spaced_tokens(F.col("text")), lefts)
    assert {r["doc_id"]: r["tokens"] for r in got.collect()} == {i: [plain_left(w, scores) for w in t.split()] for i, t in enumerate(TEXTS)}


def test_left_parts_sorts_scored_prefixes_only(spark):
    counts = spark.createDataFrame([(f"abcdef{i}", 1) for i in range(20)], "token string, n long")
    scores = spark.createDataFrame([("ab", 0.5), ("zzz", 0.1), ("zzzz", 0.1), ("zzzzz", 0.1)], "token string, score double")
    assert {r["left"] for r in wordstats.left_parts(counts, scores).collect()} == {"ab"}
    plan = wordstats.left_parts(counts, scores)._jdf.queryExecution().optimizedPlan().toString()
    grouped = plan.index("max_by")
    assert "isnotnull(score" in plan[grouped:]
    worse = spark.createDataFrame([("abcdef1", -1.0), ("abcdef", -2.0)], "token string, score double")
    assert {r["token"]: r["left"] for r in wordstats.left_parts(counts, worse).collect()}["abcdef1"] == "abcde"


def plain_pack(text, limit):
    if len(text) < limit:
        return [text]
    words, done, start, size = text.split(" "), [], 0, 0
    for i, word in enumerate(words):
        if size + len(word) >= limit:
            if i > start:
                done.append(" ".join(words[start:i]))
            start, size = i, 0
        size += len(word)
    return done + [" ".join(words[start:])] if size else done


def test_pack_words(spark):
    rng = random.Random(3)
    texts = [" ".join("x" * rng.randint(0, 9) for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["y" * 50, "a " + "y" * 50 + " b", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = collections.defaultdict(list)
    for r in wordstats.chunks(df, "doc_id", "text", 20).orderBy("doc_id", "piece").collect():
        got[r["doc_id"]].append(r["chunk"])
    assert [got[i] for i in range(len(texts))] == [plain_pack(t, 20) for t in texts]


def test_tfidf(spark):
    texts = ["red red blue x", "Red green", "blue blue blue", "yellow", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    vocabulary = tfidf.fit_tfidf(df, max_df=0.5, min_df=0.25).persist()
    idf = math.log(6 / 3) + 1
    assert {r["term"]: r["idf"] for r in vocabulary.collect()} == {"red": pytest.approx(idf), "blue": pytest.approx(idf)}
    got = {(r["doc_id"], r["term"]): r["tfidf"] for r in tfidf.transform_tfidf(df, vocabulary, "doc_id").collect()}
    a = 1 + math.log(2)
    assert got == {(0, "red"): pytest.approx(a / math.hypot(a, 1)), (0, "blue"): pytest.approx(1 / math.hypot(a, 1)), (1, "red"): 1.0, (2, "blue"): 1.0}
    top = tfidf.fit_tfidf(df, max_df=1.0, min_df=0.0, max_features=1).collect()
    assert [(r["term"], r["total"]) for r in top] == [("blue", 4)]
    assert [r["term"] for r in tfidf.rank_by_idf(vocabulary, 1).collect()] == ["blue"]


def test_vocabulary_words(spark):
    df = spark.createDataFrame([(1, "Red red blue. red"), (2, "x")], "doc_id int, text string")
    vocabulary = spark.createDataFrame([("red",), ("blue",)], "term string")
    assert {r["doc_id"]: r["words"] for r in tfidf.checked_corpus(df, vocabulary, "doc_id").collect()} == {1: ["red", "red"]}
    assert tfidf.checked_corpus(df, vocabulary, "doc_id", normalize=True).first()["words"] == ["red", "red", "red"]


def test_term_map_is_the_svd(spark):
    np = pytest.importorskip("numpy")
    rng = np.random.default_rng(1)
    matrix = rng.random((30, 5)) * (rng.random((30, 5)) > 0.3)
    rows = [(i, f"t{j}", float(matrix[i, j])) for i in range(30) for j in range(5) if matrix[i, j]]
    vocabulary = spark.createDataFrame([(f"t{j}",) for j in range(5)], "term string")
    got = tfidf.term_map(spark.createDataFrame(rows, "doc_id int, term string, tfidf double"), vocabulary, "doc_id").orderBy("term").collect()
    _, s, vt = np.linalg.svd(matrix)
    want = vt[:2].T * s[:2]
    want = want * np.sign(want[np.abs(want).argmax(axis=0), range(2)])
    assert np.allclose([[r["axis1"], r["axis2"]] for r in got], want, atol=1e-8)


def test_anchor_and_document_similarity(spark):
    words = spark.createDataFrame([("up", [1.0, 0.0]), ("flat", [0.0, 2.0]), ("mix", [1.0, 1.0]), ("zero", [0.0, 0.0])], "word string, vector array<float>")
    anchors = words.select(F.col("word").alias("name"), "vector")
    scored = vectors.anchor_similarity(words, "vector", anchors, {"up": "u", "flat": "f", "none": "n"}).drop("vector").persist()
    got = {r["word"]: (r["u"], r["f"], r["n"]) for r in scored.collect()}
    half = pytest.approx(0.5**0.5)
    assert got == {"up": (1.0, 0.0, None), "flat": (0.0, 1.0, None), "mix": (half, half, None), "zero": (None, None, None)}
    corpus = spark.createDataFrame([(1, ["up", "up", "mix", "unknown"]), (2, ["unknown"])], "doc_id int, words array<string>")
    docs = {r["doc_id"]: (r["u"], r["coverage"]) for r in vectors.document_similarity(corpus, "doc_id", "words", scored, ["u"]).collect()}
    assert docs == {1: (pytest.approx((2 + 0.5**0.5) / 3), 0.75), 2: (None, 0.0)}


def test_overlay_and_training(spark):
    a = spark.createDataFrame([("x", [1.0]), ("y", [2.0])], "word string, vector array<float>")
    b = spark.createDataFrame([("y", [3.0]), ("z", [4.0])], "word string, vector array<float>")
    assert {r["word"]: r["vector"] for r in vectors.overlay_vectors(a, b).collect()} == {"x": [1.0], "y": [3.0], "z": [4.0]}
    corpus = spark.createDataFrame([(["a", "b", "c"] * 5,), (["a", "d"],)], "words array<string>")
    model = vectors.train_word_vectors(corpus, size=8)
    assert {r["word"] for r in model.getVectors().collect()} == set("abcd") and model.getVectorSize() == 8


def test_texts_do_not_move(spark, docs):
    """Words are looked up where the texts are read; what moves by document is aggregated."""
    vocabulary = tfidf.fit_tfidf(docs, min_df=0.0, max_df=1.0).persist()
    weights = tfidf.transform_tfidf(docs, vocabulary, "doc_id")
    words = tfidf.checked_corpus(docs, vocabulary, "doc_id")
    scores = spark.createDataFrame([("ban", 1.0), ("cat", 0.5)], "word string, up double")
    corpus = docs.select("doc_id", F.split("text", " ").alias("words"))
    similar = vectors.document_similarity(corpus, "doc_id", "words", scores, ["up"])
    for df in (weights, words, similar):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        assert any("BroadcastHashJoin" in line for line in lines)
        moved = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(doc_id" in line]
        assert moved and not any("REPARTITION" in line for line in lines)
        first = moved[-1]
        assert "Aggregate" in lines[first + 1], lines[first : first + 2]


def test_one_scan_gives_both_counts(docs):
    got = {r["term"]: (r["df"], r["total"]) for r in tfidf.term_statistics(docs).collect()}
    words = [t.split() for t in TEXTS]
    for term, (df, total) in got.items():
        assert df == sum(term in w for w in words) and total == sum(w.count(term) for w in words)


def test_a_large_vocabulary_is_refused(spark):
    many = spark.range(tfidf.MAP_TERMS + 1).select(F.concat(F.lit("t"), "id").alias("term"))
    weights = spark.createDataFrame([(1, "t1", 1.0)], "doc_id int, term string, tfidf double")
    with pytest.raises(ValueError):
        tfidf.term_map(weights, many, "doc_id")
