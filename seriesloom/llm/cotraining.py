"""Quality classifier by co-training of a text view and a page-metadata view.

Each view has a logistic model of its own, fitted on labelled rows. In every round each view labels the
unlabelled rows it is sure of, and the other view learns from them. At the end both views are
calibrated on labelled rows that no fit has seen, and their log-odds are added up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from seriesloom.llm.common import ship, stored

ship(__name__)

#: Most rows a fit sees; a larger set is thinned by a hash of the row.
MAX_TRAIN = 200_000
ROUNDS = 2
CONFIDENT = 0.98
SOURCES, LANGS = 64, 8
PENALTY = 1e-4

# Characters whose shares the text view sees, one feature each.
MARKS = "!|%$&*#.,?\n;:=<>{}[]()/\\\"'-_@+"
_CLASSES = np.zeros((256, len(MARKS) + 5))
for _i, _c in enumerate(MARKS):
    _CLASSES[ord(_c), _i] = 1.0
_CLASSES[65:91, -5] = _CLASSES[97:123, -4] = _CLASSES[48:58, -3] = _CLASSES[128:, -2] = _CLASSES[32, -1] = 1.0


def text_features(text: str | None) -> np.ndarray:
    """Shares of character classes, and how long and how repetitive words and lines are."""
    data = (text or "").encode()
    words, lines = data.split(), data.split(b"\n")
    shares = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _CLASSES / max(1, len(data))
    n = max(1, len(words))
    more = [
        math.log1p(len(words)), len(data) / n / 10, len(set(words)) / math.sqrt(n) / 10, len(set(lines)) / len(lines),
        math.log1p(len(data) / len(lines)), float(not words), sum(map(eq, words, words[1:])) / n,
    ]
    return np.concatenate([np.sqrt(shares), more])


@F.pandas_udf(ArrayType(DoubleType()))
def text_view(texts: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in texts])


def meta_view(source: str, lang: str, n_chars: str) -> Column:
    """Hashed source and language, and the length given with the page."""

    def one_of(name: str, count: int) -> Column:
        at = F.pmod(F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(count))
        return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")), lambda i: (i == at).cast("double"))

    length = F.log1p(F.greatest(F.coalesce(F.col(n_chars).cast("double"), F.lit(0.0)), F.lit(0.0)))
    return F.concat(one_of(source, SOURCES), one_of(lang, LANGS), F.array(length, length * length / 10))


@dataclass
class View:
    """A logistic model: weights, intercept and the two numbers of its calibration."""

    weights: Sequence[float]
    intercept: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, features: Column) -> Column:
        products = F.zip_with(features, F.lit(list(map(float, self.weights))), lambda x, w: x * w)
        return F.aggregate(products, F.lit(float(self.intercept)), lambda a, b: a + b)

    def log_odds(self, features: Column) -> Column:
        return F.lit(float(self.slope)) * self.margin(features) + F.lit(float(self.shift))


@dataclass
class Model:
    """Both views and the share of good labels; a view is None where labels cannot train one."""

    text: View | None
    meta: View | None
    share: float | None


def _fit(rows: DataFrame, features: Column, penalty: float = PENALTY) -> tuple[list[float], float]:
    ready = rows.select(array_to_vector(features).alias("features"), F.col("label").cast("double").alias("label"))
    fitted = LogisticRegression(regParam=penalty, maxIter=50, tol=1e-6).fit(ready)
    return fitted.coefficients.toArray().tolist(), float(fitted.intercept)


def _bounded(rows: DataFrame, most: int) -> DataFrame:
    count = rows.count()
    return rows if count <= most else rows.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 30)) < int((1 << 30) * most / count))


def fit_views(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    n_chars: str = "n_chars", label: str = "quality", rounds: int = ROUNDS, confident: float = CONFIDENT, most: int = MAX_TRAIN,
) -> Model:
    """Co-trains both views on ``docs`` with the labelled keys of ``labels``.

    A key with several labels takes their majority, good on a tie; null labels are ignored. A fifth of
    the labelled keys, by hash, is held back for the calibration. Without labels there is no view;
    with labels of one class only, or too few to hold some back, all rows get the share of good ones.
    """
    truth = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.avg(F.col(label).cast("double")).alias("vote"))
    truth = truth.select("key", (F.col("vote") >= 0.5).cast("int").alias("label"))
    rows = docs.select(F.col(key).alias("key"), text_view(F.col(text)).alias("text_view"), F.struct(
        F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(n_chars).alias("n_chars")).alias("meta"))
    rows = stored(rows.join(truth, "key", "left"), "features").withColumn("meta_view", meta_view("meta.source", "meta.lang", "meta.n_chars"))
    held = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(5)) == 0
    known = rows.where("label is not null")
    counts = known.groupBy(held.alias("held"), "label").count().collect()
    if not counts:
        return Model(None, None, None)
    share = sum(r["count"] for r in counts if r["label"]) / sum(r["count"] for r in counts)
    if len(counts) < 4:
        return Model(None, None, share)
    train, check = _bounded(known.where(~held), most), _bounded(known.where(held), most)
    unknown = rows.where("label is null")
    columns = {"text": F.col("text_view"), "meta": F.col("meta_view")}
    sets = dict.fromkeys(columns, train)
    sure = math.log(confident / (1 - confident))
    for turn in range(rounds + 1):
        views = {}
        for name, features in columns.items():
            view = View(*_fit(sets[name], features))
            scores = check.select(F.array(view.margin(features)).alias("margin"), "label")
            (slope,), shift = _fit(scores, F.col("margin"), 1e-2)
            views[name] = View(view.weights, view.intercept, slope, shift)
        if turn < rounds:
            for name, other in (("text", "meta"), ("meta", "text")):
                odds = views[other].log_odds(columns[other])
                taught = unknown.withColumn("odds", odds).where(F.abs("odds") >= sure).withColumn("label", (F.col("odds") > 0).cast("int"))
                sets[name] = train.unionByName(_bounded(taught.drop("odds"), most))
    return Model(views["text"], views["meta"], share)


def score_quality(
    docs: DataFrame, model: Model, text: str = "text", source: str = "source", lang: str = "lang", n_chars: str = "n_chars"
) -> DataFrame:
    """Every row as ``row`` (all its columns) with ``p_text``, ``p_meta``, ``score`` and ``kept``.

    ``score`` is the probability of good quality, from the sum of both calibrated log-odds less the
    share's own; a row is kept at one half. Scoring needs no shuffle. Null and empty texts have
    features of their own (all zero but for the flag); null metadata counts as empty and 0. Without a
    trained view the score is the share of good labels, or null where there were none, and then
    nothing is rejected. Repeated rows get equal scores.
    """
    rows = docs.select(F.struct("*").alias("row"))
    one = F.lit(1.0)
    if model.text is None or model.meta is None:
        share = F.lit(model.share).cast("double")
        return rows.select("row", share.alias("p_text"), share.alias("p_meta"), share.alias("score"), F.coalesce(share >= 0.5, F.lit(True)).alias("kept"))
    odds = rows.select(
        "row", model.text.log_odds(text_view(F.col(f"row.{text}"))).alias("a"),
        model.meta.log_odds(meta_view(f"row.{source}", f"row.{lang}", f"row.{n_chars}")).alias("b"),
    )
    both = F.col("a") + F.col("b") - F.lit(math.log(model.share / (1 - model.share)))
    return odds.select(
        "row", (one / (one + F.exp(-F.col("a")))).alias("p_text"), (one / (one + F.exp(-F.col("b")))).alias("p_meta"),
        (one / (one + F.exp(-both))).alias("score"), (both >= 0).alias("kept"),
    )
