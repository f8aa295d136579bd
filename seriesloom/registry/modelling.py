"""Queries of feature preparation, model fits, evaluation and the end-to-end jobs."""

from __future__ import annotations

import zlib

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seriesloom.operators import (
    classify,
    cluster,
    dense,
    evaluate,
    exact_tree,
    pairwise,
    paths,
    prepare,
    regress,
    relational,
    series,
    split,
    sweeps,
)
from seriesloom.plans import news_score, next_day, species
from seriesloom.registry.base import DATED, PANEL, SCORED, daily_score, dated_documents, panel, query
from seriesloom.registry.textual import _ANCHOR_NAMES, _SIMILAR, _right_parts, _similar
from seriesloom.session import materialise, scratch_path, shared_dir, spread
from seriesloom.sources.readers import read_table
from seriesloom.sources.store import read_or_build, write_table

SEED = next_day.SEED
_LAB = """lab AS (SELECT * FROM (SELECT *, lead(cap) OVER (PARTITION BY series ORDER BY date) AS label,
  lead(date) OVER (PARTITION BY series ORDER BY date) AS label_date FROM panel) WHERE label_date IS NOT NULL)"""


def _labelled(spark, d):
    return series.labelled_rows(panel(spark, d), "series", "date", "cap")


def _naive(spark, d):
    return _labelled(spark, d).withColumn("prediction", F.col("cap"))


# ---- evaluation


@query(
    f"""WITH {PANEL}, {_LAB} SELECT series, CAST(count(*) AS BIGINT) AS n,
    round(1 - sum((label - cap) * (label - cap)) / (var_pop(label) * count(*)), 6) AS r2, round(avg(abs(label - cap)), 4) AS mae
    FROM lab GROUP BY series"""
)
def naive_forecast_scores(spark, d):
    """R2 and mean absolute error of "tomorrow is like today" per nation."""
    scores = evaluate.regression_scores(_naive(spark, d), ["series"])
    return scores.select("series", "n", F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"))


@query(
    f"WITH {PANEL}, {_LAB} SELECT round(1 - sum((label - avg_price) * (label - avg_price)) / (var_pop(label) * count(*)), 6) AS r2 FROM lab"
)
def r_squared(spark, d):
    """R2 of one fixed predictor over all rows."""
    rows = _labelled(spark, d).withColumn("prediction", F.col("avg_price"))
    return rows.agg(F.round(evaluate.r2_column(), 6).alias("r2"))


@query(f"WITH {PANEL}, {_LAB} SELECT round(avg(abs(label - avg_price)), 4) AS mae FROM lab")
def mean_absolute_error(spark, d):
    """Mean absolute error of one fixed predictor over all rows."""
    rows = _labelled(spark, d).withColumn("prediction", F.col("avg_price"))
    return rows.agg(F.round(evaluate.mae_column(), 4).alias("mae"))


@query(
    """SELECT lang AS split, CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN quality = CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END THEN 1e0 ELSE 0e0 END), 6) AS accuracy
    FROM documents JOIN labels USING (doc_id) GROUP BY lang"""
)
def accuracy(spark, d):
    """Accuracy of a length rule for the quality label, per language."""
    docs = read_table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    rows = docs.join(read_table(spark, d, "labels"), "doc_id").select(
        F.col("lang").alias("split"), F.col("quality").alias("label"), (F.col("n_chars") > 1000).cast("int").alias("prediction")
    )
    return evaluate.accuracy_scores(rows).withColumn("accuracy", F.round("accuracy", 6))


# ---- splits, scaling, terms


@query(
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey || '|{SEED}'), o_orderkey) <= ceil(count(*) OVER () * 0.25e0)
    THEN 'test' ELSE 'train' END AS split FROM orders"""
)
def exact_split(spark, d):
    """Seeded 75/25 split, exact to the row."""
    return split.exact_split(read_table(spark, d, "orders").select("o_orderkey"), "o_orderkey", SEED)


_QUOTAS = """q AS (SELECT p_size, n, n - fl - CASE WHEN row_number() OVER (ORDER BY round(fl - ex, 9), p_size) <= tr - sum(fl) OVER () THEN 1 ELSE 0 END AS quota
  FROM (SELECT p_size, n, tr, n * tr / total AS ex, floor(n * tr / total) AS fl FROM
    (SELECT p_size, count(*) AS n, sum(count(*)) OVER () AS total, sum(count(*)) OVER () - ceil(sum(count(*)) OVER () * 0.25e0) AS tr FROM part GROUP BY p_size)))"""


@query(
    f"""WITH {_QUOTAS} SELECT p_partkey, p_size, CASE WHEN row_number() OVER (PARTITION BY p_size ORDER BY md5(p_partkey || '|{SEED}'), p_partkey) <= quota
    THEN 'test' ELSE 'train' END AS split FROM part JOIN q USING (p_size)"""
)
def stratified_split(spark, d):
    """Seeded split that keeps the class shares."""
    return split.stratified_split(read_table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey", "p_size", SEED)


@query(
    f"""WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || '|{SEED}'), o_orderkey) > ceil(count(*) OVER () * 0.25e0) AS rest FROM orders),
    b AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || '|{SEED}v'), o_orderkey) <= ceil(count(*) OVER () * 0.2e0) AS valid FROM a WHERE rest)
    SELECT o_orderkey, CASE WHEN valid THEN 'valid' ELSE 'train' END AS split FROM b UNION ALL SELECT o_orderkey, 'test' FROM a WHERE NOT rest"""
)
def three_way_split(spark, d):
    """Test, validation and train part."""
    return split.three_way_split(read_table(spark, d, "orders").select("o_orderkey"), "o_orderkey", SEED)


@query(
    f"SELECT o_orderkey, CASE WHEN substr(md5(o_orderkey || '|{SEED}'), 1, 8) < '40000000' THEN 'test' ELSE 'train' END AS split FROM orders"
)
def threshold_split(spark, d):
    """Seeded split by a hash threshold: one pass, the share met on average."""
    return split.threshold_split(read_table(spark, d, "orders").select("o_orderkey"), "o_orderkey", SEED)


_MARKED = f"""m AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey || '|{SEED}'), o_orderkey) <= ceil(count(*) OVER () * 0.25e0)
  THEN 'test' ELSE 'train' END AS split FROM orders)"""


def _split_orders(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return split.exact_split(orders, "o_orderkey", SEED)


@query(
    f"""WITH {_MARKED}, s AS (SELECT avg(o_totalprice) AS a, stddev_pop(o_totalprice) AS b, avg(o_custkey) AS c, stddev_pop(o_custkey) AS e FROM m WHERE split = 'train')
    SELECT o_orderkey, split, round((o_totalprice - a) / b, 6) AS o_totalprice, round((o_custkey - c) / e, 6) AS o_custkey FROM m, s"""
)
def zscore_scaling(spark, d):
    """Two columns scaled by the train part's mean and deviation."""
    rows = _split_orders(spark, d)
    columns = ["o_totalprice", "o_custkey"]
    scaled = prepare.fit_zscore(rows.where("split = 'train'"), columns).transform(rows)
    return scaled.select("o_orderkey", "split", *[F.round(c, 6).alias(c) for c in columns])


@query(
    f"""WITH {_MARKED}, s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM m WHERE split = 'train')
    SELECT o_orderkey, split, round((o_totalprice - a) / (b - a), 6) AS o_totalprice FROM m, s"""
)
def minmax_scaling(spark, d):
    """A column scaled by the train part's range, not clipped."""
    rows = _split_orders(spark, d).drop("o_custkey")
    scaled = prepare.fit_minmax(rows.where("split = 'train'"), ["o_totalprice"]).transform(rows)
    return scaled.withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    """SELECT p_partkey, round(x, 6) AS t0, round(x*x, 6) AS t1, round(x*x*x, 6) AS t2, round(y, 6) AS t3, round(x*y, 6) AS t4, round(x*x*y, 6) AS t5,
    round(y*y, 6) AS t6, round(x*y*y, 6) AS t7, round(y*y*y, 6) AS t8 FROM (SELECT p_partkey, p_size / 10e0 AS x, length(p_name) / 10e0 AS y FROM part)"""
)
def polynomial_terms(spark, d):
    """Terms up to degree three of two features."""
    rows = read_table(spark, d, "part").select("p_partkey", (F.col("p_size") / 10.0).alias("x"), (F.length("p_name") / 10.0).alias("y"))
    table, names = prepare.polynomial_columns(rows, ["x", "y"], 3, "t")
    return table.select("p_partkey", *[F.round(n, 6).alias(n) for n in names])


@query("SELECT p_brand, min(p_partkey) AS first_key, CAST(row_number() OVER (ORDER BY min(p_partkey), p_brand) - 1 AS INTEGER) AS label_index FROM part GROUP BY p_brand")
def label_dictionary(spark, d):
    """Classes numbered in order of first appearance."""
    return prepare.label_dictionary(read_table(spark, d, "part"), "p_brand", "p_partkey")


@query("SELECT vec_id, " + ", ".join(f"CASE WHEN label = {i} THEN 1e0 ELSE 0e0 END AS c{i}" for i in range(10)) + " FROM embeddings")
def one_hot(spark, d):
    """Class index as ten indicator columns."""
    encoded = prepare.one_hot(read_table(spark, d, "embeddings").select("vec_id", "label"), "label")
    x = vector_to_array("one_hot")
    return encoded.select("vec_id", *[x[i].alias(f"c{i}") for i in range(10)])


# ---- linear regression


def _line_items(spark, d):
    rows = read_table(spark, d, "lineitem").select("l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return prepare.assemble(rows, ["l_quantity", "l_discount"]).withColumnRenamed("l_extendedprice", "label")


def _closed_form(penalty: str) -> str:
    return f"""WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
      var_pop(l_quantity) * count(*) + {penalty} AS s11, var_pop(l_discount) * count(*) + {penalty} AS s22, covar_pop(l_quantity, l_discount) * count(*) AS s12,
      covar_pop(l_quantity, l_extendedprice) * count(*) AS sy1, covar_pop(l_discount, l_extendedprice) * count(*) AS sy2 FROM lineitem),
    w AS (SELECT *, (s22 * sy1 - s12 * sy2) / (s11 * s22 - s12 * s12) AS w1, (s11 * sy2 - s12 * sy1) / (s11 * s22 - s12 * s12) AS w2 FROM s)
    SELECT 'intercept' AS term, round(my - w1 * m1 - w2 * m2, 3) AS coefficient FROM w
    UNION ALL SELECT 'l_quantity', round(w1, 3) FROM w UNION ALL SELECT 'l_discount', round(w2, 3) FROM w"""


def _coefficients(model, names, spark):
    return regress.coefficient_table(model, names, spark).withColumn("coefficient", F.round("coefficient", 3))


@query(_closed_form("0"))
def least_squares(spark, d):
    """Coefficients of price on quantity and discount."""
    return _coefficients(regress.fit_ols(_line_items(spark, d)), ["l_quantity", "l_discount"], spark)


@query(_closed_form("1e3"))
def ridge(spark, d):
    """The same with a squared penalty of 1,000."""
    return _coefficients(regress.fit_ridge(_line_items(spark, d), 1000.0), ["l_quantity", "l_discount"], spark)


@query(
    """WITH s AS (SELECT avg(l_quantity) AS m, avg(l_extendedprice) AS my, covar_pop(l_quantity, l_extendedprice) AS c, var_pop(l_quantity) AS v FROM lineitem),
    w AS (SELECT *, sign(c) * greatest(abs(c) - 1000, 0) / v AS w FROM s)
    SELECT 'intercept' AS term, round(my - w * m, 3) AS coefficient FROM w UNION ALL SELECT 'l_quantity', round(w, 3) FROM w"""
)
def lasso(spark, d):
    """Price on quantity with an absolute penalty of 1,000."""
    rows = prepare.assemble(read_table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("label"), "l_quantity"), ["l_quantity"])
    return _coefficients(regress.fit_lasso(rows, 1000.0), ["l_quantity"], spark)


@query(
    """SELECT 'l_extendedprice' AS target, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept FROM lineitem
    UNION ALL SELECT 'l_discount', round(regr_slope(l_discount, l_quantity), 6), round(regr_intercept(l_discount, l_quantity), 6) FROM lineitem
    UNION ALL SELECT 'l_tax', round(regr_slope(l_tax, l_quantity), 6), round(regr_intercept(l_tax, l_quantity), 6) FROM lineitem"""
)
def least_squares_per_target(spark, d):
    """One line per target on the same feature."""
    targets = ["l_extendedprice", "l_discount", "l_tax"]
    rows = prepare.assemble(read_table(spark, d, "lineitem").select("l_quantity", *targets), ["l_quantity"])
    rows = materialise(rows)
    models = regress.fit_ols_per_target(rows, targets)
    table = [(t, round(float(m.coefficients[0]), 6) + 0.0, round(float(m.intercept), 6) + 0.0) for t, m in models.items()]
    return spark.createDataFrame(table, "target string, slope double, intercept double")


# ---- next-day forecasts

_FEATURES = ["n_orders", "avg_price", "max_price"]


def _forecast(spark, d, kind):
    return next_day.run(materialise(panel(spark, d)), "series", "date", "cap", _FEATURES, kind, SEED)


def _score_rows(run):
    return run.scores.select("split", "n", F.round("r2", 4).alias("r2"), F.round("mae", 2).alias("mae"))


_DATE_INT = "year(date) * 10000 + month(date) * 100 + day(date)"
_TREND = f"""{_LAB}, cut AS (SELECT *, {_DATE_INT} AS x, CASE WHEN row_number() OVER (ORDER BY md5(series || '|' || date || '|{SEED}'))
    <= ceil(count(*) OVER () * 0.25e0) THEN 'test' ELSE 'train' END AS split FROM lab),
  fit AS (SELECT regr_slope(label, x) AS b, regr_intercept(label, x) AS a FROM cut WHERE split = 'train')"""


@query(
    f"""WITH {PANEL}, {_TREND} SELECT split, CAST(count(*) AS BIGINT) AS n,
    round(1 - sum((label - a - b * x) ** 2) / (var_pop(label) * count(*)), 4) AS r2, round(avg(abs(label - a - b * x)), 2) AS mae FROM cut, fit GROUP BY split"""
)
def trend_scores(spark, d):
    """Next-day forecast from the date alone: scores of both parts."""
    return _score_rows(next_day.run(materialise(panel(spark, d)), "series", "date", "cap", [], "ols", SEED))


@query(
    f"""WITH {PANEL}, {_TREND}, newest AS (SELECT series, max(date) + 1 AS date FROM panel GROUP BY series)
    SELECT series, date, round(a + b * ({_DATE_INT}), 2) AS prediction FROM newest, fit"""
)
def trend_forecast(spark, d):
    """Value predicted from the date alone for the day after each nation's newest row."""
    run = next_day.run(materialise(panel(spark, d)), "series", "date", "cap", [], "ols", SEED)
    return run.next_day.withColumn("prediction", F.round("prediction", 2))


@query()
def forecast_ols(spark, d):
    """Next-day forecast by least squares: scores of both parts."""
    return _score_rows(_forecast(spark, d, "ols"))


@query()
def forecast_poly(spark, d):
    """The same on degree-two terms."""
    return _score_rows(_forecast(spark, d, "poly"))


@query()
def forecast_lasso(spark, d):
    """The same on scaled degree-three terms with an absolute penalty."""
    return _score_rows(_forecast(spark, d, "lasso"))


@query()
def forecast_ridge(spark, d):
    """The same with a squared penalty."""
    return _score_rows(_forecast(spark, d, "ridge"))


@query()
def forecast_boosted(spark, d):
    """Boosted trees on absolute error, stopped on the validation part: scores of the three parts."""
    run, _ = next_day.run_boosted(materialise(panel(spark, d)), "series", "date", "cap", _FEATURES, SEED)
    return _score_rows(run)


@query()
def boosting_history(spark, d):
    """Train and validation loss per boosting round."""
    _, history = next_day.run_boosted(materialise(panel(spark, d)), "series", "date", "cap", _FEATURES, SEED)
    return history


@query()
def forecast_dense(spark, d):
    """Two dense layouts on absolute error, stopped on the validation part: scores of the three parts."""
    scores, _ = next_day.run_dense(materialise(panel(spark, d)), "series", "date", "cap", _FEATURES, SEED)
    return scores.select("layout", "split", "n", F.round("r2", 4).alias("r2"), F.round("mae", 2).alias("mae"))


@query()
def next_day_forecast(spark, d):
    """Value predicted for the day after each nation's newest row."""
    return _forecast(spark, d, "ols").next_day


def _chart(spark, d, kind):
    return series.actual_and_predicted(_forecast(spark, d, kind).predictions, "series", "date", "cap", limit=200)


@query()
def forecast_chart(spark, d):
    """Actual and predicted value of the last 200 days per nation."""
    return _chart(spark, d, "ols")


@query()
def forecast_chart_poly(spark, d):
    """The same by degree-two terms."""
    return _chart(spark, d, "poly")


@query()
def forecast_chart_lasso(spark, d):
    """The same with an absolute penalty."""
    return _chart(spark, d, "lasso")


@query()
def forecast_chart_ridge(spark, d):
    """The same with a squared penalty."""
    return _chart(spark, d, "ridge")


# ---- classifiers


def _binary(spark, d):
    rows = read_table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("class"), *_dims(2))
    return species.binary_rows(rows, "class", "1", "0", ["x0", "x1"], "vec_id", SEED)


def _dims(n):
    return [F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(n)]


def _orders_by_status(spark, d, valid=False):
    rows = read_table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.month("o_orderdate").cast("double").alias("month"), F.year("o_orderdate").cast("double").alias("year")
    )
    return species.multi_rows(rows, "o_orderstatus", ["o_totalprice", "month", "year"], "o_orderkey", SEED, valid)


_STATUS_COLUMNS = ["o_totalprice", "month", "year"]


def _accuracy_rows(scores):
    return scores.select("split", "n", F.round("accuracy", 4).alias("accuracy"))


@query()
def linear_svc(spark, d):
    """Two classes by two scaled features."""
    _, scores = species.fit_and_score(_binary(spark, d), ["x0", "x1"], classify.fit_linear_svc)
    return _accuracy_rows(scores)


@query()
def one_vs_one_svc(spark, d):
    """All classes by pairwise linear classifiers."""
    rows, _ = _orders_by_status(spark, d)
    _, scores = species.fit_and_score(rows, _STATUS_COLUMNS, pairwise.fit_all_pairs, scaled=True)
    return _accuracy_rows(scores)


@query()
def one_vs_one_svc_poly(spark, d):
    """The same on degree-two terms."""
    rows, _ = _orders_by_status(spark, d)
    _, scores = species.fit_and_score(rows, _STATUS_COLUMNS, pairwise.fit_all_pairs, scaled=True, degree=2)
    return _accuracy_rows(scores)


# Weights of three given pairwise classifiers over 64 elements, and their intercepts.
_PAIRS = {pair: ([((5 * i + 3 * k) % 11 - 5) / 8 for i in range(64)], (k - 1) / 16) for k, pair in enumerate([(0, 1), (0, 2), (1, 2)])}


def _wins(low, high):
    weights, intercept = _PAIRS[low, high]
    return f"CAST({intercept!r}e0 + list_inner_product(CAST(embedding AS DOUBLE[]), CAST({weights!r} AS DOUBLE[])) > 0 AS INTEGER)"


@query(
    f"""WITH w AS (SELECT vec_id, {_wins(0, 1)} AS w01, {_wins(0, 2)} AS w02, {_wins(1, 2)} AS w12 FROM embeddings),
    v AS (SELECT vec_id, (1 - w01) + (1 - w02) AS v0, w01 + (1 - w12) AS v1, w02 + w12 AS v2 FROM w)
    SELECT vec_id, CASE WHEN v0 >= v1 AND v0 >= v2 THEN 0e0 WHEN v1 >= v2 THEN 1e0 ELSE 2e0 END AS prediction FROM v"""
)
def pairwise_votes(spark, d):
    """Class by the votes of three given pairwise classifiers over all elements."""
    models = {pair: classify.LinearWeights(*w) for pair, w in _PAIRS.items()}
    names = [f"x{i}" for i in range(64)]
    rows = prepare.assemble(read_table(spark, d, "embeddings").select("vec_id", *_dims(64)), names)
    return classify.predict_one_vs_one(rows, models).select("vec_id", "prediction")


@query()
def one_vs_rest_svc(spark, d):
    """Three classes by one classifier per class."""
    rows, _ = _orders_by_status(spark, d)
    _, scores = species.fit_and_score(rows, _STATUS_COLUMNS, classify.fit_one_vs_rest, scaled=True)
    return _accuracy_rows(scores)


@query()
def decision_tree(spark, d):
    """Gini tree with depth and leaf limits."""
    rows, _ = _orders_by_status(spark, d)
    _, scores = species.fit_and_score(rows, _STATUS_COLUMNS, lambda t: classify.fit_tree(t, 7, 6))
    return _accuracy_rows(scores)


@query(
    """WITH o AS (SELECT o_orderkey, o_orderstatus AS s, month(o_orderdate) AS m FROM orders),
    t AS (SELECT unnest(range(1, 12)) AS k),
    g AS (SELECT k, CAST(count(*) FILTER (m <= k) AS DOUBLE) AS nl, CAST(count(*) FILTER (m > k) AS DOUBLE) AS nr,
      count(*) FILTER (m <= k AND s = 'F') AS lf, count(*) FILTER (m <= k AND s = 'O') AS lo, count(*) FILTER (m <= k AND s = 'P') AS lp,
      count(*) FILTER (m > k AND s = 'F') AS rf, count(*) FILTER (m > k AND s = 'O') AS ro, count(*) FILTER (m > k AND s = 'P') AS rp FROM o, t GROUP BY k),
    b AS (SELECT *, nl * (1 - (lf * lf + lo * lo + lp * lp) / (nl * nl)) + nr * (1 - (rf * rf + ro * ro + rp * rp) / (nr * nr)) AS cost FROM g ORDER BY cost, k LIMIT 1)
    SELECT CAST(0 AS INTEGER) AS node, 'month' AS feature, k + 0.5e0 AS threshold, round(1 - ((lf + rf) ** 2 + (lo + ro) ** 2 + (lp + rp) ** 2) / ((nl + nr) ** 2), 9) AS gini,
      CAST(nl + nr AS BIGINT) AS samples FROM b
    UNION ALL SELECT CAST(1 AS INTEGER), NULL, NULL, round(1 - (lf * lf + lo * lo + lp * lp) / (nl * nl), 9), CAST(nl AS BIGINT) FROM b
    UNION ALL SELECT CAST(2 AS INTEGER), NULL, NULL, round(1 - (rf * rf + ro * ro + rp * rp) / (nr * nr), 9), CAST(nr AS BIGINT) FROM b"""
)
def tree_stump(spark, d):
    """Best single cut of the months for the status classes, as node rows."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.month("o_orderdate").cast("double").alias("month"))
    dictionary = materialise(prepare.label_dictionary(orders, "o_orderstatus", "o_orderkey"))
    ready = classify.with_features(relational.label_index(orders, dictionary, "o_orderstatus"), ["month"], "label_index")
    names = [r["o_orderstatus"] for r in dictionary.orderBy("label_index").collect()]
    nodes = classify.tree_nodes(classify.fit_tree(ready, 1), spark, ["month"], names)
    return nodes.select("node", "feature", "threshold", F.round("gini", 9).alias("gini"), "samples")


@query()
def tree_nodes(spark, d):
    """Every node of the limited tree as a row."""
    rows, dictionary = _orders_by_status(spark, d)
    model, _ = species.fit_and_score(rows, _STATUS_COLUMNS, lambda t: classify.fit_tree(t, 7, 6))
    names = [r["o_orderstatus"] for r in dictionary.orderBy("label_index").collect()]
    return classify.tree_nodes(model, spark, _STATUS_COLUMNS, names)


_LEAF = 25
_STATES = "FOP"


def _tree_cut(name: str, rows: str) -> str:
    """SQL of the best cut of every node of ``rows`` (``node``, ``s`` and the three features)."""
    tall = " UNION ALL ".join(f"SELECT node, {f} AS f, {c} AS v, s FROM {rows}" for f, c in enumerate(("m", "dd", "c5")))
    running = ", ".join(f"sum(count(*) FILTER (s = '{k}')) OVER (PARTITION BY node, f ORDER BY v) AS l{k}, sum(count(*) FILTER (s = '{k}')) OVER (PARTITION BY node, f) AS all_{k}" for k in _STATES)
    left, right = "(" + " + ".join(f"l{k}" for k in _STATES) + ")", "(" + " + ".join(f"all_{k} - l{k}" for k in _STATES) + ")"
    squares = [" + ".join(f"CAST({x} AS DOUBLE) * ({x})" for x in xs) for xs in ([f"l{k}" for k in _STATES], [f"all_{k} - l{k}" for k in _STATES])]
    cost = f"round((({squares[0]}) / {left} + ({squares[1]}) / {right}) / ({left} + {right}), 12)"
    return f"""{name} AS (SELECT node, f, (v + nx) / 2e0 AS cut FROM (
      SELECT *, row_number() OVER (PARTITION BY node ORDER BY {cost} DESC, f, v) AS nth
      FROM (SELECT node, f, v, lead(v) OVER (PARTITION BY node, f ORDER BY v) AS nx, {running} FROM ({tall}) GROUP BY node, f, v)
      WHERE nx IS NOT NULL AND {left} >= {_LEAF} AND {right} >= {_LEAF}) WHERE nth = 1)"""


_TREE_VALUE = "CASE f WHEN 0 THEN m WHEN 1 THEN dd ELSE c5 END"
_TREE_ROWS = f"""SELECT node AS path, min(f) AS f, min(cut) AS cut, count(*) AS samples,
  round(1 - ({" + ".join(f"(count(*) FILTER (s = '{k}') / count(*)) ** 2" for k in _STATES)}), 9) AS gini"""


@query(
    f"""WITH a AS (SELECT '' AS node, o_orderstatus AS s, month(o_orderdate) AS m, day(o_orderdate) AS dd, o_custkey % 5 AS c5 FROM orders),
    {_tree_cut("ca", "a")},
    b AS (SELECT node || CASE WHEN {_TREE_VALUE} <= cut THEN 'l' ELSE 'r' END AS node, s, m, dd, c5 FROM a JOIN ca USING (node)),
    {_tree_cut("cb", "b")},
    c AS (SELECT node || CASE WHEN {_TREE_VALUE} <= cut THEN 'l' ELSE 'r' END AS node, s, m, dd, c5 FROM b JOIN cb USING (node)),
    nodes AS ({_TREE_ROWS} FROM a LEFT JOIN ca USING (node) GROUP BY node UNION ALL {_TREE_ROWS} FROM b LEFT JOIN cb USING (node) GROUP BY node
      UNION ALL {_TREE_ROWS} FROM (SELECT *, CAST(NULL AS INTEGER) AS f, CAST(NULL AS DOUBLE) AS cut FROM c) GROUP BY node)
    SELECT path, CASE f WHEN 0 THEN 'month' WHEN 1 THEN 'day' WHEN 2 THEN 'fifth' END AS feature, cut AS threshold, gini, CAST(samples AS BIGINT) AS samples FROM nodes"""
)
def tree_of_depth_two(spark, d):
    """Gini tree of depth two with a leaf limit, every value of three features tried as a cut, as node rows."""
    order = F.col("o_orderdate")
    label = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    rows = read_table(spark, d, "orders").select(
        F.month(order).alias("month"), F.dayofmonth(order).alias("day"), (F.col("o_custkey") % 5).alias("fifth"), label.alias("label")
    )
    names = ["month", "day", "fifth"]
    nodes = exact_tree.exact_tree_nodes(exact_tree.fit_exact_tree(rows, names, max_depth=2, min_leaf=_LEAF), spark, names, list(_STATES))
    return nodes.select("path", "feature", "threshold", F.round("gini", 9).alias("gini"), "samples")


@query()
def exact_tree_accuracy(spark, d):
    """Accuracy per part of the tree of depth seven with leaves of six rows, all values tried as cuts."""
    rows, _ = _orders_by_status(spark, d)
    rows = materialise(rows)
    tree = exact_tree.fit_exact_tree(rows.where("split = 'train'"), _STATUS_COLUMNS, max_depth=7, min_leaf=6)
    return _accuracy_rows(evaluate.accuracy_scores(exact_tree.predict_tree(rows, tree, _STATUS_COLUMNS)))

@query()
def softmax(spark, d):
    """Multinomial logistic regression over ten classes."""
    rows = read_table(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("class"), *_dims(64))
    parts, _ = species.multi_rows(rows, "class", [f"x{i}" for i in range(64)], "vec_id", SEED)
    _, scores = species.fit_and_score(parts, [f"x{i}" for i in range(64)], classify.fit_softmax)
    return _accuracy_rows(scores)


@query()
def softmax_history(spark, d):
    """Training loss per iteration of the softmax fit."""
    rows, _ = _orders_by_status(spark, d)
    model, _ = species.fit_and_score(rows, _STATUS_COLUMNS, classify.fit_softmax, scaled=True)
    return classify.objective_history(model, spark)


def _dense_runs(spark, d):
    """Scores and histories of the five layouts; trained once per session and folder, then read."""
    base = f"{shared_dir(spark)}/dense-runs-{spark.sparkContext.applicationId}-{zlib.crc32(d.encode()):08x}"

    def build():
        scores, history = species.dense_fits(_orders_by_status(spark, d, valid=True)[0], _STATUS_COLUMNS)
        write_table(history, f"{base}-history")
        return scores

    return read_or_build(spark, f"{base}-scores", build), spark.read.parquet(f"{base}-history")


@query()
def dense_network(spark, d):
    """Five dense layouts on all orders, each stopped on the validation part: accuracy of the three parts."""
    return _dense_runs(spark, d)[0].select("layout", "split", "n", F.round("accuracy", 4).alias("accuracy"))


@query()
def dense_history(spark, d):
    """Training and validation loss of the five dense layouts per round."""
    return _dense_runs(spark, d)[1]


# One input that is 0 or 1 and no hidden layer: the least absolute error is that of the groups' medians.
@query(
    """WITH given AS (SELECT CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS urgent, o_totalprice / 1e5 AS price FROM orders),
    middle AS (SELECT urgent, count(*) AS n, median(price) AS m FROM given GROUP BY urgent)
    SELECT urgent, CAST(n AS BIGINT) AS n, round(m, 4) AS median, TRUE AS reached FROM middle"""
)
def dense_medians(spark, d):
    """Network without hidden layer on the absolute loss: its error is within half a percent of the medians' error."""
    rows = read_table(spark, d, "orders").select(
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"), (F.col("o_totalprice") / 1e5).alias("label"), F.lit("train").alias("split")
    )
    rows = materialise(rows)
    nets = [dense.new_net([1, 1], "relu", "absolute", SEED)]
    (net,), _ = dense.fit_dense_nets(rows, ["urgent"], nets, rounds=60, patience=60, batches=1, rate=0.5, decay=0.1)
    middle = materialise(rows.groupBy("urgent").agg(F.count("*").alias("n"), F.percentile("label", F.lit(0.5)).alias("median")))
    held = dense.predict_dense(rows, net, ["urgent"]).join(F.broadcast(middle), "urgent")
    errors = held.groupBy("urgent").agg(F.sum(F.abs(F.col("label") - F.col("prediction"))).alias("own"), F.sum(F.abs(F.col("label") - F.col("median"))).alias("least"))
    return middle.join(errors, "urgent").select("urgent", "n", F.round("median", 4).alias("median"), (F.col("own") <= F.col("least") * 1.005).alias("reached"))


# With one indicator per category and no penalty, the fitted probabilities are the class shares.
_SHARES = """SELECT o_orderpriority, o_orderstatus, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 6) AS share, TRUE AS fitted
    FROM orders GROUP BY 1, 2"""


def _status_by_priority(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    status = materialise(prepare.label_dictionary(orders, "o_orderstatus", "o_orderkey"))
    priority = prepare.label_dictionary(orders, "o_orderpriority", "o_orderkey", "category")
    rows = relational.label_index(orders, priority, "o_orderpriority", "category")
    rows = relational.label_index(rows, status, "o_orderstatus").withColumn("label", F.col("label_index").cast("double"))
    return materialise(prepare.one_hot(rows, "category", "features")), status


def _shares(predicted, status):
    chances = predicted.groupBy("o_orderpriority").agg(F.first(vector_to_array("probability")).alias("p"))
    listed = chances.select("o_orderpriority", F.posexplode("p").alias("label_index", "share"))
    listed = listed.join(status, "label_index").select("o_orderpriority", "o_orderstatus", F.col("share").alias("fit"))
    counts = predicted.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    totals = counts.groupBy("o_orderpriority").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "o_orderpriority").join(listed, ["o_orderpriority", "o_orderstatus"]).withColumn("share", F.col("n") / F.col("total"))
    return shares.select("o_orderpriority", "o_orderstatus", F.round("share", 6).alias("share"), (F.abs(F.col("fit") - F.col("share")) < 0.01).alias("fitted"))


@query(_SHARES)
def softmax_shares(spark, d):
    """Multinomial regression on one indicator per category."""
    rows, status = _status_by_priority(spark, d)
    return _shares(classify.fit_softmax(rows, c=1e9).transform(rows), status)


@query(_SHARES)
def dense_shares(spark, d):
    """A network without hidden layers on one indicator per category."""
    rows, status = _status_by_priority(spark, d)
    return _shares(classify.fit_dense(rows, 5, status.count(), [], max_iter=400).transform(rows), status)


@query("SELECT round(0e0 - sum(p * ln(p)), 6) AS loss FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM orders GROUP BY o_orderstatus)")
def softmax_first_loss(spark, d):
    """Loss before the first step: the entropy of the classes."""
    rows, _ = _status_by_priority(spark, d)
    history = classify.objective_history(classify.fit_softmax(rows, c=1e9), spark)
    return history.where("round = 0").select(F.round("train_loss", 6).alias("loss"))


# Mirrored points inside the margin: the weights are the penalty times the sum of label times point.
_MIRRORED = "x AS (SELECT abs(CAST(embedding[1] AS DOUBLE)) AS x FROM embeddings), s AS (SELECT sum(x) AS s, max(x) AS m FROM x)"


def _mirrored(spark, d):
    x = F.abs(F.col("embedding")[0].cast("double"))
    return materialise(read_table(spark, d, "embeddings").select(x.alias("x")))


@query(f"WITH {_MIRRORED} SELECT round(0.5e0 / m, 3) AS weight, 0e0 AS intercept FROM s")
def svc_on_mirrored_points(spark, d):
    """Linear classifier of one feature whose points all lie inside the margin."""
    half = _mirrored(spark, d)
    total, top = half.agg(F.sum("x"), F.max("x")).first()
    both = half.select("x", F.lit(1.0).alias("label")).union(half.select(-F.col("x"), F.lit(0.0)))
    model = classify.fit_linear_svc(materialise(prepare.assemble(both, ["x"])), 0.25 / (total * top))
    return spark.createDataFrame([(round(float(model.coefficients[0]), 3), round(float(model.intercept), 3) + 0.0)], "weight double, intercept double")


_CORNERS = {0: (-1, -1, 0), 1: (1, 0, -1), 2: (0, 1, 1)}
_CORNER_ROWS = " UNION ALL ".join(
    f"SELECT {low} AS low, {high} AS high, " + ", ".join(f"round(0.05e0 / m * {h - g}, 3) + 0e0 AS w{k}" for k, (g, h) in enumerate(zip(_CORNERS[low], _CORNERS[high]))) + " FROM s"
    for low, high in _PAIRS
)


@query(f"WITH {_MIRRORED} SELECT CAST(low AS INTEGER) AS low, CAST(high AS INTEGER) AS high, w0, w1, w2 FROM ({_CORNER_ROWS})")
def one_vs_one_on_mirrored_points(spark, d):
    """Pairwise classifiers of three classes whose points all lie inside every margin."""
    half = _mirrored(spark, d)
    total, top = half.agg(F.sum("x"), F.max("x")).first()
    axes = [F.array(*[F.lit(float(v)) for v in corner]) for corner in _CORNERS.values()]
    rows = half.select("x", F.posexplode(F.array(*axes)).alias("class", "corner"))
    rows = rows.select(F.col("class").cast("double").alias("label"), *[(F.col("corner")[k] * F.col("x")).alias(f"x{k}") for k in range(3)])
    models = pairwise.fit_all_pairs(materialise(prepare.assemble(rows, ["x0", "x1", "x2"])), c=0.05 / (total * top))
    table = [(low, high, *(round(float(w), 3) + 0.0 for w in m.coefficients)) for (low, high), m in models.items()]
    return spark.createDataFrame(table, "low int, high int, w0 double, w1 double, w2 double")


@query("SELECT CAST(l_returnflag = 'R' AS INTEGER) AS returned, round(avg(l_quantity), 6) AS prediction FROM lineitem GROUP BY 1")
def boosted_stump(spark, d):
    """One boosting round of depth one on a binary feature: the means of the two groups."""
    rows = read_table(spark, d, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("returned"), F.col("l_quantity").alias("label"))
    ready = materialise(prepare.assemble(rows, ["returned"]))
    model, _ = regress.fit_boosted_mae(ready, ready, max_iter=1, depth=1)
    return model.transform(ready).groupBy("returned").agg(F.round(F.first("prediction"), 6).alias("prediction"))


_THIRDS = "SELECT CAST(label % 3 AS INTEGER) AS part, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) + 100 * (label % 3 = {i % 3})::INTEGER AS x{i}" for i in range(64)) + " FROM embeddings"


@query("SELECT part, CAST(count(*) AS BIGINT) AS n, " + ", ".join(f"round(avg(x{i}), 6) AS x{i}" for i in range(64)) + f" FROM ({_THIRDS}) GROUP BY part")
def kmeans_far_groups(spark, d):
    """Three groups far apart: k-means finds their means."""
    part = F.pmod(F.col("label"), F.lit(3)).cast("int")
    shifted = [(x + 100.0 * (part == i % 3).cast("int")).alias(f"x{i}") for i, x in enumerate(F.col("embedding")[i].cast("double") for i in range(64))]
    names = [f"x{i}" for i in range(64)]
    ready = materialise(prepare.assemble(read_table(spark, d, "embeddings").select(part.alias("part"), *shifted), names))
    model = cluster.fit_kmeans(ready, 3, seed=SEED)
    centres = spark.createDataFrame([(i, list(map(float, c))) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    found = model.transform(ready).groupBy("part", "cluster").agg(F.count("*").alias("n")).join(F.broadcast(centres), "cluster")
    return found.select("part", "n", *[F.round(F.col("centre")[i], 6).alias(f"x{i}") for i in range(64)])


@query("SELECT vec_id, round(0.25e0 + 1.5e0 * CAST(embedding[1] AS DOUBLE) - 2e0 * CAST(embedding[2] AS DOUBLE), 6) AS margin FROM embeddings")
def decision_margin(spark, d):
    """Signed margin of every row under given weights."""
    rows = read_table(spark, d, "embeddings").select("vec_id", *_dims(2))
    scored = classify.margins(rows, ["x0", "x1"], classify.LinearWeights([1.5, -2.0], 0.25))
    return scored.select("vec_id", F.round("margin", 6).alias("margin"))


@query()
def margin_grid(spark, d):
    """Signed margin of the fitted two-class model on a 100 x 100 grid over the data's range."""
    rows = _binary(spark, d)
    model, _ = species.fit_and_score(rows, ["x0", "x1"], classify.fit_linear_svc)
    r = rows.agg(*[f(c).alias(f"{n}_{c}") for c in ("x0", "x1") for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return classify.margin_grid(spark, ((r["lo_x0"], r["hi_x0"]), (r["lo_x1"], r["hi_x1"])), model, ["x0", "x1"])


# ---- clusters


_CENTRES = [(0.1, 0.0, 0.0), (0.0, 0.1, 0.0), (0.0, 0.0, 0.1)]
_CENTRE_ROWS = ", ".join(f"({i}, {a!r}e0, {b!r}e0, {c!r}e0)" for i, (a, b, c) in enumerate(_CENTRES))


@query(
    f"""WITH {_SIMILAR}, k AS (SELECT * FROM (VALUES {_CENTRE_ROWS}) v(i, a, b, c)),
    n AS (SELECT vec_id, up, flat, down, arg_min(i, {{'d': (up - a) * (up - a) + (flat - b) * (flat - b) + (down - c) * (down - c), 'i': i}}) AS cluster FROM sims, k GROUP BY ALL)
    SELECT CAST(cluster AS INTEGER) AS cluster, CAST(count(*) AS BIGINT) AS n, round(avg(up), 6) AS centre_up, round(avg(flat), 6) AS centre_flat, round(avg(down), 6) AS centre_down
    FROM n GROUP BY cluster"""
)
def kmeans_step(spark, d):
    """One refinement of the three similarities from three given centres."""
    columns = list(_ANCHOR_NAMES.values())
    step = cluster.lloyd_step(_similar(spark, d), columns, _CENTRES)
    return step.select("cluster", "n", *[F.round(f"centre_{c}", 6).alias(f"centre_{c}") for c in columns])


@query()
def kmeans_score(spark, d):
    """Rows per ordered cluster number of the scaled anchor similarities."""
    columns = list(_ANCHOR_NAMES.values())
    similar = _similar(spark, d)
    ready = materialise(prepare.assemble(prepare.fit_zscore(similar, columns).transform(similar), columns))
    model = cluster.fit_kmeans(ready, 3, seed=SEED)
    return cluster.cluster_scores(ready, model, 0, 2).groupBy("score").agg(F.count("*").alias("n"))


# ---- sweeps


def _forecast_frame(spark, d, degree, scaling):
    rows = materialise(next_day.labelled_split(panel(spark, d), "series", "date", "cap", SEED))
    apply = next_day.feature_steps(rows.where("split = 'train'"), [*_FEATURES, "date_int"], degree, scaling)
    return materialise(apply(rows).select("features", "label", "split"))


@query()
def degree_sweep(spark, d):
    """Forecast scores for degrees one to three."""
    return paths.degree_path(_forecast_frame(spark, d, 1, "zscore"))


@query()
def alpha_sweep(spark, d):
    """Forecast scores for six absolute penalties on scaled degree-three terms."""
    return paths.alpha_path(_forecast_frame(spark, d, 3, "minmax"))


@query()
def alpha_sweep_ridge(spark, d):
    """The same for squared penalties."""
    return paths.alpha_path(_forecast_frame(spark, d, 3, "minmax"), penalty="squared")


@query(
    f"""WITH {_MARKED}, t AS (SELECT *, o_custkey % 3 AS x FROM m),
    f AS (SELECT regr_slope(o_totalprice, x) AS b, regr_intercept(o_totalprice, x) AS a FROM t WHERE split = 'train'),
    g AS (SELECT x, avg(o_totalprice) AS mean FROM t WHERE split = 'train' GROUP BY x),
    s AS (SELECT split, 1 - sum((o_totalprice - a - b * x) ** 2) / (var_pop(o_totalprice) * count(*)) AS one,
      1 - sum((o_totalprice - mean) ** 2) / (var_pop(o_totalprice) * count(*)) AS two FROM t JOIN g USING (x), f GROUP BY split)
    SELECT CAST(1 AS INTEGER) AS degree, round(max(one) FILTER (split = 'train'), 6) + 0e0 AS train_score, round(max(one) FILTER (split = 'test'), 6) + 0e0 AS test_score FROM s
    UNION ALL SELECT CAST(2 AS INTEGER), round(max(two) FILTER (split = 'train'), 6) + 0e0, round(max(two) FILTER (split = 'test'), 6) + 0e0 FROM s"""
)
def degree_sweep_of_three_values(spark, d):
    """A feature of three values: a line, and at degree two the mean of each value."""
    rows = _split_orders(spark, d).select((F.col("o_custkey") % 3).cast("double").alias("x"), F.col("o_totalprice").alias("label"), "split")
    table = paths.degree_path(materialise(prepare.assemble(rows, ["x"])), (1, 2))
    return table.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("train_score", "test_score")})


@query(
    f"""WITH {_MARKED}, t AS (SELECT *, o_custkey % 2 AS x, CAST(o_totalprice > 150000 + 40000 * (o_custkey % 2) AS INTEGER) AS y FROM m),
    g AS (SELECT x, CAST(avg(y) > 0.5e0 AS INTEGER) AS p FROM t WHERE split = 'train' GROUP BY x),
    s AS (SELECT split, avg(CAST(y = p AS INTEGER)) AS a FROM t JOIN g USING (x) GROUP BY split)
    SELECT CAST(1 AS INTEGER) AS max_depth, CAST(1 AS INTEGER) AS min_leaf, round(max(a) FILTER (split = 'train'), 6) AS train_score, round(max(a) FILTER (split = 'test'), 6) AS test_score FROM s"""
)
def tree_sweep_of_two_values(spark, d):
    """A tree of depth one on a binary feature: the majority of each value."""
    odd = F.col("o_custkey") % 2
    rows = _split_orders(spark, d).select(odd.cast("double").alias("x"), (F.col("o_totalprice") > 150000 + 40000 * odd).cast("double").alias("label"), "split")
    table = sweeps.sweep_tree(materialise(prepare.assemble(rows, ["x"])), (1,), (1,))
    return table.withColumns({c: F.round(c, 6) for c in ("train_score", "test_score")})


@query(
    f"""WITH {_MARKED}, p AS (SELECT split, avg(o_custkey) AS mx, avg(o_totalprice) AS my, covar_pop(o_custkey, o_totalprice) AS c, var_pop(o_custkey) AS v FROM m GROUP BY split),
    f AS (SELECT alpha, sign(c) * greatest(abs(c) - alpha, 0) / v AS w, my - mx * sign(c) * greatest(abs(c) - alpha, 0) / v AS a
      FROM p, (SELECT unnest([0.001e0, 1e0, 100e0, 1e4, 1e9]) AS alpha) WHERE split = 'train'),
    s AS (SELECT alpha, split, 1 - sum((o_totalprice - a - w * o_custkey) ** 2) / (var_pop(o_totalprice) * count(*)) AS r2 FROM m, f GROUP BY alpha, split)
    SELECT alpha, round(log10(alpha), 6) AS log_alpha, round(max(r2) FILTER (split = 'train'), 6) + 0e0 AS train_score, round(max(r2) FILTER (split = 'test'), 6) + 0e0 AS test_score FROM s GROUP BY alpha"""
)
def alpha_sweep_line(spark, d):
    """Scores of a one-feature line for five absolute penalties."""
    rows = prepare.assemble(_split_orders(spark, d), ["o_custkey"]).withColumnRenamed("o_totalprice", "label")
    table = paths.alpha_path(rows.select("features", "label", "split"), (0.001, 1.0, 100.0, 1e4, 1e9))
    rounded = {c: F.round(c, 6) + F.lit(0.0) for c in ("log_alpha", "train_score", "test_score")}
    return table.withColumns(rounded)


@query()
def tree_sweep(spark, d):
    """Tree accuracy over depth and leaf size."""
    rows, _ = _orders_by_status(spark, d)
    ready = prepare.assemble(rows, _STATUS_COLUMNS).withColumn("label", F.col("label").cast("double"))
    return sweeps.sweep_tree(ready.select("features", "label", "split"))


# ---- news scores


@query(
    f"""WITH {PANEL}, {DATED}, {SCORED}, known AS (SELECT series, date, {_DATE_INT} AS x, score FROM panel JOIN scored USING (date)),
    cut AS (SELECT *, row_number() OVER (ORDER BY md5(series || '|' || date || '|{SEED}')) > ceil(count(*) OVER () * 0.25e0) AS train FROM known),
    fit AS (SELECT regr_slope(score, x) AS b, regr_intercept(score, x) AS a FROM cut WHERE train)
    SELECT series, panel.date AS date, cap, round(coalesce(score, a + b * (year(panel.date) * 10000 + month(panel.date) * 100 + day(panel.date))), 4) AS score
    FROM panel CROSS JOIN fit LEFT JOIN scored USING (date)"""
)
def scores_filled_by_trend(spark, d):
    """Daily score on every day of the panel, missing ones predicted from the date."""
    table, scores = materialise(panel(spark, d).select("series", "date", "cap")), materialise(daily_score(spark, d))
    filled = news_score.impute_scores(table, scores, ["series", "date"], "date", [], ["score"], SEED)
    return filled.withColumn("score", F.round("score", 4))


@query()
def imputed_scores(spark, d):
    """Daily score on every day of the panel, predicted where no document was published."""
    table, scores = materialise(panel(spark, d)), materialise(daily_score(spark, d))
    return news_score.impute_scores(table, scores, ["series", "date"], "date", ["cap", *_FEATURES], ["score"], SEED)


_THREE = f"""three AS (SELECT date, avg(n_chars) AS up, CASE WHEN day(date) % 4 <> 0 THEN avg(doc_id) END AS flat, avg(length(source)) AS down FROM dated GROUP BY date),
  known AS (SELECT series, panel.date AS date, {_DATE_INT.replace("date", "panel.date")} AS x, up, flat, down FROM panel LEFT JOIN three ON three.date = panel.date)"""


def _target_fit(target):
    ranked = f"row_number() OVER (ORDER BY md5(series || '|' || date || '|{SEED}')) > ceil(count(*) OVER () * 0.25e0)"
    return f"fit_{target} AS (SELECT regr_slope({target}, x) AS b, regr_intercept({target}, x) AS a FROM (SELECT *, {ranked} AS train FROM known WHERE {target} IS NOT NULL) WHERE train)"


@query(
    f"WITH {PANEL}, {DATED}, {_THREE}, {', '.join(map(_target_fit, ['up', 'flat', 'down']))} SELECT series, date, "
    + ", ".join(f"round(coalesce({t}, fit_{t}.a + fit_{t}.b * x), 3) AS {t}" for t in ("up", "flat", "down"))
    + " FROM known, fit_up, fit_flat, fit_down"
)
def three_scores_filled_by_trend(spark, d):
    """Three daily scores, one with gaps of its own, each filled from the date where it is missing."""
    docs = dated_documents(spark, d)
    scores = docs.groupBy("date").agg(F.avg("n_chars").alias("up"), F.avg("doc_id").alias("flat"), F.avg(F.length("source")).alias("down"))
    scores = scores.withColumn("flat", F.when(F.dayofmonth("date") % 4 != 0, F.col("flat")))
    table = materialise(panel(spark, d).select("series", "date"))
    filled = news_score.impute_scores(table, materialise(scores), ["series", "date"], "date", [], ["up", "flat", "down"], SEED)
    return filled.select("series", "date", *[F.round(c, 3).alias(c) for c in ("up", "flat", "down")])


def _document_scores(spark, d):
    docs = spread(dated_documents(spark, d).select("doc_id", "date", "text"))
    folder = scratch_path(spark, "news")
    similar = news_score.corpus_stages(spark, folder, docs, "doc_id", "text", _right_parts(spark), anchors=None)
    return similar.join(docs.select("doc_id", "date"), "doc_id")


@query()
def score_by_cluster(spark, d):
    """Documents to one daily score: tokens, vocabulary, vectors, clusters, daily mean."""
    return news_score.score_v1(materialise(_document_scores(spark, d)), "date", ["up", "flat", "down"], seed=SEED)


@query()
def score_by_similarity(spark, d):
    """Documents to three daily scores, filled on days without documents."""
    scores = materialise(news_score.score_v2(_document_scores(spark, d), "date", ["up", "flat", "down"]))
    return news_score.impute_scores(materialise(panel(spark, d)), scores, ["series", "date"], "date", ["cap", *_FEATURES], ["up", "flat", "down"], SEED)


def _forecast_with(spark, d, table, scores):
    table = materialise(table.withColumn("cap", F.col("cap") / 1e6))
    return _score_rows(next_day.run_boosted(table, "series", "date", "cap", [*_FEATURES, *scores], SEED)[0])


@query()
def forecast_with_scores(spark, d):
    """Next-day forecast on the panel and the three filled scores."""
    return _forecast_with(spark, d, score_by_similarity(spark, d), ["up", "flat", "down"])


@query()
def forecast_with_cluster_score(spark, d):
    """Next-day forecast on the panel and the filled score of the clusters, on every day of the panel."""
    table, scores = materialise(panel(spark, d)), materialise(score_by_cluster(spark, d))
    filled = news_score.impute_scores(table, scores, ["series", "date"], "date", ["cap", *_FEATURES], ["score"], SEED)
    return _forecast_with(spark, d, filled, ["score"])
