"""Queries of the tabular core: sources, slices, joins, aggregates, windows, sets, scalar functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seriesloom.functions import dates, hangul, numeric, text
from seriesloom.operators import prepare, profile, relational, series, vectors
from seriesloom.registry.base import DATED, PANEL, SCORED, SPACES, daily_score, dated_documents, panel, query
from seriesloom.session import scratch_path
from seriesloom.sources import readers, schemas, store
from seriesloom.sources.readers import read_table
from seriesloom.streaming import ingest

# ---- sources and sinks


@query("SELECT * FROM part")
def csv_scan(spark, d):
    """A table written as text and scanned back with its declared types."""
    path = scratch_path(spark, "csv")
    read_table(spark, d, "part").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, schemas.TABLES["part"])


@query("SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def table_scan(spark, d):
    """Columnar scan: the filter and three columns reach the file reader."""
    return read_table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_nationkey", "c_acctbal")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice FROM orders")
def table_sink(spark, d):
    """Orders written by year, read back."""
    path = scratch_path(spark, "sink")
    rows = read_table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice")
    store.write_table(rows, path, ["year"])
    return spark.read.parquet(path)


@query("SELECT p_brand, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1")
def stored_once(spark, d):
    """Built on the first call, loaded on the second."""
    path = scratch_path(spark, "once")

    def build():
        return read_table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))

    store.read_or_build(spark, path, build)
    return store.read_or_build(spark, path, build)


@query("SELECT doc_id, source, n_chars FROM documents")
def append_new_rows(spark, d):
    """Two overlapping batches of documents appended to one table: each document once."""
    path = scratch_path(spark, "append")
    docs = read_table(spark, d, "documents").select("doc_id", "source", "n_chars")
    store.append_new(spark, docs.where("n_chars > 1000"), path, "doc_id")
    store.append_new(spark, docs, path, "doc_id")
    return spark.read.parquet(path)


@query("SELECT doc_id, source, n_chars FROM documents")
def stream_ingest(spark, d):
    """Documents arriving as a file stream, stored once although two streams run twice each."""
    path = scratch_path(spark, "store")
    # The braces match the table's own name, be it one file or a folder of them.
    for checkpoint in [scratch_path(spark, "offsets") for _ in range(2)] * 2:
        run = ingest.ingest_articles(
            spark, f"{d}/{{documents.parquet}}", path, checkpoint, schemas.TABLES["documents"], key="doc_id",
            prepare=lambda rows: rows.select("doc_id", "source", "n_chars"),
        )
        run.awaitTermination()
    return ingest.read_store(spark, path)


# ---- slices and positions


@query("SELECT p_partkey, p_retailprice FROM part WHERE p_brand = 'Brand#4'")
def class_slice(spark, d):
    """Rows and columns of one class."""
    return relational.class_slice(read_table(spark, d, "part"), "p_brand", "Brand#4", ["p_partkey", "p_retailprice"])


@query("SELECT p_partkey, p_name, p_type, p_size FROM part")
def drop_columns(spark, d):
    """A table without two of its columns."""
    return relational.drop_columns(read_table(spark, d, "part"), "p_brand", "p_retailprice")


def _scored_panel(spark, d):
    return relational.with_daily_score(panel(spark, d), daily_score(spark, d))


@query(f"WITH {PANEL}, {DATED}, {SCORED} SELECT panel.*, score FROM panel JOIN scored USING (date)")
def complete_rows(spark, d):
    """Days with a score."""
    return relational.complete_rows(_scored_panel(spark, d))


@query(
    f"WITH {PANEL}, {DATED}, {SCORED} SELECT series, panel.date AS date, cap FROM panel LEFT JOIN scored USING (date) WHERE score IS NULL"
)
def missing_rows(spark, d):
    """Days whose score has to be filled."""
    return relational.missing_rows(_scored_panel(spark, d), "score").select("series", "date", "cap")


@query(
    f"""WITH {PANEL} SELECT series, date, cap, n_orders FROM panel
    WHERE date < (SELECT max(p.date) FROM panel p WHERE p.series = panel.series)"""
)
def without_newest(spark, d):
    """Rows that have a next day."""
    rows = series.labelled_rows(panel(spark, d), "series", "date", "cap")
    return rows.select("series", "date", "cap", "n_orders")


@query(
    f"""WITH {PANEL} SELECT series, max(date) + 1 AS date, arg_max(cap, date) AS cap, arg_max(n_orders, date) AS n_orders
    FROM panel GROUP BY series"""
)
def latest_row(spark, d):
    """Newest row of each nation under the next day's date."""
    return relational.latest_row(panel(spark, d).select("series", "date", "cap", "n_orders"), "series", "date")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_rows(spark, d):
    """The 100 largest orders."""
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return relational.first_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 100)


@query(f"WITH {PANEL} SELECT series, date, cap / 1000000000000e0 AS cap FROM panel")
def rescaled_value(spark, d):
    """The value in modelling units."""
    return panel(spark, d).select("series", "date", numeric.rescale(F.col("cap")).alias("cap"))


@query(f"WITH {PANEL} SELECT series, date, n_orders * 1e0 AS f0, avg_price AS f1, max_price AS f2 FROM panel")
def feature_matrix(spark, d):
    """Numeric columns packed to one vector per row, listed by position."""
    packed = prepare.assemble(panel(spark, d), ["n_orders", "avg_price", "max_price"])
    x = vector_to_array("features")
    return packed.select("series", "date", *[x[i].alias(f"f{i}") for i in range(3)])


# ---- joins


@query(f"WITH {PANEL}, {DATED}, {SCORED} SELECT panel.*, score FROM panel LEFT JOIN scored USING (date)")
def score_join(spark, d):
    """Panel with the score of its day."""
    return _scored_panel(spark, d)


@query(
    f"""WITH {PANEL}, {DATED}, {SCORED}
    SELECT series, panel.date AS date, coalesce(score, n_orders * 100e0) AS score FROM panel LEFT JOIN scored USING (date)"""
)
def score_fill(spark, d):
    """Missing scores filled by row key from a predictor."""
    rows = _scored_panel(spark, d).select("series", "date", "score", "n_orders")
    filled = relational.missing_rows(rows, "score").select("series", "date", (F.col("n_orders") * 100.0).alias("score"))
    return relational.fill_from(rows, filled, ["series", "date"], ["score"]).drop("n_orders")


@query(
    """WITH n AS (SELECT word AS token, count(*) / 100e0 AS score FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1),
    c AS (SELECT word AS token, count(*) / 1000e0 AS score FROM (SELECT unnest(string_split(p_type || ' ' || split_part(p_name, ' ', 1), ' ')) AS word FROM part) GROUP BY 1)
    SELECT token, CASE WHEN n.score IS NOT NULL THEN n.score + coalesce(c.score, 0) ELSE c.score END AS score FROM n FULL JOIN c USING (token)"""
)
def score_table_merge(spark, d):
    """Two token score tables in one."""
    part = read_table(spark, d, "part")
    first = F.substring_index("p_name", " ", 1)

    def table(words, unit):
        return part.select(F.explode(words).alias("token")).groupBy("token").agg((F.count("*") / unit).alias("score"))

    names = table(text.split_words(F.col("p_name")), 100.0)
    types = table(text.split_words(F.concat_ws(" ", "p_type", first)), 1000.0)
    return relational.merge_score_tables(names, types)


_DICTIONARY = """dict AS (SELECT p_brand, min(p_partkey) AS first_key,
    CAST(row_number() OVER (ORDER BY min(p_partkey), p_brand) - 1 AS INTEGER) AS label_index FROM part GROUP BY p_brand)"""


@query(f"WITH {_DICTIONARY} SELECT p_partkey, p_brand, label_index FROM part JOIN dict USING (p_brand)")
def label_index(spark, d):
    """Class text to its index."""
    part = read_table(spark, d, "part").select("p_partkey", "p_brand")
    return relational.label_index(part, prepare.label_dictionary(part, "p_brand", "p_partkey"), "p_brand")


_BATCHES = """days AS (SELECT DISTINCT c_nationkey AS series, CAST(o_orderdate AS DATE) AS date FROM orders JOIN customer ON o_custkey = c_custkey),
  runs AS (SELECT *, date + CAST(row_number() OVER (PARTITION BY series ORDER BY date DESC) AS INTEGER) AS run FROM days),
  cut AS (SELECT *, (row_number() OVER (PARTITION BY series, run ORDER BY date DESC) - 1) // 5 AS chunk FROM runs),
  batches AS (SELECT series, min(date) AS start_date, max(date) AS end_date, CAST(count(*) AS BIGINT) AS n_days FROM cut GROUP BY series, run, chunk)"""


@query(f"WITH {_BATCHES} SELECT series, start_date, end_date, r_name AS press FROM batches, region")
def fetch_plan(spark, d):
    """Each date batch once per region name."""
    batches = series.consecutive_batches(panel(spark, d), "series", "date").drop("n_days")
    return relational.every_pairing(batches, read_table(spark, d, "region").select("r_name"), "press")


@query("SELECT doc_id, source, CASE WHEN CAST(substr(source, 4) AS INTEGER) < 12 THEN CAST(substr(source, 4) AS INTEGER) END AS press_index FROM documents")
def press_index(spark, d):
    """Source name to its position in a fixed list, null when not listed."""
    docs = read_table(spark, d, "documents").select("doc_id", "source")
    return relational.fixed_index(docs, [f"src{i}" for i in range(12)], "source", "press_index")


# ---- aggregates


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem")
def row_count(spark, d):
    """Rows of a table."""
    return profile.row_count(read_table(spark, d, "lineitem"))


@query("SELECT DISTINCT p_brand FROM part")
def distinct_classes(spark, d):
    """Classes of a table."""
    return profile.distinct_values(read_table(spark, d, "part"), "p_brand")


@query(
    """SELECT p_brand, CAST(count(*) AS BIGINT) AS n,
    (count(*) * 2000 + (SELECT count(*) FROM part)) // (2 * (SELECT count(*) FROM part)) / 10e0 AS share_pct FROM part GROUP BY 1"""
)
def class_share(spark, d):
    """Rows and percentage per class."""
    return profile.class_share(read_table(spark, d, "part"), "p_brand")


@query("SELECT p_brand, round(avg(p_retailprice), 6) AS mean_p_retailprice, round(avg(p_size), 6) AS mean_p_size FROM part GROUP BY 1")
def class_means(spark, d):
    """Mean of two measures per class."""
    means = profile.class_means(read_table(spark, d, "part"), "p_brand", ["p_retailprice", "p_size"])
    return means.select("p_brand", *[F.round(c, 6).alias(c) for c in means.columns[1:]])


@query(f"WITH {DATED} SELECT date, avg(n_chars) AS n_chars FROM dated GROUP BY date")
def daily_mean_score(spark, d):
    """Mean of one document score per day."""
    return profile.daily_means(dated_documents(spark, d), "date", ["n_chars"])


@query(f"WITH {DATED} SELECT date, avg(n_chars) AS up, avg(length(source)) AS flat, avg(doc_id) AS down FROM dated GROUP BY date")
def daily_mean_scores(spark, d):
    """Means of three document scores per day."""
    docs = dated_documents(spark, d).select("date", F.col("n_chars").alias("up"), F.length("source").alias("flat"), F.col("doc_id").alias("down"))
    return profile.daily_means(docs, "date", ["up", "flat", "down"])


@query(
    """SELECT round(avg(l_quantity), 6) AS mean_l_quantity, round(stddev_pop(l_quantity), 6) AS std_l_quantity,
    round(avg(l_discount), 6) AS mean_l_discount, round(stddev_pop(l_discount), 6) AS std_l_discount FROM lineitem"""
)
def mean_and_std(spark, d):
    """Mean and population standard deviation of two columns."""
    stats = profile.mean_and_std(read_table(spark, d, "lineitem"), ["l_quantity", "l_discount"])
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


# ---- windows


@query(
    f"""WITH {PANEL}, l AS (SELECT series, date, cap, lead(cap) OVER w AS label, lead(date) OVER w AS label_date
    FROM panel WINDOW w AS (PARTITION BY series ORDER BY date)) SELECT * FROM l WHERE label_date IS NOT NULL"""
)
def next_day_label(spark, d):
    """Each day with the next trading day's value."""
    return series.labelled_rows(panel(spark, d).select("series", "date", "cap"), "series", "date", "cap")


@query(f"WITH {_BATCHES} SELECT * FROM batches")
def consecutive_batches(spark, d):
    """Runs of consecutive days in batches of at most five."""
    return series.consecutive_batches(panel(spark, d), "series", "date")


_LABELLED = """lab AS (SELECT *, lead(cap) OVER (PARTITION BY series ORDER BY date) AS label,
  lead(date) OVER (PARTITION BY series ORDER BY date) AS label_date FROM panel)"""


@query(
    f"""WITH {PANEL}, {_LABELLED}, r AS (SELECT series, label_date AS date, label AS actual, avg_price AS predicted,
    row_number() OVER (PARTITION BY series ORDER BY label_date DESC) AS k FROM lab WHERE label_date IS NOT NULL)
    SELECT series, date, actual, predicted FROM r WHERE k <= 200"""
)
def actual_and_predicted(spark, d):
    """Last 200 days per nation, actual next to predicted, by the day the prediction is for."""
    rows = series.labelled_rows(panel(spark, d), "series", "date", "cap").withColumn("prediction", F.col("avg_price"))
    return series.actual_and_predicted(rows, "series", "date", "cap", limit=200)


# ---- sets


@query(
    """SELECT p_size, p_retailprice, CAST(1 AS INTEGER) AS label FROM part WHERE p_brand = 'Brand#4'
    UNION ALL SELECT p_size, p_retailprice, CAST(0 AS INTEGER) FROM part WHERE p_brand = 'Brand#17'"""
)
def labelled_union(spark, d):
    """Two class slices with their label."""
    part = read_table(spark, d, "part")
    cut = {n: relational.class_slice(part, "p_brand", b, ["p_size", "p_retailprice"]) for n, b in ((1, "Brand#4"), (0, "Brand#17"))}
    return relational.labelled_union(cut)


@query("SELECT unnest(string_split(p_name, ' ')) AS word FROM part UNION SELECT DISTINCT p_type FROM part")
def vocabulary_union(spark, d):
    """Words of two vocabularies."""
    part = read_table(spark, d, "part")
    names = part.select(F.explode(text.split_words(F.col("p_name"))).alias("word"))
    return relational.merge_vocabulary(names, part.select(F.col("p_type").alias("word")))


# ---- scalar functions


def _order_dates(spark, d):
    day = F.col("o_orderdate")
    slashed = F.concat_ws("/", F.year(day), F.month(day), F.dayofmonth(day))
    return read_table(spark, d, "orders").select("o_orderkey", slashed.alias("day"), day.cast("date").alias("date"))


_DAY = "concat_ws('/', year(o_orderdate), month(o_orderdate), day(o_orderdate))"


@query(f"SELECT o_orderkey, CAST(replace({_DAY}, '/', '') AS INTEGER) AS day_int FROM orders")
def slash_date_to_int(spark, d):
    """Date text without zero padding joined to an int."""
    return _order_dates(spark, d).select("o_orderkey", dates.slash_date_to_int(F.col("day")).alias("day_int"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS day FROM orders")
def dotted_to_slash(spark, d):
    """Dotted dates with a closing dot to slashes."""
    dotted = F.date_format("date", "yyyy.MM.dd.")
    return _order_dates(spark, d).select("o_orderkey", dates.dotted_to_slash(dotted).alias("day"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders")
def slash_to_date(spark, d):
    """Date text without zero padding to a date."""
    return _order_dates(spark, d).select("o_orderkey", dates.slash_to_date(F.col("day")).alias("date"))


@query("SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS INTEGER) AS gap FROM orders")
def day_gap(spark, d):
    """Days up to a fixed date."""
    return _order_dates(spark, d).select("o_orderkey", dates.day_gap(F.lit("2001-08-01").cast("date"), F.col("date")).alias("gap"))


@query("SELECT doc_id, regexp_replace(text, '[^ㄱ-ㅎㅏ-ㅣ가-힣0-9a-zA-Z. ]', '', 'g') AS text FROM documents")
def keep_text_characters(spark, d):
    """Texts with the kept characters only."""
    return read_table(spark, d, "documents").select("doc_id", text.keep_text_characters(F.col("text")).alias("text"))


@query(rf"SELECT doc_id, trim(regexp_replace(text, '{SPACES}', ' ', 'g')) AS text FROM documents")
def collapse_space(spark, d):
    """Texts with single spaces."""
    return read_table(spark, d, "documents").select("doc_id", text.collapse_space(F.col("text")).alias("text"))


@query(
    r"SELECT doc_id, regexp_replace(concat(text, chr(1), chr(9), chr(11), text), '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS text FROM documents"
)
def strip_illegal_control(spark, d):
    """Control characters put into each text, then removed (tab stays)."""
    marked = F.concat("text", F.lit("\x01\t\x0b"), "text")
    return read_table(spark, d, "documents").select("doc_id", text.strip_illegal_control(marked).alias("text"))


@query("SELECT doc_id, concat(text, ' ', source, text) AS text FROM documents")
def strip_editor_markers(spark, d):
    """Editor markers put into each text, then removed."""
    marked = F.concat(F.lit("SUB_TITLE_START"), "text", F.lit(" "), "source", F.lit("SUB_TITLE_END"), "text")
    return read_table(spark, d, "documents").select("doc_id", text.strip_editor_markers(marked).alias("text"))


@query("SELECT doc_id, source || ' ' || text AS text FROM documents")
def title_and_body(spark, d):
    """Title and body as one text."""
    return read_table(spark, d, "documents").select("doc_id", text.title_and_body(F.col("source"), F.col("text")).alias("text"))


@query(
    """WITH t AS (SELECT doc_id, CASE WHEN lang = 'en' THEN text ELSE chr(CAST(44032 + (doc_id * 7919) % 11172 AS INTEGER)) || text END AS word FROM documents),
    j AS (SELECT doc_id, CASE WHEN unicode(word) BETWEEN 44032 AND 55203
      THEN substr('ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ', CAST((unicode(word) - 44032) // 588 + 1 AS INTEGER), 1) END AS initial FROM t)
    SELECT doc_id, initial, coalesce(initial, 'ABC') AS index_group FROM j"""
)
def initial_consonant(spark, d):
    """Texts led by a Hangul syllable (none for English): initial consonant and index group."""
    code = F.lit(44032) + F.pmod(F.col("doc_id") * 7919, F.lit(11172))
    syllable = F.decode(F.unhex(F.hex(code)), "UTF-16BE")
    word = F.when(F.col("lang") == "en", F.col("text")).otherwise(F.concat(syllable, F.col("text")))
    docs = read_table(spark, d, "documents").select("doc_id", word.alias("word"))
    return docs.select("doc_id", hangul.initial_consonant(F.col("word")).alias("initial"), hangul.index_group(F.col("word")).alias("index_group"))


@query(
    """SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words,
    array_to_string(list_filter(string_split(text, ' '), lambda w: length(w) > 3), ' ') AS long_words FROM documents"""
)
def split_and_join(spark, d):
    """Words by single spaces, counted and joined again."""
    words = text.split_words(F.col("text"))
    longer = F.filter(words, lambda w: F.length(w) > 3)
    return read_table(spark, d, "documents").select("doc_id", F.size(words).alias("n_words"), text.join_words(longer).alias("long_words"))


@query("SELECT p_partkey, round(log10(p_retailprice), 6) AS log_price, round(p_size / 7e0, 1) AS sevenths FROM part")
def log_and_round(spark, d):
    """Base-10 logarithm and rounding."""
    return read_table(spark, d, "part").select(
        "p_partkey", numeric.log10_rounded(F.col("p_retailprice")).alias("log_price"), F.round(F.col("p_size") / 7.0, 1).alias("sevenths")
    )


@query(
    """SELECT label, CAST(i - 1 AS INTEGER) AS position, round(avg(CAST(x AS DOUBLE)), 6) AS mean FROM
    (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i"""
)
def element_means(spark, d):
    """Mean of every element of an array per class."""
    means = vectors.element_means(read_table(spark, d, "embeddings"), "label", "embedding")
    return means.withColumn("mean", F.round("mean", 6))
