"""Queries over documents and pages: extraction, corpus statistics, TF-IDF, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.functions.text import join_words, spaced_tokens
from seriesloom.operators import pages, profile, relational, skipgram, tfidf, vectors, wordstats
from seriesloom.operators.lookup import elements
from seriesloom.plans import news_score
from seriesloom.plans.articles import collect_articles
from seriesloom.registry.base import SPACES, query
from seriesloom.session import materialise, scratch_path, spread
from seriesloom.sources import store
from seriesloom.sources.readers import read_table

# ---- pages

# The references that the driver's pages hold.
_UNESCAPE_SQL = """replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&')"""

_STRIP_SQL = (
    r"trim(regexp_replace("
    + _UNESCAPE_SQL.format(
        r"regexp_replace(regexp_replace({}, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    )
    + f", '{SPACES}', ' ', 'g'))"
)


def _text_sql(tag: str) -> str:
    inner = rf"regexp_extract(html, '(?is)<{tag}\b[^>]*>(.*?)</{tag}>', 1)"
    return _STRIP_SQL.replace("{}", inner)


@query(f"SELECT page_id, {_text_sql('article')} AS section FROM pages")
def article_bodies(spark, d):
    """Body text by the rules of five publishers, each ending in the plain article container."""
    rules = {i: (*chain, pages.BodyRule("article")) for i, chain in pages.BODY_RULES.items()}
    publisher = F.pmod(F.col("page_id"), F.lit(len(rules)))
    found = pages.article_bodies(_pages(spark, d), "html", rules, publisher)
    return found.select("page_id", "section")


# Every page's whole article in the container of one of the publishers; the last kind has none.
_ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article>"
_HEADLINE = r"(?is)<h1\b[^>]*>(.*?)</h1>"
_INNER = f"regexp_extract(html, '{_ARTICLE}', 1)"
_PLAIN_SQL = _UNESCAPE_SQL.format(r"regexp_replace({}, '(?s)<[^>]*>', '{gap}', 'g')")


def _whole_sql(html: str, gap: str = " ") -> str:
    return _PLAIN_SQL.replace("{gap}", gap).replace("{}", html)


def _paragraphs_sql(html: str) -> str:
    return rf"array_to_string([{_whole_sql('x')} FOR x IN regexp_extract_all({html}, '(?is)<p\b[^>]*>(.*?)</p>', 1)], ' ')"


# Publisher, markup before and after the article, and the text its rule gives.
_CONTAINERS = [
    (0, '<article class="story-news article">', "<i>no</i><p>tail</p></article>", _paragraphs_sql(f"({_INNER} || '<i>no</i><p>tail</p>')")),
    (0, '<div class="x article-txt y">', "</div>", _paragraphs_sql(_INNER)),
    (0, '<div data-id="articleBody">no</div><div id="articleBody">', "<b>!</b></div>", _whole_sql(_INNER, "") + " || '!'"),
    (0, "<div class='end_body_wrp'>", "</div>", _whole_sql(_INNER, "")),
    (1, '<section class="article-body">', "</section>", _paragraphs_sql(_INNER)),
    (2, '<div class="detail-body">', '<div>in</div></div><div class="detail-body">two</div>', _whole_sql(_INNER) + " || ' in two'"),
    (3, '<div class="text_area">', "</div>", _whole_sql(_INNER)),
    (4, '<p class="content_text">SUB_TITLE_START', '</p><p>no</p><p class="content_text">ySUB_TITLE_END</p>', _whole_sql(_INNER) + " || ' y'"),
    (2, '<div class="my-detail-body" data-class="detail-body">', "</div>", "NULL"),
]
#: The kind whose container is a paragraph: paragraphs inside it are written as blocks.
_IN_PARAGRAPH = 7
_WORDS = {i: c[3] for i, c in enumerate(_CONTAINERS)}
_SECTION = f"trim(regexp_replace(CASE page_id % {len(_CONTAINERS)} " + " ".join(f"WHEN {i} THEN {w}" for i, w in _WORDS.items()) + f" END, '{SPACES}', ' ', 'g'))"
_PRESS = f"CASE page_id % {len(_CONTAINERS)} " + " ".join(f"WHEN {i} THEN '{pages.PUBLISHERS[c[0]]}'" for i, c in enumerate(_CONTAINERS)) + " END"
_ITEM = f"""CAST('2021.09.' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '.' AS VARCHAR) AS date, 'http://news/' || page_id || '?a=1&b=2' AS url,
    {_PRESS} AS press, {_UNESCAPE_SQL.format(f"regexp_extract(html, '{_HEADLINE}', 1)")} AS title"""


def _kind():
    return F.pmod(F.col("page_id"), F.lit(len(_CONTAINERS))).cast("int")


def _publisher_pages(spark, d):
    """``(page_id, url, press_index, html)``: each driver page's whole article as one publisher would have it."""
    inner = F.regexp_extract("html", _ARTICLE, 1)
    article = F.when(_kind() == _IN_PARAGRAPH, F.regexp_replace(inner, r"(?i)<(/?)p\b", "<$1div")).otherwise(inner)
    before, after = (F.get(F.array(*[F.lit(c[i]) for c in _CONTAINERS]), _kind()) for i in (1, 2))
    press = F.get(F.array(*[F.lit(c[0]) for c in _CONTAINERS]), _kind())
    url = F.concat(F.lit("http://news/"), "page_id", F.lit("?a=1&b=2"))
    return _pages(spark, d).select("page_id", url.alias("url"), press.alias("press_index"), F.concat(before, article, after).alias("html"))


def _listings(spark, d):
    """Search pages of ten results each, titled by the headlines of the pages."""
    title = F.replace(F.regexp_extract("html", _HEADLINE, 1), F.lit('"'), F.lit("&quot;"))
    press = F.get(F.array(*[F.lit(pages.PUBLISHERS[c[0]]) for c in _CONTAINERS]), _kind())
    day = F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")
    item = F.concat(
        F.lit('<li class="bx" id="sp_nws'), "page_id", F.lit('"><div class="news_wrap"><div class="news_area"><div class="news_info"><div class="info_group"><a class="info press"><span>i</span>'),
        press, F.lit('</a><span class="info">A1</span><span class="info">2021.09.'), day,
        F.lit('.</span></div></div><ul class="more"><li>other</li></ul><a href="http://news/'), "page_id", F.lit('?a=1&amp;b=2" class="news_tit" title="'),
        title, F.lit('">t</a></div></div></li>'),
    )
    rows = _pages(spark, d).select("page_id", F.floor(F.col("page_id") / 10).alias("list"), item.alias("item"))
    listed = rows.groupBy("list").agg(F.sort_array(F.collect_list(F.struct("page_id", "item")))["item"].alias("items"))
    html = F.concat(F.lit("<ul><li>menu</li></ul><ul class='type list_news'>"), F.array_join("items", ""), F.lit("</ul><ul><li>end</li></ul>"))
    return listed.select(F.col("list").alias("page_id"), html.alias("html"))


@query(f"SELECT page_id, {_SECTION} AS section FROM pages")
def publisher_bodies(spark, d):
    """Body text by the rules of all five publishers, null where no rule fits."""
    found = pages.article_bodies(_publisher_pages(spark, d), "html", pages.BODY_RULES, F.col("press_index"))
    return found.select("page_id", "section")


@query(f"SELECT page_id, section FROM (SELECT page_id, {_SECTION} AS section FROM pages) WHERE section IS NOT NULL AND section <> ''")
def articles_with_body(spark, d):
    """Pages that give a body by the rules of their publisher."""
    found = pages.article_bodies(_publisher_pages(spark, d), "html", pages.BODY_RULES, F.col("press_index"))
    return pages.with_body(found.select("page_id", "section"))


@query(f"SELECT page_id // 10 AS page_id, CAST(row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) - 1 AS INTEGER) AS position, {_ITEM} FROM pages")
def news_items(spark, d):
    """Every result of stored search pages."""
    return pages.news_items(_listings(spark, d), ["page_id"])


@query(f"SELECT {_ITEM}, {_SECTION} AS section FROM pages WHERE {_SECTION} <> ''")
def article_job(spark, d):
    """Search pages to the article table, run twice: the second run adds nothing."""
    path = scratch_path(spark, "articles")
    found = _publisher_pages(spark, d)
    # The second publisher's own page only names the page that holds the article.
    link = F.concat(F.lit('<link rel="amphtml" href="'), F.replace(F.concat("url", F.lit("&amp=1")), F.lit("&"), F.lit("&amp;")), F.lit('">'))
    second = F.col("press_index") == pages.ALTERNATE_PUBLISHER
    own = F.struct((F.col("page_id") * 2).alias("page_id"), "url", F.when(second, link).otherwise(F.col("html")).alias("html"))
    alternate = F.struct((F.col("page_id") * 2 + 1).alias("page_id"), F.concat("url", F.lit("&amp=1")).alias("url"), "html")
    both = elements(found, [], F.when(second, F.array(own, alternate)).otherwise(F.array(own)), "page").select("page.*")
    stored, listed = materialise(both), spread(materialise(_listings(spark, d)))
    for _ in range(2):
        collect_articles(spark, listed, stored, path)
    return spark.read.parquet(path)


@query(
    r"""WITH i AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li><a\b.*?</li>')) AS item,
      unnest(range(len(regexp_extract_all(html, '(?is)<li><a\b.*?</li>')))) AS position FROM pages)
    SELECT page_id, CAST(position AS INTEGER) AS position, """
    + _UNESCAPE_SQL.format("regexp_extract(item, 'href=\"([^\"]*)\"', 1)") + " AS url, "
    + _UNESCAPE_SQL.format("regexp_extract(item, '>([^<]*)</a>', 1)") + " AS title FROM i"
)
def list_items(spark, d):
    """One row per list entry of every page."""
    fields = {"url": 'href="([^"]*)"', "title": ">([^<]*)</a>"}
    return pages.items(_pages(spark, d), ["page_id"], "html", r"(?is)<li><a\b.*?</li>", fields)


@query(
    """SELECT p.page_id, q.url AS alternate_url, CAST(length(q.html) AS INTEGER) AS n_chars
    FROM pages p JOIN pages q ON q.page_id = p.page_id // 3"""
)
def alternate_page(spark, d):
    """Pages given a link to an earlier page, and the length of the page behind the link."""
    table = read_table(spark, d, "pages")
    target = table.select(F.col("page_id").alias("to"), F.col("url").alias("to_url"))
    linked = table.withColumn("to", F.floor(F.col("page_id") / 3)).join(target, "to")
    address = F.replace(F.col("to_url"), F.lit("&"), F.lit("&amp;"))
    link = F.concat(F.lit('<link rel="amphtml" href="'), address, F.lit('">'))
    html = F.concat(link, F.col("html"))
    followed = pages.follow_alternate(materialise(linked.select("page_id", "url", html.alias("html"))))
    length = F.length("alternate_html") - F.length(F.regexp_extract("alternate_html", "^<link[^>]*>", 0))
    return followed.select("page_id", "alternate_url", length.alias("n_chars"))


# ---- word statistics

_TOKENS = f"""tok AS (SELECT doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS token FROM
    (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '{SPACES}', ' ', 'g')), ' '), lambda t: t <> '') AS words FROM documents))"""
_COUNTS = f"{_TOKENS}, counts AS (SELECT token, CAST(count(*) AS BIGINT) AS n FROM tok GROUP BY 1)"
_COHESION = """cohesion AS (SELECT prefix AS token, CAST(freq AS BIGINT) AS freq, pow(freq / first_n, 1e0 / (length(prefix) - 1)) AS score
    FROM (SELECT substr(token, 1, k) AS prefix, sum(n) AS freq FROM
            (SELECT token, n, unnest(range(2, length(token) + 1)) AS k FROM counts) GROUP BY 1) p
    JOIN (SELECT substr(token, 1, 1) AS f, sum(n) AS first_n FROM counts GROUP BY 1) c ON c.f = substr(p.prefix, 1, 1)
    WHERE freq >= 100 AND pow(freq / first_n, 1e0 / (length(prefix) - 1)) >= 0.05)"""

# What a right part says about its left part; the user's table in real use.
RIGHT_PARTS = [
    ("s", 1), ("es", 1), ("tion", 1), ("er", 1), ("e", 1), ("ment", 1), ("ein", 1), ("ón", 1),
    ("ed", -1), ("ing", -1), ("en", -1), ("ly", -1), ("te", -1), ("re", -1),
]
_RIGHT = "right_parts(r, polarity) AS (VALUES " + ", ".join(f"('{r}', {p})" for r, p in RIGHT_PARTS) + ")"
_NOUNS = f"""{_RIGHT}, nouns AS (SELECT token, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg, (pos - neg) / (pos + neg) AS score FROM
    (SELECT l AS token, sum(CASE WHEN polarity > 0 THEN n ELSE 0 END) AS pos, sum(CASE WHEN polarity < 0 THEN n ELSE 0 END) AS neg FROM
      (SELECT substr(token, 1, k) AS l, substr(token, k + 1) AS r, n FROM
        (SELECT token, n, unnest(range(1, length(token) + 1)) AS k FROM counts)) s
      JOIN right_parts USING (r) GROUP BY 1) WHERE (pos - neg) / (pos + neg) >= 0.3)"""
_COMBINED = """combined AS (SELECT token, CASE WHEN nouns.score IS NOT NULL THEN nouns.score + coalesce(cohesion.score, 0) ELSE cohesion.score END AS score
    FROM nouns FULL JOIN cohesion USING (token))"""
_LEFTS = """lefts AS (SELECT token, arg_max(prefix, {'s': coalesce(score, 0e0), 'l': length(prefix)}) AS lft FROM
    (SELECT c.token, substr(c.token, 1, k) AS prefix FROM
      (SELECT token, unnest(range(2, length(token) + 1)) AS k FROM counts WHERE length(token) > 2) c) x
    LEFT JOIN (SELECT token AS prefix, score FROM combined) y USING (prefix) GROUP BY token
    UNION ALL SELECT token, token FROM counts WHERE length(token) <= 2)"""


def _docs(spark, d):
    return spread(read_table(spark, d, "documents").select("doc_id", "text"))


def _pages(spark, d):
    return spread(read_table(spark, d, "pages"))


def _counts(spark, d):
    return wordstats.token_counts(_docs(spark, d), spaced_tokens(F.col("text")))


def _right_parts(spark):
    return relational.parameter_table(spark, RIGHT_PARTS, "r string, polarity int")


@query(f"WITH {_COUNTS} SELECT token, n FROM counts ORDER BY n DESC, token LIMIT 200")
def top_words(spark, d):
    """The 200 most frequent tokens."""
    return wordstats.top_words(_docs(spark, d), spaced_tokens(F.col("text")), 200)


@query(f"WITH {_COUNTS}, {_COHESION} SELECT token, freq, round(score, 9) AS score FROM cohesion")
def word_cohesion(spark, d):
    """Forward cohesion of frequent prefixes."""
    return wordstats.cohesion_scores(materialise(_counts(spark, d))).withColumn("score", F.round("score", 9))


@query(
    f"""WITH {_COUNTS}, nexts AS (SELECT substr(token, 1, k) AS token, substr(token, k + 1, 1) AS nx, sum(n) AS c FROM
      (SELECT token, n, unnest(range(1, length(token))) AS k FROM counts) GROUP BY 1, 2),
    p AS (SELECT *, c / sum(c) OVER (PARTITION BY token) AS share FROM nexts),
    whole AS (SELECT token, sum(n) AS n FROM counts GROUP BY 1)
    SELECT token, CAST(sum(c) AS BIGINT) AS freq, CAST(count(*) AS BIGINT) AS n_next, round(0e0 - sum(share * ln(share)), 6) AS entropy
    FROM p LEFT JOIN whole USING (token) GROUP BY 1 HAVING sum(c) + coalesce(max(n), 0) >= 100"""
)
def right_branching_entropy(spark, d):
    """Entropy of the next character of every prefix."""
    return wordstats.right_branching_entropy(materialise(_counts(spark, d))).withColumn("entropy", F.round("entropy", 6))


@query(
    f"""WITH {_COUNTS}, {_NOUNS}, halves AS (SELECT DISTINCT token FROM
      (SELECT token, substr(token, 1, k) AS a, substr(token, k + 1) AS b FROM
        (SELECT token, unnest(range(2, length(token) - 1)) AS k FROM nouns))
      WHERE a IN (SELECT token FROM nouns) AND b IN (SELECT token FROM nouns))
    SELECT token, pos, neg, round(score, 9) AS score, token IN (SELECT token FROM halves) AS is_compound FROM nouns"""
)
def noun_scores(spark, d):
    """Noun score of left parts, with compounds marked."""
    nouns = materialise(wordstats.noun_scores(_counts(spark, d), _right_parts(spark)))
    return wordstats.flag_compounds(nouns).withColumn("score", F.round("score", 9))


@query(f"WITH {_COUNTS}, {_COHESION}, {_NOUNS}, {_COMBINED} SELECT token, round(score, 9) AS score FROM combined")
def token_scores(spark, d):
    """Noun and cohesion scores combined."""
    counts = materialise(_counts(spark, d))
    return news_score.token_scores(counts, _right_parts(spark)).withColumn("score", F.round("score", 9))


@query(
    f"""WITH {_COUNTS}, {_COHESION}, {_NOUNS}, {_COMBINED}, {_LEFTS}
    SELECT doc_id, string_agg(lft, ' ' ORDER BY pos) AS tokens FROM tok JOIN lefts USING (token) GROUP BY doc_id"""
)
def left_part_tokens(spark, d):
    """Documents with every token cut to its best left part."""
    counts = materialise(_counts(spark, d))
    scores = materialise(news_score.token_scores(counts, _right_parts(spark)))
    lefts = materialise(wordstats.left_parts(counts, scores))
    cut = wordstats.tokenise(_docs(spark, d), "doc_id", spaced_tokens(F.col("text")), lefts, counts)
    return cut.select("doc_id", join_words(F.col("tokens")).alias("tokens"))


@query(
    """WITH w AS (SELECT doc_id, text, list_transform(string_split(text, ' '), lambda x: {'done': CAST([] AS VARCHAR[]), 'cur': x, 'size': CAST(length(x) AS BIGINT)}) AS ws FROM documents),
    r AS (SELECT doc_id, text, list_reduce(ws, lambda a, x: {
        'done': CASE WHEN a.size + x.size >= 500 AND a.cur IS NOT NULL THEN list_append(a.done, a.cur) ELSE a.done END,
        'cur': CASE WHEN a.size + x.size >= 500 OR a.cur IS NULL THEN x.cur ELSE a.cur || ' ' || x.cur END,
        'size': CASE WHEN a.size + x.size >= 500 THEN x.size ELSE a.size + x.size END},
        {'done': CAST([] AS VARCHAR[]), 'cur': CAST(NULL AS VARCHAR), 'size': CAST(0 AS BIGINT)}) AS z FROM w),
    c AS (SELECT doc_id, CASE WHEN length(text) < 500 THEN [text] WHEN z.size > 0 THEN list_append(z.done, z.cur) ELSE z.done END AS l FROM r)
    SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS piece, unnest(l) AS chunk FROM c"""
)
def text_chunks(spark, d):
    """Texts cut at words into pieces of fewer than 500 letters."""
    return wordstats.chunks(_docs(spark, d), "doc_id", "text")


# ---- TF-IDF

_TERMS = r"""terms AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
  dfs AS (SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY 1),
  nd AS (SELECT count(*) AS n FROM documents),
  vocab AS (SELECT term, df, total, ln((1 + n) / (1 + df)) + 1 AS idf FROM dfs, nd WHERE df >= 0.011 * n AND df <= 0.2 * n)"""


def _vocabulary(spark, d, **options):
    return tfidf.fit_tfidf(_docs(spark, d), **options)


@query(f"WITH {_TERMS} SELECT term, df, round(idf, 9) AS idf FROM vocab")
def tfidf_vocabulary(spark, d):
    """Terms within the document-frequency limits and their idf."""
    return _vocabulary(spark, d).withColumn("idf", F.round("idf", 9))


@query(
    f"""WITH {_TERMS}, w AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w"""
)
def tfidf_weights(spark, d):
    """Normalised weight of every term of every document."""
    vocabulary = materialise(_vocabulary(spark, d))
    weights = tfidf.transform_tfidf(_docs(spark, d), vocabulary, "doc_id")
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query(f"WITH {_TERMS} SELECT term, round(idf, 9) AS idf FROM vocab ORDER BY vocab.idf, term LIMIT 100")
def commonest_by_idf(spark, d):
    """First 100 terms in order of idf."""
    return tfidf.rank_by_idf(_vocabulary(spark, d), 100).withColumn("idf", F.round("idf", 9))


@query(f"WITH {_TERMS} SELECT term, round(idf, 9) AS idf FROM vocab ORDER BY vocab.idf DESC, term DESC LIMIT 100")
def rarest_by_idf(spark, d):
    """Last 100 terms in order of idf."""
    return tfidf.rank_by_idf(_vocabulary(spark, d), 100, rarest_first=True).withColumn("idf", F.round("idf", 9))


@query(f"WITH {_TERMS} SELECT term, df, total FROM vocab ORDER BY total DESC, term LIMIT 100")
def top_terms(spark, d):
    """The 100 terms with the largest count."""
    return _vocabulary(spark, d, max_features=100).select("term", "df", "total")


@query(
    f"""WITH {_TERMS}, e AS (SELECT min(idf) AS lo, max(idf) AS hi FROM vocab),
    b AS (SELECT least(CAST(floor((idf - lo) * 10 / (hi - lo)) AS INTEGER), 9) AS bin, count(*) AS n FROM vocab, e GROUP BY 1)
    SELECT CAST(i.bin AS INTEGER) AS bin, round(lo + (hi - lo) * i.bin / 10, 9) AS bin_low, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM (SELECT unnest(range(10)) AS bin) i CROSS JOIN e LEFT JOIN b USING (bin)"""
)
def idf_histogram(spark, d):
    """Idf values in ten bins."""
    vocabulary = materialise(_vocabulary(spark, d))
    return profile.histogram(vocabulary, "idf").withColumn("bin_low", F.round("bin_low", 9))


@query(
    f"""WITH {_TERMS}, w AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents))
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words FROM w WHERE word IN (SELECT term FROM vocab) GROUP BY doc_id"""
)
def vocabulary_words(spark, d):
    """Documents cut to vocabulary words as written."""
    vocabulary = materialise(_vocabulary(spark, d))
    kept = tfidf.checked_corpus(_docs(spark, d), vocabulary, "doc_id")
    return kept.select("doc_id", join_words(F.col("words")).alias("words"))


@query(
    f"""WITH {_TERMS}, w AS (SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM (SELECT doc_id, string_split(lower(text), ' ') AS ws FROM documents))
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words FROM w WHERE word IN (SELECT term FROM vocab) GROUP BY doc_id"""
)
def vocabulary_words_lowered(spark, d):
    """Documents cut to vocabulary words, lower-cased first."""
    vocabulary = materialise(_vocabulary(spark, d))
    kept = tfidf.checked_corpus(_docs(spark, d), vocabulary, "doc_id", normalize=True)
    return kept.select("doc_id", join_words(F.col("words")).alias("words"))


@query(
    f"""WITH {_TERMS}, top AS (SELECT term, idf FROM vocab ORDER BY total DESC, term LIMIT 2),
    w AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN top USING (term)),
    x AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM w),
    n AS (SELECT min(term) AS t0, max(term) AS t1 FROM top),
    g AS (SELECT sum(p * p) AS a, sum(p * q) AS b, sum(q * q) AS c FROM
      (SELECT doc_id, coalesce(max(x) FILTER (term = t0), 0) AS p, coalesce(max(x) FILTER (term = t1), 0) AS q FROM x, n GROUP BY doc_id)),
    e AS (SELECT *, (a + c) / 2 + sqrt((a - c) ** 2 / 4 + b * b) AS l0, (a + c) / 2 - sqrt((a - c) ** 2 / 4 + b * b) AS l1 FROM g),
    v AS (SELECT *, b / sqrt(b * b + (l0 - a) ** 2) AS u0, (l0 - a) / sqrt(b * b + (l0 - a) ** 2) AS u1 FROM e),
    s AS (SELECT *, sign(CASE WHEN abs(u0) >= abs(u1) THEN u0 ELSE u1 END) AS s0, sign(CASE WHEN abs(u1) > abs(u0) THEN -u1 ELSE u0 END) AS s1 FROM v)
    SELECT t0 AS term, round(u0 * s0 * sqrt(l0), 6) AS axis1, round(CASE WHEN abs(u1) >= abs(u0) THEN abs(u1) ELSE -u1 * sign(u0) END * sqrt(l1), 6) AS axis2 FROM s, n
    UNION ALL SELECT t1, round(u1 * s0 * sqrt(l0), 6), round(CASE WHEN abs(u0) > abs(u1) THEN abs(u0) ELSE -u0 * sign(u1) END * sqrt(l1), 6) FROM s, n"""
)
def term_map_of_two(spark, d):
    """The two top terms on their axes, which two-by-two eigenvectors give."""
    vocabulary = materialise(_vocabulary(spark, d, max_features=2))
    points = tfidf.term_map(tfidf.transform_tfidf(_docs(spark, d), vocabulary, "doc_id"), vocabulary, "doc_id")
    return points.select("term", F.round("axis1", 6).alias("axis1"), F.round("axis2", 6).alias("axis2"))


@query()
def term_map(spark, d):
    """The 100 top terms on the two main axes of the document-term matrix."""
    vocabulary = materialise(_vocabulary(spark, d, max_features=100))
    weights = tfidf.transform_tfidf(_docs(spark, d), vocabulary, "doc_id")
    return tfidf.term_map(weights, vocabulary, "doc_id")


# ---- vectors

WIDTH = 200
_CENTROIDS = """cent AS (SELECT label, list(m ORDER BY i) AS v FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM
    (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY label)"""
_ANCHOR_NAMES = {"0": "up", "1": "flat", "2": "down"}
_SIMILAR = f"""{_CENTROIDS}, sims AS (SELECT vec_id, """ + ", ".join(
    f"list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM cent WHERE label = {k})) AS {c}" for k, c in _ANCHOR_NAMES.items()
) + " FROM embeddings)"


def _similar(spark, d):
    table = read_table(spark, d, "embeddings")
    centroids = vectors.class_centroids(table, "label", "embedding")
    anchors = centroids.select(F.col("label").cast("string").alias("name"), "vector")
    return vectors.anchor_similarity(table.select("vec_id", "embedding"), "embedding", anchors, _ANCHOR_NAMES).drop("embedding")


@query(f"WITH {_SIMILAR} SELECT vec_id, round(up, 6) AS up, round(flat, 6) AS flat, round(down, 6) AS down FROM sims")
def anchor_similarity(spark, d):
    """Cosine of every vector to three class centroids."""
    return _similar(spark, d).select("vec_id", *[F.round(c, 6).alias(c) for c in _ANCHOR_NAMES.values()])


@query(
    f"""WITH {_COUNTS}, {_SIMILAR}, nv AS (SELECT count(*) AS n FROM embeddings),
    ws AS (SELECT token, up, flat, down FROM (SELECT token, CAST(('0x' || substr(md5(token), 1, 8)) AS BIGINT) % nv.n AS vec_id FROM counts, nv WHERE counts.n >= 2) JOIN sims USING (vec_id))
    SELECT doc_id, round(avg(up), 6) AS up, round(avg(flat), 6) AS flat, round(avg(down), 6) AS down, round(count(ws.token) / count(*), 6) AS coverage
    FROM tok LEFT JOIN ws USING (token) GROUP BY doc_id"""
)
def document_similarity(spark, d):
    """Mean similarity of each document's words; words seen once have no vector and lower the coverage."""
    similar = _similar(spark, d)
    n = read_table(spark, d, "embeddings").agg(F.count("*").alias("n")).scalar()
    number = F.conv(F.substring(F.md5(F.col("token").cast("binary")), 1, 8), 16, 10).cast("long")
    words = _counts(spark, d).where("n >= 2").select(F.col("token").alias("word"), (number % n).alias("vec_id"))
    word_scores = materialise(words.join(similar, "vec_id").drop("vec_id"))
    corpus = _docs(spark, d).select("doc_id", spaced_tokens(F.col("text")).alias("words"))
    scores = list(_ANCHOR_NAMES.values())
    table = vectors.document_similarity(corpus, "doc_id", "words", word_scores, scores)
    return table.select("doc_id", *[F.round(c, 6).alias(c) for c in [*scores, "coverage"]])


@query(
    """WITH t AS (SELECT 'v' || vec_id AS word, embedding AS vector FROM embeddings), p AS (SELECT 'v' || (vec_id * 2) AS word, list_reverse(embedding) AS vector FROM embeddings)
    SELECT word, round(coalesce(p.vector, t.vector)[1], 6) AS first, CAST(len(coalesce(p.vector, t.vector)) AS INTEGER) AS size FROM t FULL JOIN p USING (word)"""
)
def vector_overlay(spark, d):
    """Two vector tables; the second one's vectors win."""
    table = read_table(spark, d, "embeddings")
    trained = table.select(F.concat(F.lit("v"), "vec_id").alias("word"), F.col("embedding").alias("vector"))
    other = table.select(F.concat(F.lit("v"), F.col("vec_id") * 2).alias("word"), F.reverse("embedding").alias("vector"))
    both = vectors.overlay_vectors(trained, other)
    return both.select("word", F.round(F.get("vector", F.lit(0)), 6).alias("first"), F.size("vector").alias("size"))


def _trained(spark, d):
    vocabulary = materialise(_vocabulary(spark, d))
    corpus = materialise(tfidf.checked_corpus(_docs(spark, d), vocabulary, "doc_id", normalize=True))
    return vectors.train_word_vectors(corpus, size=WIDTH)


@query()
def word_vectors(spark, d):
    """200-dimensional vectors of every vocabulary word."""
    return store.vector_table(_trained(spark, d))


@query(
    f"""WITH {_TERMS}, w AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM documents)
    SELECT word, CAST({WIDTH} AS INTEGER) AS size, CAST({WIDTH} AS INTEGER) AS model_size FROM w WHERE word IN (SELECT term FROM vocab)"""
)
def word_vector_store(spark, d):
    """Vectors saved and loaded again: every word of the corpus, with the size of its vector."""
    model_path, table_path = scratch_path(spark, "model"), scratch_path(spark, "vectors")
    store.save_word_vectors(_trained(spark, d), model_path, table_path)
    model, table = store.load_word_vectors(spark, model_path, table_path)
    return table.select("word", F.size("vector").alias("size"), F.lit(model.getVectorSize()).alias("model_size"))


_NUMBERED = "CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT)"


@query(
    f"""WITH {_TERMS}, nv AS (SELECT count(*) AS n FROM embeddings),
    corpus AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM documents),
    known AS (SELECT term AS word, {_NUMBERED.replace("word", "term")} AS k FROM vocab),
    given AS (SELECT word, embedding FROM known JOIN embeddings ON vec_id = k % (SELECT n FROM nv) WHERE k % 2 = 0),
    words AS (SELECT word FROM corpus WHERE word IN (SELECT term FROM vocab) UNION SELECT word FROM given)
    SELECT word, CAST(64 AS INTEGER) AS size, given.word IS NOT NULL AS is_given,
      CASE WHEN given.word IS NOT NULL THEN CAST(embedding[1] AS DOUBLE) END AS first, CASE WHEN given.word IS NOT NULL THEN CAST(embedding[64] AS DOUBLE) END AS last
    FROM words LEFT JOIN given USING (word)"""
)
def continued_vectors(spark, d):
    """Training from given vectors: half of the vocabulary has one and keeps it, the other words of the corpus are added."""
    vocabulary = materialise(_vocabulary(spark, d))
    corpus = materialise(tfidf.checked_corpus(_docs(spark, d), vocabulary, "doc_id", normalize=True))
    table = read_table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    number = F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("long")
    n = table.agg(F.count("*").alias("n")).scalar()
    terms = vocabulary.select(F.col("term").alias("word"), number.alias("k")).where("k % 2 = 0")
    given = materialise(terms.select("word", (F.col("k") % n).alias("vec_id")).join(table, "vec_id").select("word", "vector"))
    trained = skipgram.continue_vectors(corpus, given, size=64, passes=2)
    of_given = given.select("word", F.lit(True).alias("is_given"))
    is_given = F.coalesce("is_given", F.lit(False))
    ends = [F.when(is_given, F.get("vector", F.lit(i))).alias(name) for i, name in ((0, "first"), (63, "last"))]
    return trained.join(of_given, "word", "left").select("word", F.size("vector").alias("size"), is_given.alias("is_given"), *ends)
