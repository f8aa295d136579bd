from pyspark.sql import functions as F

from seriesloom.operators import pages
from seriesloom.operators.pages import BODY_RULES, BodyRule
from seriesloom.registry import textual


def body(spark, html, rules):
    return spark.createDataFrame([(html,)], "html string").select(pages.extract_body(F.col("html"), rules)).first()[0]


def test_fallback_order(spark):
    chain = BODY_RULES[0]
    first = '<article class="story-news article"><p>one <b>two</b></p><i>no</i><p>three</p></article>'
    second = '<div class="x article-txt y"><p>second</p></div>'
    third = '<div id="articleBody">th<b>ir</b>d &amp; more</div>'
    fourth = "<div class='end_body_wrp'>fourth</div>"
    assert body(spark, fourth + third + second + first, chain) == "one two three"
    assert body(spark, fourth + third + second, chain) == "second"
    assert body(spark, fourth + third, chain) == "third & more"
    assert body(spark, fourth, chain) == "fourth"
    assert body(spark, "<div class='article-txtual'><p>no</p></div>", chain) is None


def test_nested_containers_and_hidden_text(spark):
    html = '<div class="detail-body">a<div>b<div>c</div></div><!-- x --><script>var t="</p>";</script>d</div>e<div class="detail-body">f</div>'
    assert body(spark, html, BODY_RULES[2]) == "a b c d f"
    assert body(spark, '<div class="detail-body">open <divider>end', BODY_RULES[2]) == "open end"
    assert body(spark, "<p>nothing</p>", BODY_RULES[2]) is None


def test_markers_and_publishers(spark):
    assert body(spark, '<p class="content_text">SUB_TITLE_STARTa\n b</p><p>x</p><p class="content_text">cSUB_TITLE_END</p>', BODY_RULES[4]) == "a b c"
    df = spark.createDataFrame([(2, '<div class="detail-body">k</div>'), (3, '<div class="text_area">s</div>'), (3, "<p>-</p>"), (9, "")], "press int, html string")
    got = pages.article_bodies(df, "html", BODY_RULES, F.col("press"))
    assert sorted((r["press"], r["section"] or "") for r in got.collect()) == [(2, "k"), (3, ""), (3, "s"), (9, "")]
    assert pages.with_body(got).count() == 2


def test_news_list(spark):
    item = (
        '<li id="sp_nws{n}"><div class="news_area"><div class="news_info"><div class="info_group"><a class="info press"><span>i</span>KBS</a>'
        '{extra}<span class="info">2021.09.2{n}.</span></div></div><a href="http://x/{n}?a=1&amp;b=2" class="news_tit" title="T &quot;{n}&quot;">t</a></div></li>'
    )
    html = "<ul class='list_news'>" + item.format(n=1, extra='<span class="info">A1</span>') + item.format(n=2, extra="") + "</ul><ul><li>other</li></ul>"
    got = pages.news_items(spark.createDataFrame([(1, html)], "page_id int, html string"), ["page_id"]).orderBy("position").collect()
    assert [(r["date"], r["url"], r["press"], r["title"]) for r in got] == [
        ("2021.09.21.", "http://x/1?a=1&b=2", "KBS", 'T "1"'),
        ("2021.09.22.", "http://x/2?a=1&b=2", "KBS", 'T "2"'),
    ]


def test_follow_alternate(spark):
    rows = [("a", '<link rel="amphtml" href="b">'), ("b", "old"), ("b", "body"), ("c", "<link href='gone' rel='amphtml'>"), ("d", '<link rel="canonical" href="b">'), (None, "x")]
    got = pages.follow_alternate(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id int, url string, html string")).collect()
    assert sorted((r["page_id"], r["url"], r["alternate_url"], r["alternate_html"]) for r in got) == [
        (0, "a", "b", "body"), (1, "b", None, None), (2, "b", None, None), (3, "c", "gone", None), (4, "d", None, None), (5, None, None, None)
    ]


def test_class_and_id_are_whole_words(spark):
    assert body(spark, '<div class="my-article-txt"><p>no</p></div>', BODY_RULES[0]) is None
    assert body(spark, '<div data-class="detail-body">no</div>', BODY_RULES[2]) is None
    assert body(spark, '<div data-id="articleBody">no</div>', BODY_RULES[0]) is None
    assert body(spark, '<div-x class="detail-body">no</div-x>', BODY_RULES[2]) is None
    assert body(spark, '<div title="t" class="a detail-body b">yes</div>', BODY_RULES[2]) == "yes"


def test_character_references(spark):
    texts = ["a&hellip;b &#8217;&#x2019; &amp;lt; &nosuch; &#0;&#xD800; &#151; &eacute;&Eacute; & &amp x&lt;y&gt;", "plain", None, "&#128512;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(pages.unescape(F.col("t"))).collect()]
    assert got == ["a…b ’’ &lt; &nosuch; �� — éÉ & &amp x<y>", "plain", None, "😀"]


def test_article_plan(spark, tmp_path):
    from seriesloom.plans.articles import articles

    item = '<li id="sp_nws{0}"><div class="news_area"><div class="info_group"><a class="info press">{1}</a><span class="info">2021.09.24.</span></div><ul><li>x</li></ul><a class="news_tit" href="u{0}" title="t{0}">t</a></div></li>'
    press = ["연합뉴스", "조선일보", "KBS", "unknown", "SBS", "KBS"]
    listing = "<ul class='list_news'>" + "".join(item.format(i, p) for i, p in enumerate(press)) + "</ul>"
    stored = [
        (1, "u0", '<div id="articleBody">zero</div>'), (2, "u1", '<link rel="amphtml" href="amp">'), (3, "amp", '<section class="article-body"><p>one</p></section>'),
        (4, "u2", '<div class="detail-body">old</div>'), (5, "u2", '<div class="detail-body">two</div>'), (6, "u4", "<p>none</p>"),
    ]
    got = articles(spark.createDataFrame([(1, listing)], "page_id int, html string"), spark.createDataFrame(stored, "page_id int, url string, html string")).collect()
    assert sorted((r["url"], r["press"], r["title"], r["section"]) for r in got) == [("u0", "연합뉴스", "t0", "zero"), ("u1", "조선일보", "t1", "one"), ("u2", "KBS", "t2", "two")]


def test_attribute_rule(spark):
    assert body(spark, '<html lang="fr"><p>x</p></html>', [BodyRule("html", "lang", "fr")]) == "x"
    assert body(spark, '<html lang="en"><p>x</p></html>', [BodyRule("html", "lang", "fr")]) is None


def test_html_moves_once(spark):
    rows = spark.createDataFrame([(1, "u"), (2, "u"), (3, None), (4, "none"), (5, "v")], "item int, address string")
    stored = spark.createDataFrame([(1, "u", "old"), (2, "u", "new"), (3, "v", None), (4, None, "x")], "page_id int, url string, html string")
    found = pages.with_page(rows, "item", "address", stored, "body")
    assert found.columns == ["item", "address", "body"]
    assert {tuple(r) for r in found.collect()} == {(1, "u", "new"), (2, "u", "new"), (3, None, None), (4, "none", None), (5, "v", None)}
    # The last join is that with the pages; the HTML goes through no other after it.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_page#" in next(line for line in plan.splitlines() if "Join " in line)


def test_article_job_parses_its_lists_on_all_cores(spark, monkeypatch):
    seen = []
    real = textual.collect_articles
    monkeypatch.setattr(textual, "collect_articles", lambda s, listed, *a: seen.append(listed.rdd.getNumPartitions()) or real(s, listed, *a))
    textual.article_job(spark, "/root/testdata/sf0.001")
    assert min(seen) >= spark.sparkContext.defaultParallelism > 1
