"""Article and listing extraction from stored pages with string expressions."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.text import collapse_space, strip_editor_markers
from seriesloom.operators.lookup import numbered_elements, salted_join
from seriesloom.session import materialise

# Named character references come from the HTML 5 table of the standard library. References to 128-159
# mean the characters of Windows code page 1252.
REFERENCE = r"^&(#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]*);"
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
LOW = [bytes([b]).decode("cp1252", "replace") for b in range(128, 160)]
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANY_TAG = r"(?s)<[^>]*>"


@dataclass(frozen=True)
class BodyRule:
    """Where one publisher keeps the body: a container, its text or its paragraphs."""

    tag: str
    attribute: str = ""
    value: str = ""
    paragraphs: bool = False
    every: bool = False
    spaced: bool = True

    @property
    def opening(self) -> str:
        """Pattern of the container's opening tag."""
        if not self.attribute:
            return rf"(?is)<{self.tag}(?![\w-])[^>]*>"
        named = rf"(?is)<{self.tag}(?![\w-])[^>]*(?<![\w-]){self.attribute}\s*=\s*[\"']"
        if self.attribute == "class":
            words = "".join(rf"(?=[^\"']*(?<![\w-]){w}(?![\w-]))" for w in self.value.split())
            return rf"{named}{words}[^\"']*[\"'][^>]*>"
        return rf"{named}{self.value}[\"'][^>]*>"


# Body containers by publisher index, tried in order.
BODY_RULES: dict[int, tuple[BodyRule, ...]] = {
    0: (
        BodyRule("article", "class", "story-news article", paragraphs=True),
        BodyRule("div", "class", "article-txt", paragraphs=True),
        BodyRule("div", "id", "articleBody", spaced=False),
        BodyRule("div", "class", "end_body_wrp", spaced=False),
    ),
    1: (BodyRule("section", "class", "article-body", paragraphs=True),),
    2: (BodyRule("div", "class", "detail-body", every=True),),
    3: (BodyRule("div", "class", "text_area", every=True),),
    4: (BodyRule("p", "class", "content_text", every=True),),
}
# The publishers by index, and the one whose articles are read on their alternate page.
PUBLISHERS = ["연합뉴스", "조선일보", "KBS", "SBS", "경향신문"]
ALTERNATE_PUBLISHER = 1


def _character(code: Column) -> Column:
    """The character with a code point; the replacement character for what is none."""
    known = F.when(code.between(128, 159), F.get(F.array(*map(F.lit, LOW)), (code - 128).cast("int")))
    none = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return known.when(none, F.lit("\ufffd")).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def unescape(text: Column) -> Column:
    """Character references that end in a semicolon back to characters; unknown names stay.

    The text is cut before every ampersand, so each reference is looked up once.
    """
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")  # one constant, not thousands

    def piece(part: Column) -> Column:
        name = F.regexp_extract(part, REFERENCE, 1)
        hexadecimal = name.rlike("^#[xX]")
        code = F.conv(F.regexp_replace(name, "^#[xX]?", ""), 16, 10).cast("long")
        code = F.when(hexadecimal, code).otherwise(F.regexp_replace(name, "^#", "").try_cast("long"))
        char = F.when(name.startswith("#"), _character(code)).otherwise(F.try_element_at(names, name))
        return F.when(char.isNull(), part).otherwise(F.concat(char, F.substr(part, F.length(name) + F.lit(3))))

    def decoded(value: Column) -> Column:
        pieces = F.array_join(F.transform(F.split(value, "(?=&)", -1), piece), "")
        return F.when(F.contains(value, F.lit("&")), pieces).otherwise(value)

    return _bind(text, decoded)


def visible_text(html: Column, spaced: bool = True) -> Column:
    """Text between tags: joined by a space, or run together with ``spaced=False``."""
    shown = F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), ANY_TAG, " " if spaced else "")
    return collapse_space(unescape(shown))


def _inside(after_opening: Column, tag: str) -> Column:
    """What precedes the closing tag that matches an opening tag just passed.

    The text is cut before every opening and closing tag of that name; the depth is counted along the
    pieces until it returns to zero. A container that is never closed reaches to the end.
    """
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))

    def step(acc: Column, piece: Column) -> Column:
        change = F.when(piece.rlike(rf"(?i)^</{tag}(?![\w-])"), -1).when(piece.rlike(rf"(?i)^<{tag}(?![\w-])"), 1).otherwise(0)
        depth = acc["depth"] + change
        inside = F.struct(depth.alias("depth"), (acc["kept"] + F.when(depth > 0, 1).otherwise(0)).alias("kept"))
        return F.when(acc["depth"] > 0, inside).otherwise(acc)

    def cut(pieces: Column) -> Column:
        kept = F.aggregate(pieces, start, step, lambda acc: acc["kept"])
        return F.array_join(F.slice(pieces, 1, kept), "")

    pieces = F.split(after_opening, rf"(?i)(?=</?{tag}(?![\w-]))", -1)
    return _bind(pieces, cut)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once although ``use`` mentions it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def containers(html: Column, rule: BodyRule) -> Column:
    """Inner HTML of the first container of a rule (of all of them with ``every``), as an array."""
    tails = F.split(html, rule.opening, -1 if rule.every else 2)
    return _bind(tails, lambda t: F.transform(F.slice(t, 2, F.size(t)), lambda tail: _inside(tail, rule.tag)))


def body_by_rule(html: Column, rule: BodyRule) -> Column:
    """Body text by one rule; null when the page has no such container."""

    def text(container: Column) -> Column:
        if not rule.paragraphs:
            return visible_text(container, rule.spaced)
        paragraphs = F.regexp_extract_all(container, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1))
        return F.array_join(F.transform(paragraphs, lambda p: visible_text(p)), " ")

    texts = F.transform(containers(html, rule), text)
    joined = F.nullif(F.array_join(texts, " "), F.lit("")) if rule.every else F.get(texts, F.lit(0))
    return collapse_space(strip_editor_markers(joined))


def extract_body(html: Column, rules: Sequence[BodyRule]) -> Column:
    """Body text by the first rule whose container is on the page."""
    return F.coalesce(*[body_by_rule(html, rule) for rule in rules])


def article_bodies(pages: DataFrame, html: str, rules: dict[int, Sequence[BodyRule]], publisher: Column, output: str = "section") -> DataFrame:
    """Adds the body text by the rules of each page's publisher; null where none fits."""
    body = None
    for index, chain in rules.items():
        text = extract_body(F.col(html), chain)
        body = F.when(publisher == index, text) if body is None else body.when(publisher == index, text)
    return pages.withColumn(output, body)


def with_body(articles: DataFrame, body: str = "section") -> DataFrame:
    """Articles that have a body."""
    return articles.where(F.col(body).isNotNull() & (F.col(body) != ""))


def items(pages: DataFrame, keys: Sequence[str], html: str, item: str, fields: dict[str, str]) -> DataFrame:
    """One row per item of a list page.

    ``item`` matches one item; each field pattern has one group and gives the **last** match inside
    the item, null when there is none.
    """
    found = F.regexp_extract_all(F.col(html), F.lit(item), F.lit(0))
    rows = numbered_elements(pages, keys, found, "_item", "position")
    picked = {
        name: unescape(F.try_element_at(F.regexp_extract_all("_item", F.lit(pattern), F.lit(1)), F.lit(-1)))
        for name, pattern in fields.items()
    }
    return rows.withColumns(picked).drop("_item")


# Marks of a news search page's results and of their fields.
NEWS_LIST = BodyRule("ul", "class", "list_news")
NEWS_ITEM = r"(?is)<li(?![\w-])[^>]*(?<![\w-])id\s*=\s*[\"']sp_nws[^\"']*[\"'][^>]*>"
NEWS_AREA = BodyRule("div", "class", "news_area")
NEWS_GROUP = BodyRule("div", "class", "info_group")
NEWS_FIELDS = {
    "date": ("group", r"(?is)<span(?![\w-])[^>]*(?<![\w-])class\s*=\s*[\"']info[\"'][^>]*>([^<]*)</span>"),
    "url": ("area", r"(?is)<a(?![\w-])(?=[^>]*(?<![\w-])class\s*=\s*[\"']news_tit[\"'])[^>]*(?<![\w-])href\s*=\s*[\"']([^\"']*)[\"']"),
    "press": ("group", r"(?is)<a(?![\w-])[^>]*(?<![\w-])class\s*=\s*[\"']info press[\"'][^>]*>(?:<span\b.*?</span>)?([^<]*)"),
    "title": ("area", r"(?is)<a(?![\w-])(?=[^>]*(?<![\w-])class\s*=\s*[\"']news_tit[\"'])[^>]*(?<![\w-])title\s*=\s*\"([^\"]*)\""),
}


def news_items(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Date, address, press and title of every result on stored news search pages.

    Results lie in the result list, a result ends where its own list item does, and each field comes
    from its block inside the result, where the last match counts. A missing field is null.
    """

    def results(listed: Column) -> Column:
        tails = F.split(listed, NEWS_ITEM, -1)
        return _bind(tails, lambda t: F.transform(F.slice(t, 2, F.size(t)), lambda tail: _inside(tail, "li")))

    found = _bind(F.get(containers(F.col(html), NEWS_LIST), F.lit(0)), results)
    rows = numbered_elements(pages, keys, found, "_item", "position")
    area = rows.withColumn("_area", F.get(containers(F.col("_item"), NEWS_AREA), F.lit(0)))
    blocks = area.withColumn("_group", F.get(containers(F.col("_area"), NEWS_GROUP), F.lit(0)))
    picked = {
        name: unescape(F.try_element_at(F.regexp_extract_all(f"_{block}", F.lit(pattern), F.lit(1)), F.lit(-1)))
        for name, (block, pattern) in NEWS_FIELDS.items()
    }
    return blocks.withColumns(picked).drop("_item", "_area", "_group")


def pages_by_url(pages: DataFrame, key: str, url: str, page: str = "page") -> DataFrame:
    """``url`` and its newest ``page`` by key: one row per address however often it is stored."""
    return pages.where(F.col(url).isNotNull()).groupBy(url).agg(F.max(key).alias(page))


def with_page(rows: DataFrame, row_key: str, address: str, pages: DataFrame, output: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``rows`` with the HTML behind their ``address``, null if it is not stored.

    Many rows may name one address: only keys go through the first salted join, and the HTML moves once, from
    its page to the rows that name it. ``row_key`` tells the rows apart.
    """
    targets = pages_by_url(pages, key, url, "_page").withColumnRenamed(url, "_address")
    wanted = rows.select(F.col(row_key).alias("_row"), F.col(address).alias("_address")).where("_address is not null")
    found = salted_join(wanted, targets, "_address", "inner", spread=["_row"]).select("_row", "_page")
    stored = pages.select(F.col(key).alias("_page"), F.col(html).alias(output))
    named = rows.join(found.withColumnRenamed("_row", row_key), row_key, "left")
    of_page = found.groupBy("_page").agg(F.count("*").alias("n"))
    return salted_join(named, stored, "_page", "left", [row_key], of_page).select(*[c for c in named.columns if c != "_page"], output)


def follow_links(rows: DataFrame, pages: DataFrame, row_key: str, html_of_row: str, key: str = "page_id", url: str = "url", html: str = "html", rel: str = "amphtml") -> DataFrame:
    """``rows`` with ``alternate_url``, where their HTML's ``<link rel=...>`` points, and ``alternate_html``."""
    tag = F.regexp_extract(F.col(html_of_row), rf"(?is)<link(?![\w-])(?=[^>]*(?<![\w-])rel=[\"']{rel}[\"'])[^>]*>", 0)
    link = F.regexp_extract(tag, r"(?is)(?<![\w-])href=[\"']([^\"']*)[\"']", 1)
    linked = materialise(rows.withColumn("alternate_url", F.nullif(unescape(link), F.lit(""))))
    return with_page(linked, row_key, "alternate_url", pages, "alternate_html", key, url, html)


def follow_alternate(pages: DataFrame, rel: str = "amphtml", key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with the HTML of the page their ``<link rel=...>`` points to, null if it is not stored.

    ``key`` is unique. Of an address that is stored several times the newest page counts.
    """
    return follow_links(pages, pages, key, html, key, url, html, rel)
