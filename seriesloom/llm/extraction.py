"""Main text of web pages by equivalence classes of tokens across the pages of a host.

Tokens are elements, by their path, and texts, by path and content. Two tokens of a host are equivalent
when they occur equally often on each of its pages. The occurrence vectors are never gathered: a
vector's fingerprint is the sum of one hash per page and count, which adds up in any order. Classes
that are frequent and whose outermost members sit under one other class are valid, and nest into the
host's template; whatever elements a text lies in, it is template by its vector alone. Text that belongs to the template is left out; what remains are its slots, of which those of
the article are returned.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import BROADCAST_BYTES, batches, ship, stored
from seriesloom.llm.htmlparse import Reader, number

ship(__name__)

#: Fewer pages do not show what is template and what is text.
LEAST_PAGES = 10
ENTRIES = 200_000
BATCH_BYTES = 1 << 22
MASK = (1 << 61) - 1
ELEMENT, TEXT, PAGE = range(3)


def host_of(url: Column) -> Column:
    """Host of an address in small letters; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)), F.lit(""))


def _page_tokens(html: str, reader: Reader) -> dict[tuple[int, int], list[int]]:
    """(kind, token) to [count, path above]; one PAGE token for the page's text as a whole."""
    elements, texts, _ = reader.read(html)
    tokens: dict[tuple[int, int], list[int]] = {}
    for path, parent in elements:
        tokens.setdefault((ELEMENT, path), [0, parent])[0] += 1
    everything = []
    for _, path, _, _, _, text in texts:
        words = text.split()
        if words:
            everything += words
            tokens.setdefault((TEXT, number(path, *words)), [0, path])[0] += 1
    tokens[PAGE, number(*everything)] = [1, 0]
    return tokens


def token_counts(pages: DataFrame) -> DataFrame:
    """Per host, kind and token: pages, occurrences, fingerprint of the occurrence vector.

    Each task sums its own pages and passes every token on, so the shuffle is dealt by host and token.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        held: dict[tuple, list[int]] = {}

        def flush() -> pa.RecordBatch:
            rows = []
            for (host, kind, token), v in held.items():
                rows.append((host, kind, token, v[3], v[0], v[1], v[2]))
            held.clear()
            kinds = (pa.string(), pa.int32(), *[pa.int64()] * 5)
            names = ["host", "kind", "token", "above", "pages", "total", "vector"]
            columns = zip(*rows) if rows else [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in tables:
            table = pa.table(batch.columns, names=["key", "host", "html"])
            for a, b in batches(table, BATCH_BYTES, "html"):
                some = table.slice(a, b - a)
                for key, host, html in zip(*(some.column(c).to_pylist() for c in ("key", "host", "html"))):
                    for (kind, token), (count, above) in _page_tokens(html or "", reader).items():
                        v = held.setdefault((host, kind, token), [0, 0, 0, above])
                        v[0] += 1
                        v[1] += count
                        v[2] = (v[2] + number(key, count)) & MASK
                    if len(held) > ENTRIES:
                        yield flush()
        if held:
            yield flush()

    schema = "host string, kind int, token long, above long, pages long, total long, vector long"
    counted = pages.select("key", "host", "html").mapInArrow(run, schema)
    vector = F.sum(F.col("vector").cast("decimal(20,0)")) % F.lit(MASK + 1).cast("decimal(20,0)")
    return counted.groupBy("host", "kind", "token", "above").agg(
        F.sum("pages").alias("pages"), F.sum("total").alias("total"), vector.cast("long").alias("vector")
    )


def fixed_texts(tokens: pd.DataFrame) -> list[int]:
    """Text tokens in the valid classes of one host's frequent tokens.

    A class has several members, and those of them with no member of the class around them lie in one
    and the same class.
    """
    classes = list(zip(tokens["pages"], tokens["total"], tokens["vector"]))
    elements = {t: (above, c) for kind, t, above, c in zip(tokens["kind"], tokens["token"], tokens["above"], classes) if kind == ELEMENT}
    members, places = Counter(classes), defaultdict(set)
    for above, c in zip(tokens["above"], classes):
        outer, around = elements.get(above, (0, None))[1], above
        while around in elements and elements[around][1] != c:
            around = elements[around][0]
        if around not in elements:
            places[c].add(outer)
    return [int(t) for kind, t, c in zip(tokens["kind"], tokens["token"], classes) if kind == TEXT and members[c] > 1 and len(places[c]) <= 1]


def host_templates(counted: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host`` and ``fixed``, the text tokens of its template.

    A class is a set of tokens of equal vectors; it is frequent when it is on at least half of the
    host's pages, ``least_pages`` at least, without counting copies of a page. Texts in valid classes
    are template, if half of the host's pages differ: on copies of one page everything is constant. A
    host's frequent tokens are at most twice what one of its pages holds, however many pages it has.
    """
    tokens = counted.where((F.col("kind") <= TEXT) & (F.col("pages") * 2 >= least_pages))
    hosts = counted.where(F.col("kind") == PAGE).groupBy("host").agg(F.sum("pages").alias("host_pages"), F.count("*").alias("texts"))
    hosts = hosts.where((F.col("host_pages") >= least_pages) & (F.col("texts") * 2 >= F.col("host_pages")))
    # All copies may be of one page, so that many pages say nothing of what is on different ones.
    differing = F.col("pages") - (F.col("host_pages") - F.col("texts"))
    member = tokens.join(hosts, "host").where((F.col("pages") * 2 >= F.col("host_pages")) & (differing * 2 >= F.col("texts")))

    def run(found: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [found["host"].iloc[0]], "fixed": [fixed_texts(found)]})

    member = member.select("host", "kind", "token", "above", "pages", "total", "vector")
    return member.groupBy("host").applyInPandas(run, "host string, fixed array<long>")


def _below(held: list[tuple[int, int]], nodes: list[tuple[int, int, str]]) -> list[int]:
    """Words in every node by those ``held`` as (node, words), those within it included; the first holds the page."""
    below = [0] * len(nodes)
    for node, words in held:
        below[node] += words
    for node in range(len(nodes) - 1, 0, -1):
        below[nodes[node][0]] += below[node]
    return below


def _around(node: int, nodes: list[tuple[int, int, str]]) -> set[int]:
    """The node and all nodes it lies in."""
    found = set()
    while node:
        found.add(node)
        node = nodes[node][0]
    return found


def _beside(held: list[tuple[int, int]], nodes: list[tuple[int, int, str]]) -> list[bool]:
    """Which nodes their cues put beside the article.

    Talk (comments, notices) is beside it however much it is, unless it holds most words and the page's first
    headline (or ``main``, without one); other cues where a node holds at most half of the words that then remain.
    """
    below = _below(held, nodes)
    titles = [[n for n in range(1, len(nodes)) if nodes[n][2] == tag and below[n]] for tag in ("h1", "main")]
    around_title = _around(next((t[0] for t in titles if t), 0), nodes)
    off = [False] * len(nodes)
    for least in (2, 1):
        for node in range(1, len(nodes)):
            around, cue, _ = nodes[node]
            most = below[node] * 2 > below[0] and (cue < 2 or node in around_title)
            off[node] = off[node] or off[around] or (cue >= least and not most)
        below = _below([h for h in held if not off[h[0]]], nodes)
    return off


def page_text(html: str, fixed: set[int], reader: Reader) -> str:
    """Blocks of the article's slots, joined by an empty line.

    Template text is no slot, nor is what lies in menus, page headers, footers, sidebars or controls by
    their element's name. An element that by class, id or role is one of these, a notice, an advert or
    comments, or is a form, is none either unless it is what lies around the article. The article is what remains in
    ``article`` or ``main`` elements; without any, all that remains. Time grows with the page's length.
    """
    _, texts, nodes = reader.read(html)
    kept, held = [], []
    for t in texts:
        words = () if t[3] else t[5].split()
        if not t[3] and not (fixed and words and number(t[1], *words) in fixed):
            kept.append(t)
            if words:
                held.append((t[2], len(words)))
    # Without a cue on the page nothing lies beside the article.
    off = _beside(held, nodes) if any(n[1] for n in nodes) else [False] * len(nodes)
    texts = [t for t in kept if not off[t[2]]]
    if any(t[4] and not t[5].isspace() for t in texts):
        texts = [t for t in texts if t[4]]
    blocks: dict[int, list[str]] = {}
    for block, _, _, _, _, text in texts:
        blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(b for b in joined if b)


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_pages: int = LEAST_PAGES) -> DataFrame:
    """``key``, ``url`` and the main ``text`` of every row.

    Null and empty html give an empty text; a null or odd url counts as a host without a name.
    Repeated rows are pages like any other and give equal rows; keys need not be unique or non-null.
    Other columns are left out; an empty table gives no rows. Pages are not gathered by host: each is
    read where it lies, beside its host's template, which is a few numbers.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    counted = token_counts(rows)
    # Rare texts, which are nearly all, are in no template.
    counted = stored(counted.where((F.col("kind") != TEXT) | (F.col("pages") * 2 >= least_pages)), "tokens")
    templates = stored(host_templates(counted, least_pages), "templates")
    size = templates.agg(F.sum(F.length("host") + F.size("fixed") * 8 + 64)).first()[0] or 0
    joined = rows.join(F.broadcast(templates) if size <= BROADCAST_BYTES else templates, "host", "left")

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in tables:
            table = pa.table(batch.columns, names=["key", "url", "html", "fixed"])
            for a, b in batches(table, BATCH_BYTES, "html"):
                some = table.slice(a, b - a)
                texts = [
                    page_text(h or "", set(f or ()), reader)
                    for h, f in zip(*(some.column(c).to_pylist() for c in ("html", "fixed")))
                ]
                yield pa.RecordBatch.from_arrays([some.column("key").combine_chunks(), some.column("url").combine_chunks(), pa.array(texts, pa.string())], names=[key, url, "text"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]
    return joined.select("key", "url", "html", "fixed").mapInArrow(run, f"`{key}` {kinds[0]}, `{url}` {kinds[1]}, text string")
