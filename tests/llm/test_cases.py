"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import os
import random
import sys
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from helpers import DOCS, documents, near_links, roots, shingle_sets  # noqa: E402

from seriesloom.llm import licenses, minhash, neighbours, vector_dedup  # noqa: E402
from seriesloom.llm.common import batches  # noqa: E402
from seriesloom.llm.components import connected_components, spanning  # noqa: E402
from seriesloom.llm.cotraining import fit_views, score_quality  # noqa: E402
from seriesloom.llm.extraction import host_templates, main_texts, page_text, token_counts  # noqa: E402
from seriesloom.llm.htmlparse import Reader  # noqa: E402
from seriesloom.llm.licenses import TEMPLATES, license_scan  # noqa: E402
from seriesloom.llm.minhash import DISTANCE, near_duplicates, near_homes, one_of_each, shingle_set, signature, with_distance  # noqa: E402
from seriesloom.llm.mixing import mixed_rows, systematic_copies, word_count  # noqa: E402
from seriesloom.llm.neighbours import nearest_neighbours  # noqa: E402
from seriesloom.llm.packing import WordIds, fill_bins, pack, packed_documents, tokenised_pieces  # noqa: E402
from seriesloom.llm.pii import anchors, find_spans, joined, personal_data, redact, redacted_rows  # noqa: E402
from seriesloom.llm.queries import tokenizer_path  # noqa: E402
from seriesloom.llm.sharding import jump, shard_rows  # noqa: E402
from seriesloom.llm.vector_dedup import near_duplicate_vectors  # noqa: E402
from seriesloom.llm.words import text_words  # noqa: E402

CLASH = ("key", "row", "h1", "signature", "bucket", "size", "shard", "slot", "copies", "doc", "example", "group", "offset", "score", "kept", "host", "spans")
LONG = " ".join(f"w{i * 7919 % 100_003}" for i in range(200_000))


def pick(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank and very long texts, a repeated row, a null id, a null source; clashing columns."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "a b c"), (5, "a b c"), (None, "d e f"), (6, "g h", None)]
    return documents(spark, rows, CLASH)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# Licences


def test_license_cases(spark, odd, nothing):
    assert license_scan(nothing, "doc_id", "text").count() == 0
    assert license_scan(odd, "doc_id", "text").count() == 0
    assert license_scan(documents(spark, [(1, "x")]), "doc_id", "text", templates=[]).count() == 0
    mit = next(t for n, t in TEMPLATES if n == "MIT" and "\n\n" in t)
    rows = [(1, "one two\nReleased under the MIT license!\nthree"), (2, mit.upper()), (3, f"words\n\n{mit}\n\nmore words"), (4, LONG + "\nLicensed under CC BY-NC 4.0.")]
    rows += [(1, rows[0][1]), (None, "Released under the MIT License."), (7, "Released by the MIT press."), (8, "x\n\n \nLicensed under CC BY-NC 4.0")]
    got = license_scan(documents(spark, rows, CLASH), "doc_id", "text").collect()
    assert pick(got, "doc_id", "license", "dice", "first_line", "n_places") == sorted(
        [(1, "MIT", 1.0, 1, 1)] * 2 + [(2, "MIT", 1.0, 0, 3), (3, "MIT", 1.0, 2, 4), (4, "CC-BY-NC-4.0", 1.0, 1, 1), (None, "MIT", 1.0, 0, 1), (8, "CC-BY-NC-4.0", 1.0, 3, 2)], key=repr
    )


def test_license_notices_within_paragraphs(spark):
    rows = [(1, "Words first.\nAll rights reserved.\nmore"), (2, "We like words here. Released under the MIT License. And some more words follow."), (3, "A first sentence that is\nlong. Released under the\nMIT License. The end of\nthe text")]
    rows += [(4, "It has all rights. Reserved seats are here."), (5, "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.")]
    got = license_scan(documents(spark, rows), "doc_id", "text").collect()
    assert pick(got, "doc_id", "license", "first_line", "n_places") == [(1, "all-rights-reserved", 1, 1), (2, "MIT", 0, 1), (3, "MIT", 1, 1), (5, "BSD-3-Clause", 0, 1)]


def test_license_sentences_equal_all_runs():
    """Against every run of sentences, on texts with repeats."""
    rng = random.Random(4)
    phrases = ["All rights reserved.", "ok go.", "Released under the MIT License.", "Released under", "the MIT License!", "and more words of no use?", "(c)", "\n"]
    ready = licenses.prepared(licenses.TEMPLATES)
    for _ in range(150):
        raw = " ".join(rng.choice(phrases) for _ in range(rng.randint(1, 25))).replace("\n \n", "\n").encode()
        plain = raw.translate(licenses.PLAIN)
        for part in licenses.paragraphs(plain):
            cuts = [part[1], *(m.end() for m in licenses.STOP.finditer(raw, part[1], part[2])), part[2]]
            for size, _, template in ready[:12]:
                every: dict = {}
                for i, a in enumerate(cuts[:-1]):
                    for b in cuts[i + 1 :]:
                        have = licenses.pairs(plain[a:b])
                        shared = len(have & template)
                        if 2 * shared >= licenses.THRESHOLD * (len(have) + size) - 1e-9:
                            at = b - len(raw[a:b].lstrip())
                            every.setdefault((at, frozenset(have)), (2 * shared / (len(have) + size), part[0] + plain.count(b"\n", part[1], at), at, b))
                got = list(licenses.sentence_runs(raw, plain, part, template, licenses.THRESHOLD))
                assert set(every.values()) <= set(got) and all(g in every.values() or any(g[:3] == e[:3] for e in every.values()) for g in got)


def test_license_time_grows_with_the_text():
    ready = licenses.prepared(licenses.TEMPLATES)
    sizes = [u[0] for u in ready]
    started = time.time()
    for text in ("All rights reserved. " + "ok go. " * 150_000, "All rights reserved. " * 50_000, "ok go.\n" * 150_000 + "All rights reserved."):
        assert "all-rights-reserved" in licenses.scan_text(text, ready, sizes, licenses.THRESHOLD)
    assert time.time() - started < 60


def test_page_beside_the_article_however_long():
    """Comments and notices longer than the article go; wrappers with such words in their names stay."""
    talk = "".join(f"<p>reader number {i} says a lot about this</p>" for i in range(30))
    cases = [
        f"<h1>Rain stops</h1><p>It is dry now.</p><div class=comments>{talk}</div>",
        f"<article><h1>Rain stops</h1><p>It is dry now.</p><section id='comment-list'>{talk}</section></article>",
        f"<div class='cookie-notice'>{talk}</div><main><h1>Rain stops</h1><p>It is dry now.</p></main>",
        f"<div class='layout with-sidebar'><h1>Rain stops</h1><p>It is dry now.</p></div><div id=disqus_thread>{talk}</div>",
        f"<div id='page-no-comments'><h1>Rain stops</h1><p>It is dry now.</p><div class='reader-replies'>{talk}</div></div>",
        f"<form action=x><h1>Rain stops</h1><p>It is dry now.</p><div class='newsletter'>{talk}</div></form>",
    ]
    for html in cases:
        assert page_text(f"<html><body>{html}</body></html>", set(), Reader()) == "Rain stops\n\nIt is dry now.", html


def test_page_reader_time_grows_with_the_page():
    started = time.time()
    for html in ("<b>x" * 100_000 + "</i>" * 250_000, "<div>" * 100_000 + "</span></p>" * 100_000, "<b>" * 150_000 + "<p>x" * 100_000):
        page_text(html, set(), Reader())
    assert time.time() - started < 60


def test_license_near_miss(spark):
    near = "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with this License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    assert [r.license for r in license_scan(documents(spark, [(1, near)]), "doc_id", "text").collect()] == ["Apache-2.0"]
    assert license_scan(documents(spark, [(1, near)]), "doc_id", "text", threshold=0.999).count() == 0


# Sharding


def test_shard_cases(spark, odd, nothing):
    assert shard_rows(nothing, "doc_id", 4, ["doc_id"]).count() == 0
    got = shard_rows(odd, "doc_id", 3, ["doc_id", "text"]).collect()
    assert len(got) == 8
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    one = shard_rows(odd, "doc_id", 1, ["doc_id"]).collect()
    assert {r.shard for r in one} == {0} and sorted(r.slot for r in one) == list(range(8))
    with pytest.raises(ValueError):
        shard_rows(odd, "doc_id", 0, ["doc_id"])


def test_growing_moves_rows_into_the_new_shard_only(spark):
    keys = spark.range(-3000, 3000).select(F.xxhash64("id").alias("k"))
    got = keys.select("k", jump(F.col("k"), 7).alias("p"), jump(F.col("k"), 8).alias("q")).collect()
    assert all(r.p.grown == r.q.shard for r in got)
    moved = [r for r in got if r.p.shard != r.q.shard]
    assert all(r.q.shard == 7 for r in moved) and 0.09 < len(moved) / len(got) < 0.16
    sizes = np.bincount([r.p.shard for r in got])
    assert sizes.min() > 0.85 * sizes.mean() and sizes.max() < 1.15 * sizes.mean()


# Personal data


def test_pii_cases(spark, odd, nothing):
    assert personal_data(nothing, "doc_id", "text").count() == 0
    got = personal_data(odd, "doc_id", "text").collect()
    assert len(got) == 8 and {r.spans for r in got} == {""}
    assert pick(got, "doc_id", "cleaned")[0][1] is None or any(r.cleaned is None for r in got)
    clean = redacted_rows(odd, "text", "n_chars")
    assert clean.columns == odd.columns and pick(clean.collect(), "doc_id", "text", "n_chars") == pick(odd.collect(), "doc_id", "text", "n_chars")
    mail = redacted_rows(documents(spark, [(1, LONG + " a@b.cc x"), (2, "é +1 (377) 555-0271")]), "text", "n_chars").collect()
    assert pick(mail, "doc_id", "text", "n_chars") == [(1, LONG + " [EMAIL] x", len(LONG) + 10), (2, "é [PHONE]", 9)]


def test_added_kinds():
    found = anchors()

    def spans(text):
        return joined(find_spans(text, found))

    assert spans('x token = "04dbebab91ab85687d33eeaaf9ac" y') == "secret:11:39"
    assert spans("IBAN: GB82 WEST 1234 5698 7654 32 and") == "iban:6:33"
    assert spans("IBAN: GB83 WEST 1234 5698 7654 32 and") == ""
    assert spans("at 12 Old Mill Road, no 12 old mill road") == "address:3:19"
    assert spans("https://bob:pw1@host.example.com/x") == "login:0:32,email:12:32"
    assert spans("see https://host.example.com/x") == ""
    assert spans("Account no: 123456789012.") == "account:12:24"
    assert spans("accountant 123456789012, my tokens are: many") == ""
    both = "https://bob:pw1@host.example.com/x 1.2.3.4"
    assert redact(both, find_spans(both, found)) == "[LOGIN]/x [IP]"


def test_base_kinds_like_regular_expressions():
    from test_llm_queries import base_spans

    found, rng = anchors(), random.Random(5)
    for _ in range(20_000):
        letters = rng.choice(["a@b.c-+1 ", "12.3 +-()", "@.a1", "0.1+9 -@a", "1234567890 -+.(", "+1 .()-@é٣"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
        assert [s for s in joined(find_spans(text, found)).split(",") if s and s.split(":")[0] in ("email", "ip", "card", "phone")] == base_spans(text), text


def test_hostile_texts_take_linear_time():
    import time

    found = anchors()
    started = time.time()
    assert joined(find_spans("0" * 5000 + "1.1.1.1", found)) == "ip:0:5007"
    assert joined(find_spans("256." + "0" * 1_000_000 + ".1.1", found)) == ""
    assert len(find_spans("token=" * 170_000, found)) == 1
    for piece in ("account ", "a@", "1.2.", "+1 ", "x://y:", "IBAN GB", "12 Old Street"):
        find_spans(piece * (1_000_000 // len(piece)), found)
    assert time.time() - started < 40


# Quality


def test_quality_cases(spark, odd, nothing):
    labels = "doc_id long, quality int"
    few = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (6, None)], labels)
    none = spark.createDataFrame([], labels)
    for docs, known, share in ((odd, few, 1.0), (odd, none, None), (nothing, none, None), (nothing, few, None)):
        got = score_quality(docs, fit_views(docs, known)).collect()
        assert len(got) == docs.count() and all(r.kept and r.score == share for r in got)


def test_quality_scores_every_row(spark):
    good = [(i, " ".join(f"word{(i * 31 + j) % 97}" for j in range(40)), f"s{i % 3}") for i in range(120)]
    bad = [(1000 + i, "BUY!! NOW!! " * (5 + i % 7), f"s{i % 3}") for i in range(80)]
    more = [(1, None), (2, ""), (1, good[1][1])]
    docs = documents(spark, good + bad + more, CLASH)
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in (good + bad)[::2]], "doc_id long, quality int")
    got = score_quality(docs, fit_views(docs, labels, rounds=1))
    assert got.select("row.*").columns == docs.columns
    rows = got.select("row.doc_id", "row.text", "kept", "score").collect()
    assert len(rows) == 203
    assert all(r.kept == (r.doc_id < 1000) for r in rows if r.text)
    assert all(0 <= r.score <= 1 for r in rows)


# Pages


def page(body):
    return f"<html><head><title>t</title></head><body><nav><a href='/'>home</a></nav>{body}<footer>f</footer></body></html>"


def test_extraction_cases(spark):
    schema = "page_id long, url string, html string, host string, main int"
    rows = [
        (1, "http://a.example/1", page("<article><h1>A &amp; B</h1><p>one<br>two <b>th</b>ree<p>four&nbsp;five</article>")),
        (2, None, None), (3, "http://a.example/2", ""), (4, "::odd", "plain  text &lt;b&gt;"),
        (5, "http://b.example/", page("<div class='sidebar'>side bar words here</div><div id=c><p>first par one</p><p>second par two</p></div>")),
        (6, "x", page("<article><p>kept</p><section class='comments'><p>a comment</p></section><form><label>f</label></form><script>var a='<p>';</script></article>")),
        (None, "y", "<article><p>cut off in a ta"), (8, "z", "<article>" + "<p>w " * 30_000),
        (9, "w", "<article><p>a < b</p><div class=\"ad\"><p>x</div><ul><li>i1<li>i2</ul><table><tr><td>c1<td>c2</table><p>end</article>after"),
    ]
    rows += [rows[0]]
    got = main_texts(spark.createDataFrame([(*r, "h", 1) for r in rows], schema).repartition(2)).collect()
    want = {
        1: "A & B\n\none two three\n\nfour five", 2: "", 3: "", 4: "plain text <b>", 5: "first par one\n\nsecond par two", 6: "kept",
        None: "cut off in a ta", 8: "\n\n".join(["w"] * 30_000), 9: "a < b\n\ni1\n\ni2\n\nc1\n\nc2\n\nend",
    }
    assert len(got) == len(rows) and all(r.text == want[r.page_id] for r in got)
    assert main_texts(spark.createDataFrame([], schema)).count() == 0


def test_template_text_is_left_out(spark):
    def story(i):
        return f"<article><h1>Title {i}</h1><div class='stamp'>Daily Paper</div><p>story {i} begins</p>" + "<p>more</p>" * (1 + i % 3) + "</article>"

    rows = [(i, "http://p.example/x", page(story(i))) for i in range(30)] + [(100 + i, "http://few.example/", page(story(i))) for i in range(3)]
    rows += [(200 + i, "http://copies.example/", page(story(7))) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    for i in range(30):
        assert got[i] == f"Title {i}\n\nstory {i} begins" + "\n\nmore" * (1 + i % 3)
    assert all("Daily Paper" in got[i] for i in (100, 101, 102, 200, 219))  # too few pages, and copies of one page
    counted = token_counts(pages.selectExpr("page_id AS key", "'h' AS host", "html").where("key < 100"))
    assert len(host_templates(counted).first()["fixed"]) >= 1


def test_template_text_beside_siblings_of_its_path(spark):
    def story(i):
        promo = "<p>Join the club.</p><p>It is free.</p>" if i % 3 else ""
        bar = "<ul><li><a>Share</a></li><li><a>Print</a></li></ul>"
        return f"<article>{bar}<p>Daily Paper</p><p>story {i} begins</p>" + f"<p>more {i}</p>" * (i % 4) + f"{promo}<p>{'odd' if i % 2 else 'even'} end</p></article>"

    rows = [(i, "http://p.example/x", page(story(i))) for i in range(30)]
    # Half of a host's pages are copies: what only they hold is no template.
    rows += [(100 + i, "http://half.example/", page(f"<article><p>first {max(i, 14)}</p><p>last {max(i, 14)}</p></article>")) for i in range(28)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    for i in range(30):
        assert got[i] == f"story {i} begins" + f"\n\nmore {i}" * (i % 4) + f"\n\n{'odd' if i % 2 else 'even'} end"
    assert all(got[100 + i] == f"first {max(i, 14)}\n\nlast {max(i, 14)}" for i in range(28))


def test_extraction_keeps_all_of_the_article(spark):
    lists = "<p>p one</p><ul><li>item one<li>item two</ul><blockquote><p>quoted words</p></blockquote><table><tr><td>c1<td>c2</table><section><p>nested words</p></section>"
    want = "p one\n\nitem one\n\nitem two\n\nquoted words\n\nc1\n\nc2\n\nnested words"
    side = "<div class='sidebar'><p>side words</p></div>"
    rows = [
        (1, page(f"<div id=c>{lists}</div>{side}")),
        (2, page(f"<div class='layout with-sidebar'><div>{lists}</div>{side}</div>")),
        (3, page(f"<div id='page-no-comments'><article>{lists}</article></div>")),
        (4, page(f"<form action='/'><div>{lists}</div>{side}</form>")),
        (5, page(f"<article class=x><div class='share-box'>{lists}</div><div class='related'><p>other story</p></div></article>")),
    ]
    rows += [(10 + i, page(f"<div class=a><p>story {i}</p></div>" + (f"<div class=b><p>{i} has many more words than all the others</p></div>" if i % 2 else ""))) for i in range(30)]
    pages = spark.createDataFrame([(i, f"http://{'h' if i > 9 else i}.example/", h) for i, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_texts(pages).collect()}
    assert [got[i] for i in range(1, 6)] == [want] * 5
    assert all(got[10 + i] == f"story {i}" + (f"\n\n{i} has many more words than all the others" if i % 2 else "") for i in range(30))


# Near duplicates


def test_dedup_cases(spark, odd, nothing):
    assert near_duplicates(nothing, "doc_id", "text").count() == 0
    got = near_duplicates(odd, "doc_id", "text", width=2).collect()
    assert pick(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, len(shingle_sets([(4, LONG)], 2)[4]), 4, True), (5, 2, 5, True), (5, 2, 5, True), (6, 1, 6, True)], key=repr
    )
    stay = one_of_each(odd, "doc_id", "text")
    assert stay.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stay.collect()) == [(False, i) for i in range(1, 7)] + [(True, 0)]


def test_one_of_each_decides_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (7, a + " more"), (7, b), (7, b + " more")] + [(9, f"{i} " + " ".join(f"u{i}v{j}" for j in range(20))) for i in range(30)]
    rows += [(None, c), (None, c + " more"), (None, a), (None, None), (9, None), (9, None)]
    stay = [(r.doc_id, r.text) for r in one_of_each(documents(spark, rows, CLASH), "doc_id", "text").collect()]
    assert (3, a) in stay and not {(7, a + " more"), (None, a)} & set(stay)
    assert len({(7, b), (7, b + " more")} & set(stay)) == 1 and len({(None, c), (None, c + " more")} & set(stay)) == 1
    assert sum(k == 9 for k, _ in stay) == 32 and len(stay) == 1 + 1 + 32 + 2


def edited(rng, words, share):
    return [f"new{rng.randint(0, 10**6)}" if rng.random() < share else w for w in words]


def test_dedup_like_brute_force(spark):
    rng = random.Random(11)
    rows, key = [], 0
    for group in range(60):
        base = [f"v{rng.randint(0, 900)}" for _ in range(rng.choice([3, 5, 8, 30, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((key, " ".join(edited(rng, base, rng.choice([0, 0.02, 0.05, 0.1])))))
            key += 1
    hub = [f"h{i}" for i in range(150)]
    for i in range(150):  # one large group of near copies, some of them drifting apart
        rows.append((key + i, " ".join(edited(rng, hub, rng.choice([0.01, 0.03, 0.06])))))
    rows += [(5000 + i, "The same text of some words for all") for i in range(40)]
    for width in (2, 5):
        sets = shingle_sets(rows, width)
        component = roots(sets, near_links(sets))
        got = near_duplicates(documents(spark, rows), "doc_id", "text", width=width).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {k: (len(s), component[k]) for k, s in sets.items()}


def test_pairs_are_judged_where_they_meet(spark):
    """Pairs carry signatures, parts and sizes, so that none of them is joined with its classes again."""
    one, other = bytes(64), bytes(40) + b"x" * 24
    pairs = spark.createDataFrame([(1, 2, 29, 10, 10, one, other), (1, 3, 9, 10, 10, one, other), (1, 4, 29, 10, 2, one, one)], "a long, b long, most long, na long, nb long, sa binary, sb binary")
    assert [tuple(r) for r in with_distance(pairs, 80, 100).collect()] == [(1, 2, 24)]
    met = spark.createDataFrame([(7, 2, 2, 2, 29, 10, other), (7, 4, 5, 5, 29, 10, one)], "bucket long, cid long, p long, q long, most long, n long, signature binary")
    asking = spark.createDataFrame([(7, 1, 5, 11, one), (8, 9, 9, 11, one)], "bucket long, cid long, part long, n long, signature binary")
    assert [r.asDict() for r in near_homes(met, asking, 64, 100).collect()] == [{"a": 1, "b": 2, "part": 5, "n": 11}]


def test_a_class_meets_a_home_once(spark, monkeypatch):
    sign = signature(np.arange(100, dtype=np.uint64))
    met = spark.createDataFrame([(b, 2, 5, 5, 29, 100, sign) for b in range(64)], "bucket long, cid long, p long, q long, most long, n long, signature binary")
    asking = spark.createDataFrame([(b, 1, 9, 100, sign) for b in range(64)], "bucket long, cid long, part long, n long, signature binary")
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    assert [tuple(r) for r in near_homes(met, asking, 64, 100).collect()] == [(1, 2, 9, 100)]


def test_buckets_of_the_same_classes_ask_once(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join(words[:160] + [f"{k}x{i}" for i in range(25)])) for k in (1, 2)]
    counts, real = {}, minhash.stored

    def counting(df, name):
        out = real(df, name)
        counts.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(minhash, "stored", counting)
    found = near_duplicates(documents(spark, rows), "doc_id", "text", 2).collect()
    assert pick(found, "doc_id", "component_id", "kept") == [(1, 1, True), (2, 2, True)]
    assert counts["buckets"][0] > 1 and counts["open"] == [2]


def test_signatures_differ_as_sets_do():
    rng = np.random.default_rng(4)
    apart = []
    for _ in range(1500):
        both, own = rng.integers(0, 1 << 63, 80, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 10), dtype=np.uint64)
        a, b = (np.frombuffer(signature(np.concatenate([both, o])), np.uint8) for o in own)  # similarity 0.8
        apart.append(int((a != b).sum()))
    assert abs(np.mean(apart) - 64 * 0.2) < 0.6 and abs(np.std(apart) - 3.2) < 0.5
    assert max(apart) <= DISTANCE


def test_long_texts_have_the_same_words_in_pieces():
    whole = text_words([b" ".join(b"w%d" % i for i in range(400_000))])[0]  # more than one piece
    parts = np.concatenate(text_words([b"w%d" % i for i in range(400_000)]))
    assert (whole == parts).all() and len(shingle_set(whole, 5)) == 400_000 - 4


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (3000, 3000)]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    got = connected_components(spark.createDataFrame(links + links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == roots(nodes, links_of(links))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def links_of(links):
    return [link for link in links if link[0] != link[1]]


# Vectors


def vector_table(spark, rows, extra=CLASH):
    schema = "vec_id long, embedding array<float>" + "".join(f", `{c}` int" for c in extra)
    return spark.createDataFrame([(*r, *[1] * len(extra)) for r in rows], schema).repartition(3)


ODD_VECTORS = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0]), (None, [1.0, 0.0])]


def test_vector_dedup_cases(spark):
    rows = [*ODD_VECTORS, (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, -0.0]), (12, [-3.0, 0.0])]
    got = near_duplicate_vectors(vector_table(spark, rows), "vec_id", "embedding", 0.9).collect()
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)]
    want = alone + [(7, 1, 7, True), (8, 1, 7, False), (9, 1, 9, True), (9, 1, 9, True), (11, 1, 11, True), (12, 1, 11, False)]
    assert pick(got, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)
    assert near_duplicate_vectors(vector_table(spark, []), "vec_id", "embedding").count() == 0
    with pytest.raises(ValueError):
        near_duplicate_vectors(vector_table(spark, []), "vec_id", "embedding", 0.0)


def test_vector_dedup_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "TILE", 64)
    rng = np.random.default_rng(9)
    hub = rng.normal(size=24)
    x = np.concatenate([rng.normal(size=(250, 24)), hub + 0.3 * rng.normal(size=(200, 24)), hub + 0.2 * rng.normal(size=(60, 24)), np.repeat(hub[None], 40, axis=0)]).astype(np.float32)
    x = np.concatenate([x, 2 * x[:30]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    d = x.astype(np.float64)
    unit = d / np.linalg.norm(d, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    component = roots(range(len(x)), list(zip(*map(list, np.nonzero(linked)))))
    got = near_duplicate_vectors(vector_table(spark, rows), "vec_id", "embedding", 0.9).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (int(n), component[i]) for i, n in enumerate(linked.sum(axis=1))}


def test_spanning_links_connect_the_same():
    rng = np.random.default_rng(1)
    for share in (0.001, 0.02, 0.3, 1.0):
        mask = rng.random((90, 110)) < share
        mask[:30, :40] = True
        r, c = spanning(mask)
        assert mask[r, c].all() and len(r) <= 4 * sum(mask.shape)
        nodes = range(200)
        assert roots(nodes, [(a, 90 + b) for a, b in zip(r, c)]) == roots(nodes, [(a, 90 + b) for a, b in zip(*np.nonzero(mask))])


def test_neighbour_cases(spark):
    rows = [*ODD_VECTORS, (20, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (10, [1.0, 0.0, 0.0]), (40, [0.0, 0.0]), (60, [1.0, 0.0, 1.0])]
    got = nearest_neighbours(vector_table(spark, rows), "vec_id", "embedding", lambda k: k % 20 == 0, k=2).collect()
    assert pick(got, "query_id", "rank", "id", "score") == [(20, 1, 8, 2.0), (20, 2, 9, 2.0), (60, 1, 10, 1.0)]
    assert nearest_neighbours(vector_table(spark, []), "vec_id", "embedding", lambda k: k % 20 == 0).count() == 0


def test_neighbours_of_unequal_norms_and_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.2, 3, size=(900, 1))
    x[300:600] = x[0]  # a third of all rows
    x = x.astype(np.float32)
    got = nearest_neighbours(vector_table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id", "embedding", lambda k: k % 20 == 0).collect()
    d, hits, ids = x.astype(np.float64), 0, np.arange(900)
    for q in range(0, 900, 20):
        score = (d * d[q]).sum(axis=1)
        score[q] = -np.inf
        mine = sorted((r["rank"], r.id) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        hits += len({m[1] for m in mine} & set(np.lexsort((ids, -score))[:20].tolist()))
    assert hits / (45 * 20) >= 0.9


@pytest.mark.parametrize("dim, norms", [(64, "outlier"), (64, 0.1), (64, 0.3), (64, 1.0), (128, None), (256, None)])
def test_recall_without_structure(spark, dim, norms):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[17] *= 3
    elif norms:
        x *= rng.lognormal(0, norms, (len(x), 1))
    x = x.astype(np.float32)
    got = nearest_neighbours(vector_table(spark, [(i, v.tolist()) for i, v in enumerate(x)], ()), "vec_id", "embedding", lambda k: k % 20 == 0).collect()
    d, hits = x.astype(np.float64), 0
    for q in range(0, 3000, 20):
        score = (d * d[q]).sum(axis=1)
        score[q] = -np.inf
        hits += len({r.id for r in got if r.query_id == q} & set(np.argsort(-score)[:20].tolist()))
    assert hits / (150 * 20) >= 0.9


# Mixing


def test_mix_cases(spark, odd, nothing):
    counted = nothing.select("*", word_count(F.col("text")).alias("words"))
    assert systematic_copies(counted, "doc_id", "words", "source").count() == 0
    assert mixed_rows(nothing, "doc_id", word_count(F.col("doc.text")), "source").count() == 0
    got = mixed_rows(odd, "doc_id", word_count(F.col("doc.text")), "source")
    assert got.columns == odd.columns
    counts = {}
    for r in got.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert all(n <= (4 if k == 5 else 2) for k, n in counts.items())
    only = documents(spark, [(1, None), (2, "")]).select("*", word_count(F.col("text")).alias("words"))
    assert [r.copies for r in systematic_copies(only, "doc_id", "words", "source").collect()] == [0, 0]


def test_mix_of_one_hot_source(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), rng.choice("bcd") if i % 3 else "a") for i in range(3000)]
    rows += [(10_000 + i, "same words again", "a") for i in range(1000)]
    docs = documents(spark, rows).select("*", F.length("text").cast("long").alias("words"))
    got = systematic_copies(docs, "doc_id", "words", "source").collect()
    again = systematic_copies(docs.repartition(7), "doc_id", "words", "source").collect()
    assert pick(got, "doc_id", "copies") == pick(again, "doc_id", "copies")
    for source in "abcd":
        of = [r for r in got if r.source == source]
        taken = sum(r.copies * r["words"] for r in of)
        assert abs(taken - of[0].target) <= 240 and max(r.copies for r in of) <= 2


# Packing


def test_word_ids_like_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, mine, rng = Tokenizer.from_file(tokenizer_path()), WordIds(tokenizer_path()), random.Random(3)
    kinds = ["aB'sT 1!", "éÀ×÷ a.A\n", "ab<|endoftext|> C", "á̸=ěJ ", "12a-b_c ", "\x1c\x85\xa0a b　", "😀 a!😀ñ 中a中", "'re've 'S'll x"]
    for _ in range(800):
        letters = [rng.choice(kinds) + rng.choice(kinds) for _ in range(rng.randint(1, 4))]
        texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 25))) + rng.choice(["", "", "<|endoftext|>"]) for a in letters]
        ids, counts = mine.encode([t.encode() for t in texts])
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_packing_cases(spark, odd, nothing):
    assert packed_documents(nothing, "doc_id", "text", tokenizer_path()).count() == 0
    got = packed_documents(odd, "doc_id", "text", tokenizer_path(), limit=1000).collect()
    assert sum(r.start == 0 for r in got) == 8
    assert all(len(r.ids) == r.length <= 1000 for r in got)
    assert {r.doc_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    whole = sorted((r.start, r.ids) for r in got if r.doc_id == 4)
    again = tokenised_pieces(odd.where("doc_id = 4"), "doc_id", "text", tokenizer_path(), 1 << 30, 2).collect()
    assert len(again) == 1 and sum((ids for _, ids in whole), []) == again[0].ids and again[0].ids[-1] == 2


def test_limits_hold_together(spark):
    rng = random.Random(6)
    rows = [(i, n, 1, rng.randint(0, n)) for i in range(2000) for n in [rng.randint(1, 900)]]
    pieces = spark.createDataFrame(rows, "i long, tokens long, segments long, loss long").withColumn("offset", F.lit("old")).withColumn("d0", F.lit(0))
    got = pack(pieces, {"tokens": 2048, "segments": 6, "loss": 900}).collect()
    assert len(got) == 2000
    bins = {}
    for r in got:
        b = bins.setdefault(r.sequence_id, [0, 0, 0])
        b[0], b[1], b[2] = b[0] + r.tokens, b[1] + 1, b[2] + r.loss
    assert all(b[0] <= 2048 and b[1] <= 6 and b[2] <= 900 for b in bins.values())
    least = max(sum(r[1] for r in rows) / 2048, len(rows) / 6, sum(r[3] for r in rows) / 900)
    assert len(bins) <= 1.1 * least
    with pytest.raises(Exception, match="exceeds"):
        pack(pieces, {"tokens": 10}).count()


def test_bins_fill_well():
    rng = np.random.default_rng(2)
    tokens = rng.integers(1, 4097, 3000)
    bins, _ = fill_bins(np.column_stack([tokens, np.ones_like(tokens), tokens]), np.array([4096, 256, 4096]))
    assert np.bincount(bins, tokens).max() <= 4096 and len(set(bins)) <= 1.03 * tokens.sum() / 4096


def test_batches_hold_their_limit():
    import pyarrow as pa

    table = pa.table({"t": pa.array(["a" * 10, None, "b" * 100, "", "c" * 50, "d" * 50])})
    ranges = list(batches(table, 60, "t"))
    assert ranges == [(0, 2), (2, 3), (3, 5), (5, 6)]
