"""Fill-in-the-middle forms and the divergence of sources, against brute force on hand-made rows."""

import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from helpers import DOCS, documents  # noqa: E402

from seriesloom.llm.divergence import divergence_audit, pieces  # noqa: E402
from seriesloom.llm.infilling import infilled, restored  # noqa: E402

CLASH = ("key", "h", "h0", "n", "form", "output", "term", "total", "block", "value", "rank", "p", "kinds")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LONG = " ".join(f"wort{i * 7919 % 100_003}" for i in range(300_000))


def infill(key, text, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    cut = UNIT.findall(text)
    a, b = sorted((h1 % (len(cut) + 1), h2 % (len(cut) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(cut), "plain", text, None, None
    p, m, s = "".join(cut[:a]), "".join(cut[a:b]), "".join(cut[b:])
    output = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return len(cut), "spm" if h4 % 100 < 80 else "psm", output, len(p), len(m)


def test_infilling_like_brute_force(spark):
    rng = random.Random(11)
    rows = [(None, "a b"), (1, None), (2, ""), (3, " \n"), (4, LONG), (5, "x <P> y"), (6, "é\x0b 漢字 \U0001f600 z"), (6, "é\x0b 漢字 \U0001f600 z"), (7, "\x00 a")]
    rows += [(i, "".join(rng.choice("ab é<PSM>\n\t　") for _ in range(rng.randint(0, 40)))) for i in range(10, 1500)]
    docs = documents(spark, rows, CLASH)
    made = infilled(docs, "doc_id", "text")
    got = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = Counter((k, *infill(k, t)) for k, t in rows)
    assert Counter((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in got) == want
    assert Counter((r.doc_id, r.back) for r in got) == Counter((k, t or "") for k, t in rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert {r.form for r in infilled(docs, "doc_id", "text", rate=0).collect()} == {"plain"}


def test_infilling_of_nothing_and_of_broken_text(spark):
    assert infilled(spark.createDataFrame([], DOCS), "doc_id", "text").count() == 0
    broken = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("cast(X'61ff20c362' as string)").alias("text"))
    made = infilled(broken, "doc_id", "text")
    assert {r[0] for r in made.select(restored(F.col("output"), F.col("form"))).collect()} == {"a� �b"}


def audit(rows, least, top=50):
    """Brute force over (lang, source, text)."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in held[lang].items() if n >= least), key=str.encode)

        def shares(source):
            total = sum(counts[lang, source][t] for t in kept)
            return [1 + 10**9 * (counts[lang, source][t] + 5) // (total + 5 * len(kept)) for t in kept]

        whole, own = shares(None), {s: shares(s) for s in sources}
        for source in sources:
            pairs = [(-sum(abs(x - y) for x, y in zip(own[source], own[o])), o.encode(), o) for o in sources if o != source]
            out += [(lang, source, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            terms = [(q - p, t.encode(), t) for t, p, q in zip(kept, own[source], whole) if counts[lang, source][t] and p > q]
            out += [(lang, source, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


@pytest.mark.parametrize("least,top", [(1, 50), (3, 50), (2, 4), (10_000, 50)])
def test_divergence_like_brute_force(spark, least, top):
    rng = random.Random(13)
    words = ["Alpha", "beta", "Gamma", "straße", "ÉCOLE", "漢字", "x", "ü", "zz", "\U0001f600k"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = [(rng.choice(["de", "en", None]), rng.choice(["a", "b", "ç", None, "hot", "hot", "hot"]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for _ in range(200)]
    rows += [("fr", "only", "un deux"), ("it", "a", ""), ("it", "b", None), ("it", "c", "9 8 7"), ("es", "a", "uno"), ("es", "b", "uno"), ("es", "b", "uno")]
    table = spark.createDataFrame([(i, t, g, s, 0, *[7] * len(CLASH)) for i, (g, s, t) in enumerate(rows)], DOCS + "".join(f", `{c}` int" for c in CLASH))
    got = divergence_audit(table.repartition(3), "text", "lang", "source", min_docs=least, top=top).collect()
    assert sorted(tuple(r) for r in got) == audit(rows, least, top)


def test_divergence_blocks_and_long_texts(spark, monkeypatch):
    assert divergence_audit(spark.createDataFrame([], DOCS), "text", "lang", "source").count() == 0
    rows = [("en", f"s{i % 4}", LONG[i * 3000 : i * 3000 + 9000]) for i in range(12)] + [("en", "s1", LONG)]
    table = spark.createDataFrame([(i, t, g, s, 0) for i, (g, s, t) in enumerate(rows)], DOCS)
    monkeypatch.setattr("seriesloom.llm.divergence.BLOCK_CELLS", 5000)
    got = divergence_audit(table, "text", "lang", "source", min_docs=2).collect()
    assert sorted(tuple(r) for r in got) == audit(rows, 2)
    assert [t for p in pieces(LONG.encode() * 2) for t in p] == re.findall(rb"[a-z]+", LONG.encode() * 2)
