"""Every query of the subpackage over the driver tables, by its SQL or by brute force."""

import hashlib
import re
import sys
import zlib
from collections import defaultdict
from os.path import dirname

import numpy as np
import pytest

sys.path.insert(0, dirname(__file__))
sys.path.insert(0, dirname(dirname(__file__)))

from compare import compare, connect  # noqa: E402
from helpers import FOLDER, WORDS, near_links, roots, shingle_sets, table  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from seriesloom.llm.queries import ORACLES, QUERIES, tokenizer_path  # noqa: E402


def rows(spark, name):
    return entry.queries()[name](spark, FOLDER).collect()


def texts(spark):
    return {r.doc_id: r.text for r in table(spark, "documents").collect()}


def test_all_are_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(n) for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    same, message = compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER)
    assert same, message


def jump(key, shards):
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_shards(spark):
    text = texts(spark)
    slots = defaultdict(list)
    got = rows(spark, "op2_jump_shards")
    assert len(got) == len(text)
    for r in got:
        data = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 40), jump(r.doc_id, 41))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(p) <= 255 for p in t.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 14 <= len(re.sub("[ -]", "", t)) <= 19 and luhn(re.sub("[ -]", "", t))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 10 <= len(re.sub("[^0-9]", "", t)) <= 15),
]


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern, valid) in enumerate(BASE):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if valid(m[0])]
    return [s[2] for s in sorted(found)]


def test_personal_data(spark):
    text = texts(spark)
    got = rows(spark, "op3_anchor_pii")
    assert len(got) == len(text)
    for r in got:
        want = base_spans(text[r.doc_id] or "")
        assert [r[f"n_{k[0]}"] for k in BASE] == [sum(s.startswith(k[0]) for s in want) for k in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}


def test_quality_on_held_out_labels(spark):
    from pyspark.sql import functions as F

    from seriesloom.llm.cotraining import fit_views, score_quality

    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, "documents", folder), table(spark, "labels", folder)
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(3)) == 0
    scored = score_quality(docs, fit_views(docs, labels.where(~unseen))).select("row.doc_id", "kept", "score")
    held = scored.join(labels.where(unseen), "doc_id").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in held]) >= 0.93
    assert np.mean([r.kept for r in held if r.quality == 1]) >= 0.98
    assert len(rows(spark, "op4_cotraining")) == len(texts(spark))


def test_main_text(spark):
    from html import unescape

    pages = {r.page_id: r for r in table(spark, "pages").collect()}
    got = rows(spark, "op5_template_text")
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_near_duplicates(spark):
    sets = shingle_sets(texts(spark).items(), 2)
    component = roots(sets, near_links(sets))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows(spark, "op6_hamming_join")}
    assert got == {k: (len(s), component[k], component[k] == k) for k, s in sets.items()}


def vectors(spark):
    found = sorted(table(spark, "embeddings").collect())
    return [r.vec_id for r in found], np.array([r.embedding for r in found], dtype=np.float64)


def test_near_duplicate_vectors(spark):
    ids, x = vectors(spark)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    component = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows(spark, "op7_pca_tiles")}
    assert got == {k: (int(n), component[k], component[k] == k) for k, n in zip(ids, linked.sum(axis=1))}


def test_neighbours(spark):
    ids, x = vectors(spark)
    found = defaultdict(list)
    for r in sorted(rows(spark, "op8_cross_polytope")):
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for i, query in enumerate(ids):
        if query % 20:
            continue
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if j != i][:20]
        got = found[query]
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(score[ids.index(v)] == s for _, v, s in got)
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        hits += len({ids[j] for j in order} & {g[1] for g in got})
        total += 20
    assert hits / total >= 0.9


def filled(sizes):
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    pool, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        share = {s: pool * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            pool -= target[s]
            open_.discard(s)
    return target


def test_mix(spark):
    docs = {r.doc_id: r for r in table(spark, "documents").collect()}
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    got = rows(spark, "op9_systematic_mix")
    assert len(got) == len(docs)
    for r in got:
        source = docs[r.doc_id].source
        assert r["size"] == len(WORDS.findall(docs[r.doc_id].text or ""))
        assert 0 <= r.taken <= 2 * r["size"]
        sizes[source] += r["size"]
        taken[source] += r.taken
        largest[source] = max(largest[source], r["size"])
    target = filled(sizes)
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6
    for r in got:
        source = docs[r.doc_id].source
        assert r.source_size == sizes[source] and abs(r.target - target[source]) < 1e-6
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer, text = Tokenizer.from_file(tokenizer_path()), texts(spark)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op10_vector_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(text)
    for key, value in text.items():
        ids = np.array(tokenizer.encode(value or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(len(t or "") for t in text.values()) > 0 and len(sequences) <= sum(n for p in sequences.values() for _, n in p) / 4096 + 2


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = table(spark, "documents")
    kept = []
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        before, docs = docs, spark.createDataFrame(out.collect(), out.schema)
        kept.append((name, before.collect(), docs.collect()))
    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    good = [r.doc_id for r in kept[0][1] if labels.get(r.doc_id) == 1]
    stay = {r.doc_id for r in kept[0][2]}
    assert sum(g in stay for g in good) >= 0.98 * len(good)
    sets = shingle_sets([(r.doc_id, r.text) for r in kept[1][1]], 5)
    assert {r.doc_id for r in kept[1][2]} == {k for k, c in roots(sets, near_links(sets)).items() if k == c}
    for r in kept[2][2]:
        assert not base_spans(r.text or "") and r.n_chars == len(r.text)
    counts = defaultdict(int)
    for r in kept[3][2]:
        counts[r.doc_id] += 1
    assert max(counts.values()) <= 2
    packed = p.packing(spark, docs, FOLDER).collect()
    assert sum(r.start == 0 for r in packed) == len(kept[3][2])
    assert entry.queries()["pipeline"](spark, FOLDER).count() == len(packed)


def test_outputs_hold_their_payload(spark):
    import zlib

    import corpus_pipeline as p

    for r in rows(spark, "op10_vector_packing"):
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
    assert "ids" in p.packing(spark, table(spark, "documents"), "").columns
    text = texts(spark)
    for r in rows(spark, "op3_anchor_pii"):
        assert (r.cleaned == text[r.doc_id]) == (r.spans == "")


def test_a_stage_leaves_its_output_only(spark):
    import os

    from seriesloom.llm.common import cleared, stored
    from seriesloom.session import shared_dir

    def there():
        return set(os.listdir(shared_dir(spark)))

    before = there()
    with cleared(spark) as outer:
        with cleared(spark) as keep:
            inner = stored(spark.range(5), "inner")
            kept = keep(inner.where("id > 1"), "kept")
        assert kept.count() == 3 and len(there() - before) == 1
        last = outer(kept, "last")
    assert last.count() == 3 and len(there() - before) == 1
