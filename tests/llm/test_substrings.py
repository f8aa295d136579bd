"""Suffix arrays, common prefixes and the removal of repeated passages, against brute force."""

import os
import random
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers import DOCS, FOLDER, documents, table  # noqa: E402

from seriesloom.llm import substrings, suffixes  # noqa: E402
from seriesloom.llm.substrings import segments, without_repeats  # noqa: E402
from seriesloom.llm.suffixes import common_prefixes, suffix_array  # noqa: E402

CLASH = ("key", "tid", "row", "start", "windows", "anchor", "digest", "bytes", "weight", "spans", "kept")


def removed(rows, length):
    """Brute force: (key, bytes, removed spans, kept) of every (key, text)."""
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for key, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = np.flatnonzero(np.diff(np.frombuffer(bytes(gone), dtype=np.int8), prepend=0, append=0)).tolist()
        out.append((key, len(text), tuple(zip(edges[::2], edges[1::2])), bytes(b for b, g in zip(text, gone) if not g)))
    return Counter(out)


def result(docs, length):
    got = without_repeats(docs, "doc_id", "text", length).collect()
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in got)
    return Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got)


@pytest.mark.parametrize("short", [0, 1 << 17])
def test_suffix_array_and_prefixes(monkeypatch, short):
    monkeypatch.setattr(suffixes, "SHORT", short)
    rng = random.Random(12)
    cases = ["", "a" * 300, "mississippi" * 9] + ["".join(rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.randint(1, 80))) for _ in range(600)]
    for text in cases:
        string = np.append(np.frombuffer(text.encode(), dtype=np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
        order = suffix_array(string, 257)
        t = string.tolist()
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        shared = common_prefixes(string, order)
        for a, b in zip(order[1:].tolist(), order[:-1].tolist()):
            n = next(k for k in range(len(t)) if t[a + k] != t[b + k])
            assert shared[a] == n


@pytest.mark.parametrize("anchor,shard", [(3, 1 << 21), (3, 60), (8, 30), (100, 1 << 21), (1, 40)])
def test_like_brute_force(spark, monkeypatch, anchor, shard):
    """Also with pieces, segments and shards so small that every anchor is split down to single windows."""
    monkeypatch.setattr(substrings, "ANCHOR", anchor)
    monkeypatch.setattr(substrings, "SHARD_BYTES", shard)
    monkeypatch.setattr(substrings, "PIECE_BYTES", 50)
    monkeypatch.setattr(substrings, "SEGMENT_WINDOWS", 5)
    rng = random.Random(anchor + shard)
    stock = ["".join(rng.choice("abcé ") for _ in range(rng.randint(5, 40))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(stock) if rng.random() < 0.5 else rng.choice("xyzé") * rng.randint(1, 12) for _ in range(rng.randint(0, 7)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, stock[0] * 3), (202, "ab" * 40), (203, stock[1] + "ü"), (203, stock[1] + "ü"), (204, "é" * 30), (205, " ")]
    assert result(documents(spark, rows, CLASH), 12) == removed(rows, 12)


def test_hot_passage_and_long_texts(spark, monkeypatch):
    """A passage just below and just above the length in many texts; a text of several pieces."""
    monkeypatch.setattr(substrings, "SHARD_BYTES", 20_000)
    rng = random.Random(7)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    short, long = noise(390), noise(450)
    rows = [(i, noise(rng.randint(0, 300)) + (short if i % 3 else long) + noise(rng.randint(0, 300))) for i in range(150)]
    body = noise(5_000_000)
    rows += [(1000, body), (1001, noise(500) + body[4_194_000:4_195_000] + noise(20)), (1002, "-" * 20_000)]
    got = result(documents(spark, rows), 400)
    want = removed(rows, 400)
    assert got == want
    assert sum(bool(spans) for _, _, spans, _ in got) >= 53


def test_nothing_and_given_table(spark):
    assert without_repeats(spark.createDataFrame([], DOCS), "doc_id", "text").count() == 0
    docs = table(spark, "documents", FOLDER)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, 400) == removed(rows, 400)


def test_segments_hold_every_window_once():
    text = ("abcabcabd" * 300 + "x" * 5000).encode()
    starts, windows, _, _ = segments(text, 400)
    assert starts[0] == 0 and (starts[1:] == (starts + windows)[:-1]).all()
    assert starts[-1] + windows[-1] == len(text) - 399


def test_the_query_shows_what_is_left(spark, tmp_path):
    """The kept text beside its digest; a passage that starts within a character leaves a mark, the digest the byte."""
    from hashlib import sha256

    from seriesloom.llm.queries import QUERIES

    passage = " ".join(random.Random(4).choice(("apple", "pear", "plum", "fig", "melon")) + str(i) for i in range(60))
    rows = [(1, "first é" + passage + "end"), (2, "other ũ" + passage), (3, "alone " * 30), (4, None), (5, "café")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op12_repeated_passages"](spark, str(tmp_path)).collect()}
    assert {k: r.kept_text for k, r in got.items()} == {1: "first �end", 2: "other �", 3: "alone " * 30, 4: "", 5: "café"}
    assert got[1].kept_sha256 == sha256(b"first \xc3end").hexdigest() and got[1].n_removed == got[2].n_removed == len(passage) + 1
    assert [got[k].n_removed for k in (3, 4, 5)] == [0, 0, 0]
