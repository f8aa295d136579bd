"""Small tables and brute-force versions shared by the tests."""

from __future__ import annotations

import re
from collections import defaultdict

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    """Documents of (id, text) or (id, text, source); further columns that clash with inner names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) + tuple(7 for _ in extra) for r in rows]
    return spark.createDataFrame(full, DOCS + "".join(f", `{c}` int" for c in extra)).repartition(3)


def table(spark, name, folder=FOLDER):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def roots(nodes, links):
    """Smallest member of each node's component."""
    above = {n: n for n in nodes}

    def find(n):
        while above[n] != n:
            above[n] = above[above[n]]
            n = above[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        above[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_sets(rows, width):
    sets = {}
    for key, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = WORDS.findall(lowered)
        few = {tuple(words)} if words else set()
        sets[key] = few if len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return sets


def near_links(sets, num=80, den=100):
    by_shingle, shared = defaultdict(list), defaultdict(int)
    for key in sorted(sets):
        for s in sets[key]:
            by_shingle[s].append(key)
    for keys in by_shingle.values():
        for i, b in enumerate(keys):
            for a in keys[:i]:
                shared[a, b] += 1
    return [(a, b) for (a, b), n in shared.items() if den * n >= num * (len(sets[a]) + len(sets[b]) - n)]
