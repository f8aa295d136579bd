"""Which sources of a language use words unlike the others, and which words those are.

Terms are counted per language and source. All that is compared depends on counts alone, so the ranking
works on cells of equal counts: the terms of a source with the same count there and in the language are
one cell with a multiplicity. The value is worked out once per cell, cells of equal value are merged and
ranked by their multiplicities summed up, and only the cells in reach of the report are expanded into
terms, in UTF-8 order. Sources are compared in blocks of terms, whose sums are added up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import ship, small, stored

ship(__name__)

PIECE_BYTES = 1 << 20
#: Distinct terms a task holds before it hands on their counts.
HELD = 200_000
#: Sources times terms of a block.
BLOCK_CELLS = 200_000
# Letters and all bytes above ASCII make terms, A to Z count as a to z.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in order, a bounded number of bytes at a time."""
    data = data.translate(LETTERS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and ``docs`` that hold it."""
    names = ["lang", "source", "term", "n", "docs"]

    def handed(held: dict) -> pa.RecordBatch:
        rows = [(*group, term, n, found[term]) for group, (every, found) in held.items() for term, n in every.items()]
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in tables:
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            values = batch.column(2).cast(pa.large_binary())
            size = 0
            for i, group in enumerate(groups):
                every, found = held.setdefault(group, (Counter(), Counter()))
                before, own = len(every), set()
                for terms in pieces(values[i].as_py()):
                    every.update(terms)
                    own.update(terms)
                found.update(own)
                size += len(every) - before
                if size > HELD:
                    yield handed(held)
                    held, size = {}, 0
            yield handed(held)
            held = {}

    rows = docs.select(*[F.make_valid_utf8(F.coalesce(F.col(c), F.lit(""))) for c in (lang, source, text)])
    return (
        rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def share(n: Column, total: Column, kinds: Column, smoothing: int, scale: int) -> Column:
    """``1 + floor(scale * (n + smoothing) / (total + smoothing * kinds))`` in exact whole numbers; null without kinds."""
    top = F.lit(scale).cast("decimal(12,0)") * (n + smoothing).cast("decimal(19,0)")
    below = F.nullif(total + smoothing * kinds, F.lit(0).cast("long")).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", top, below)


def source_pairs(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source) and their shares' summed distance over all kept terms.

    ``rated`` has the share ``p`` of each term that occurs in a source, ``groups`` the sources with their
    number of ``kinds`` and the share ``p`` of a term without occurrences.
    """
    sizes = groups.groupBy("lang").agg((F.max("kinds") * F.count("*") / F.lit(float(BLOCK_CELLS))).alias("blocks"))
    sizes = stored(sizes.select("lang", F.greatest(F.ceil("blocks"), F.lit(1)).cast("long").alias("blocks")), "blocks")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = np.sort(right["source"].to_numpy(dtype=object))
        zero = right.set_index("source")["p"].reindex(names).fillna(0).to_numpy(dtype=np.int64)
        kinds, term = np.unique(left["term"].to_numpy(dtype=object), return_inverse=True)
        table = np.repeat(zero[:, None], len(kinds), axis=1)
        table[np.searchsorted(names, left["source"].to_numpy(dtype=object)), term] = left["p"].to_numpy(dtype=np.int64)
        parts = [(i, np.abs(table[i + 1 :] - table[i]).sum(axis=1)) for i in range(len(names) - 1)]
        first = np.concatenate([np.full(len(v), i) for i, v in parts] or [[]]).astype(int)
        second = np.concatenate([np.arange(i + 1, len(names)) for i, _ in parts] or [[]]).astype(int)
        value = np.concatenate([v for _, v in parts] or [[]]).astype(np.int64)
        lang = right["lang"].iloc[0] if len(right) else ""
        return pd.DataFrame({"lang": lang, "a": names[first], "b": names[second], "value": value})

    cut = rated.join(small(sizes, 64), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    every = groups.join(small(sizes, 64), "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    left = cut.select("lang", "block", "source", "term", "p").groupBy("lang", "block")
    right = every.select("lang", "block", "source", "p").groupBy("lang", "block")
    sums = left.cogroup(right).applyInPandas(run, "lang string, a string, b string, value long")
    sums = stored(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    return sums.toDF("lang", "source", "item", "value").union(sums.select("lang", "b", "a", "value"))


def telling_terms(rated: DataFrame, top: int) -> DataFrame:
    """``lang``, ``source``, ``item`` (a term above the language's share), ``value`` and ``rank`` up to ``top``.

    ``rated`` has the counts ``n`` and ``total`` of each term in the source and in the language, and its
    shares ``p`` and ``q`` there, which follow from the counts.
    """
    cell = ["lang", "source", "n", "total"]
    cells = rated.where("p > q").groupBy(*cell).agg((F.first("p") - F.first("q")).alias("value"), F.count("*").alias("terms"))
    cells = stored(cells, "cells")
    # The report ends in the first cells whose multiplicities reach it; as many values are enough.
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    values = values.withColumn("place", F.row_number().over(group)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("terms").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    reached = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    wanted = stored(cells.join(small(stored(reached, "values"), 96), ["lang", "source", "value"]).select(*cell, "value", "before"), "reached")
    # New columns on the other side: both come from the same table.
    terms = rated.select(*[F.col(c).alias(c) for c in (*cell, "term")]).join(small(wanted, 128), cell)
    equal = Window.partitionBy("lang", "source", "value", "before").orderBy("term")
    terms = terms.withColumn("nth", F.row_number().over(equal)).where(F.col("nth") <= top)
    ranked = terms.withColumn("rank", F.col("before") + F.col("nth")).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank"))


def divergence_audit(
    docs: DataFrame, text: str, lang: str, source: str, min_docs: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of every group of language and source.

    Part ``pair`` ranks the other sources of the language by the distance of their term shares, all of
    them; part ``term`` ranks terms by how far their share is above the language's, to rank ``top``. Ties
    are in UTF-8 order. Each language keeps the terms in at least ``min_docs`` of its rows; a share is
    smoothed and a whole number of ``scale``. Null texts, languages and sources count as empty strings; a
    repeated row counts as often as it stands; texts are read whole, long ones in pieces; other columns
    are left out. A language without kept terms has distances of 0 and no terms; an empty table gives no
    rows. Sources of one language are held against each other in full, which is the result's own size.
    """
    counts = stored(term_counts(docs, text, lang, source), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    counted = stored(counts.select("lang", "source", "term", "n").join(kept.select("lang", "term", "total"), ["lang", "term"]), "counted")
    langs = counted.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang")
    langs = stored(langs.agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_terms")), "langs")
    sums = counted.groupBy("lang", "source").agg(F.sum("n").alias("terms"))
    every = docs.select(*[F.make_valid_utf8(F.coalesce(F.col(c), F.lit(""))).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    none = F.lit(0).cast("long")
    groups = every.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("terms", "kinds", "lang_terms")]), "groups")

    def rate(n: Column, total: str) -> Column:
        return share(n, F.col(total), F.col("kinds"), smoothing, scale)

    rated = counted.join(small(groups, 128), ["lang", "source"])
    rated = stored(rated.select("lang", "source", "term", "n", "total", rate(F.col("n"), "terms").alias("p"), rate(F.col("total"), "lang_terms").alias("q")), "rated")
    pairs = source_pairs(rated, groups.select("lang", "source", "kinds", rate(none, "terms").alias("p")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(by_value).cast("int"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(telling_terms(rated, top).withColumn("part", F.lit("term")).select(columns))
