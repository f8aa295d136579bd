"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / size of the source`` copies. The expected copies are
summed up along the source, one random offset is added, and a document is emitted once for each whole
number its stretch crosses. Sources run in order of document size, so each size gets its share and
the words taken come near the target, not only the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import small, stored

WORD = r"[^\x20\x09-\x0D]+"
SOURCE = ["no_source", "source_key"]


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """``target`` per source; ``sizes`` has one row per source with its ``source_size``.

    Sources by code point, null last, take ``weights`` in turn. Together they get ``share`` of all
    sizes, none more than ``cap`` times its own; what is above goes to the others by weight. That
    ends where every target is ``least(cap * size, level * weight)`` for one level: with sources in
    order of ``cap * size / weight`` it is the level of the first source that can hold its share, the
    highest of all that fit.
    The windows here see one row per source.
    """
    in_turn = Window.orderBy(*SOURCE)
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(in_turn) - 1) % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(cap)
    weighted = sizes.select("*", turn.cast("long").alias("weight"), full.alias("full"))
    by_room = Window.orderBy(F.col("full") / F.col("weight"), *SOURCE)
    everything = Window.partitionBy()
    earlier, later = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    pool = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    level = pool / F.sum("weight").over(later)
    leveled = weighted.select("*", F.when(level * F.col("weight") <= F.col("full"), level).alias("fits"))
    highest = F.max("fits").over(everything)
    target = F.least(F.col("full"), F.coalesce(highest * F.col("weight"), F.col("full")))
    return leveled.select(*SOURCE, "source_size", target.cast("double").alias("target"))


def offset(seed: int) -> Column:
    """A number in [0, 1) fixed by ``seed`` and the source."""
    name = F.concat(F.lit(f"{seed}:"), F.when(F.col("no_source"), F.lit("-")).otherwise(F.concat(F.lit("+"), "source_key")))
    return F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def systematic_copies(
    docs: DataFrame, key: str, size: str, source: str, weights=(3, 1, 2), share=1.5, cap=2.0, seed=20, row: str | None = None
) -> DataFrame:
    """``key``, ``size``, ``source``, ``source_size``, ``target`` and ``copies`` of every row, and ``row``.

    ``row`` names one more column to carry along, such as a number that tells repeated keys apart.

    Positions along a source are counted, not collected: rows per size, then rows per leading digits
    of the key's hash within a size, then a row number within those few. A source, a size or a group
    of copies of any weight is thereby spread. Reruns agree. A source whose documents have no words
    has target 0 and no copies; repeated rows each have a position of their own; a null key sorts
    first; an empty table gives no rows.
    """
    hashed = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = stored(docs.select(
        F.col(key).alias("key"), F.col(size).cast("long").alias("size"), F.col(source).isNull().alias("no_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source_key"), hashed.alias("hash"),
        (F.col(row) if row else F.lit(0)).alias("row"),
    ), "mix").withColumn("lead", F.substring("hash", 1, 3))
    cells = rows.groupBy(*SOURCE, "size", "lead").agg(F.count("*").alias("n"))
    by_size = cells.groupBy(*SOURCE, "size").agg(F.sum("n").alias("n"))
    sizes = by_size.groupBy(*SOURCE).agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)

    before = Window.unboundedPreceding, -1
    smaller = F.coalesce(F.sum("n").over(Window.partitionBy(*SOURCE).orderBy("size").rowsBetween(*before)), F.lit(0))
    lower = F.coalesce(F.sum("n").over(Window.partitionBy(*SOURCE, "size").orderBy("lead").rowsBetween(*before)), F.lit(0))
    starts = (
        cells.select(*SOURCE, "size", "lead", lower.alias("lower"))
        .join(by_size.select(*SOURCE, "size", smaller.alias("smaller")), [*SOURCE, "size"])
        .join(targets, SOURCE)
        .select(*SOURCE, "size", "lead", (F.col("lower") + F.col("smaller")).alias("start"), "source_size", "target")
    )
    nth = F.row_number().over(Window.partitionBy(*SOURCE, "size", "lead").orderBy("hash", "key")) + F.col("start")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = rows.join(starts, [*SOURCE, "size", "lead"]).select("*", nth.alias("nth"), rate.alias("rate"), offset(seed).alias("offset"))
    crossed = F.floor(F.col("rate") * F.col("nth") + F.col("offset")) - F.floor(F.col("rate") * (F.col("nth") - 1) + F.col("offset"))
    return placed.select(
        F.col("key").alias(key), F.col("size").alias(size), F.when(~F.col("no_source"), F.col("source_key")).alias(source),
        "source_size", "target", F.least(crossed, F.ceil(F.lit(cap))).cast("long").alias("copies"),
        *([F.col("row").alias(row)] if row else []),
    )


def mixed_rows(docs: DataFrame, key: str, size: Column, source: str, **options) -> DataFrame:
    """The rows of the mix: each row of ``docs`` once per copy, none for no copy, all columns kept.

    Rows are numbered and written first, so repeated keys and null keys get copies of their own.
    """
    numbered = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))
    numbered = stored(numbered, "mix-rows")
    sized = numbered.select(F.col("doc").getField(key).alias("key"), F.col("doc").getField(source).alias("source"), size.alias("size"), "row")
    copies = systematic_copies(sized, "key", "size", "source", row="row", **options).where("copies > 0").select("row", "copies")
    joined = numbered.join(small(copies, 32), "row")
    return joined.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("doc.*")
