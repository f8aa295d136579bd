"""Near duplicates by a multi-index Hamming join over b-bit MinHash signatures.

A text is the set of its word shingles. Its signature has ``SYMBOLS`` MinHash values of 8 bits; two
signatures differ in about ``1 - similarity`` of their symbols. The signature is split into chunks. By
the pigeonhole principle two signatures that differ in at most ``2 * chunks - 1`` symbols agree in some
chunk but for one symbol at most. So every chunk is looked up once for each symbol that may be wrong,
with that symbol left out, and all pairs under the distance meet in a bucket. Pairs are confirmed on
their full shingle sets.

Texts of equal sets are one class before anything is paired, and a bucket is never written out as
pairs. Its classes are compared with its centre, the member that shares most buckets; each class has
the heaviest centre near it as its home. Where a bucket's classes are then still in several components,
those outside the largest are compared with the homes found in the bucket: blocks of whole sets meet in
a task, and only links that span the components come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import batches, parts, ship, small, stored
from seriesloom.llm.components import connected_components, spanning
from seriesloom.llm.words import mixed, text_words

ship(__name__)

SYMBOLS = 64
CHUNK = 6
BATCH_BYTES = 1 << 20
#: Symbols that may differ: past it a pair of similarity 0.8 is lost about once in a million.
DISTANCE = 29
#: A block of sets that meets another in a task: rows and shingles, about.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 500_000
_RNG = np.random.default_rng(6)
SEEDS = _RNG.integers(0, 1 << 32, SYMBOLS, dtype=np.uint64).astype(np.uint32)
FACTORS = _RNG.integers(0, 1 << 32, SYMBOLS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; fewer words are one shingle."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + count])
    return np.unique(total)


def signature(shingles: np.ndarray) -> bytes:
    """``SYMBOLS`` MinHash values of 8 bits."""
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(SYMBOLS, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(folded), 2048):
        block = folded[a : a + 2048, None] ^ SEEDS
        block *= FACTORS
        np.minimum(low, block.min(axis=0), out=low)
    return (((low * np.uint32(0x9E3779B1)) ^ SEEDS) >> np.uint32(24)).astype(np.uint8).tobytes()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Table, list[bytes]]]:
    table = pa.table([batch.column(0), batch.column(1).cast(pa.large_binary())], names=["key", "text"])
    for a, b in batches(table, BATCH_BYTES, "text"):
        some = table.slice(a, b - a)
        yield some, [(t or b"").translate(LOWER) for t in some.column("text").to_pylist()]


def _set_id(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    spread = mixed(shingles + np.uint64(0x632BE59BD9B4E019))
    return int(np.add.reduce(spread).astype(np.int64)), int(np.bitwise_xor.reduce(mixed(spread * np.uint64(3))).astype(np.int64))


def signatures(docs: DataFrame, key: str, text: str, width: int, smallest: int) -> DataFrame:
    """``key``, ``n_shingles``, set id (``h1``, ``h2``) and signature of every row.

    A text without words has neither; a set below ``smallest`` can be linked to an equal set only and
    has no signature.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for some, texts in _texts(batch):
                sets = [shingle_set(w, width) for w in text_words(texts)]
                ids = [_set_id(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("key").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([i[0] for i in ids], pa.int64()), pa.array([i[1] for i in ids], pa.int64()),
                        pa.array([signature(s) if len(s) >= smallest else None for s in sets], pa.binary()),
                    ],
                    names=["key", "n_shingles", "h1", "h2", "signature"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, n_shingles long, h1 long, h2 long, signature binary")


def chunk_keys(signed: DataFrame) -> DataFrame:
    """``bucket`` and ``cid``: each chunk of a signature with each of its symbols left out."""
    spans = [(a, min(a + CHUNK, SYMBOLS)) for a in range(0, SYMBOLS, CHUNK)]

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = np.random.default_rng(60).integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
        for batch in tables:
            symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, SYMBOLS)
            terms = mixed(symbols.astype(np.uint64) + np.arange(SYMBOLS, dtype=np.uint64) * np.uint64(256)) * factors
            keys = np.empty((len(symbols), SYMBOLS), dtype=np.uint64)
            for a, b in spans:
                whole = terms[:, a:b].sum(axis=1, dtype=np.uint64)
                keys[:, a:b] = whole[:, None] - terms[:, a:b]
            keys = mixed(keys + np.arange(SYMBOLS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
            of = np.repeat(np.arange(len(symbols)), SYMBOLS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(pa.array(of))], names=["bucket", "cid"])

    return signed.select("cid", "signature").mapInArrow(run, "bucket long, cid long")


def with_distance(both: DataFrame, num: int, den: int) -> DataFrame:
    """``a``, ``b`` and ``distance`` of the rows of ``both`` at most ``most`` symbols apart.

    ``sa`` and ``sb`` are the signatures, ``na`` and ``nb`` the sizes of the sets. Sets whose sizes are too
    unlike for ``num / den`` are left out.
    """
    both = both.where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            sides = [np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(-1, SYMBOLS) for i in (3, 4)]
            apart = (sides[0] != sides[1]).sum(axis=1).astype(np.int64)
            near = pa.array(apart <= np.array(batch.column(2).to_pylist(), dtype=np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(apart)]
            yield pa.RecordBatch.from_arrays([c.filter(near) for c in columns], names=["a", "b", "distance"])

    return both.select("a", "b", "most", "sa", "sb").mapInArrow(run, "a long, b long, distance long")


def full_sets(docs: DataFrame, key: str, text: str, width: int, classes: DataFrame, cids: DataFrame) -> DataFrame:
    """``cid`` and ``shingles`` of the classes in ``cids``, from the texts of their smallest keys."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            for _, texts in _texts(batch):
                sets = [shingle_set(w, width) for w in text_words(texts)]
                ids = [_set_id(s) if len(s) else (None, None) for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                columns = [*(pa.array([i[k] for i in ids], pa.int64()) for k in (0, 1)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "shingles"])

    wanted = stored(classes.join(cids, "cid", "left_semi").select("cid", F.col("rep").alias("key"), "h1", "h2"), "wanted")
    again = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(small(wanted.select("key").distinct(), 32), "key", "left_semi")
    sets = again.select("key", "text").mapInArrow(run, "h1 long, h2 long, shingles array<long>")
    sets = sets.join(small(wanted.select("cid", "h1", "h2"), 48), ["h1", "h2"])
    return stored(sets.groupBy("cid").agg(F.first("shingles").alias("shingles")), "sets")


def similar(members: list[np.ndarray], queries: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which queries (rows) and members (columns) have ``den * shared >= num * all``."""
    sizes = np.array([len(m) for m in members])
    flat = np.concatenate(members)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(members)), sizes)[order]
    mask = np.empty((len(queries), len(members)), dtype=bool)
    for i, query in enumerate(queries):
        low, high = (np.searchsorted(flat, query, side) for side in ("left", "right"))
        found = high - low
        at = np.arange(found.sum()) + np.repeat(low - np.cumsum(found) + found, found)
        shared = np.bincount(owner[at], minlength=len(members))
        mask[i] = den * shared >= num * (len(query) + sizes - shared)
    return mask


def in_blocks(left: DataFrame, right: DataFrame, by: str, run, schema: str, sets: DataFrame | None = None, load: Column | None = None, beside: Column | None = None) -> DataFrame:
    """``run`` on blocks of the rows of ``left`` and ``right`` that agree in ``by``, every block with every other.

    Both tables have ``cid``. The rows of a group are cut into blocks by counts and by ``load`` (the set size
    ``n`` unless given), so a group of any size is spread; groups of one block each share lots of about a
    block, since most are a few rows. Of those, groups of one value of ``beside``, an aggregate of the rows of
    ``right``, share a lot; by it, few groups may have the same value.
    ``run`` gets all columns, and the ``shingles`` of each ``cid`` where ``sets`` are given.
    """
    load = F.col("n") if load is None else load
    blocks = F.ceil(F.greatest(F.sum(load) / F.lit(float(BLOCK_SHINGLES)), F.count("*") / F.lit(float(BLOCK_ROWS))))
    sizes = [x.groupBy(by).agg(blocks.alias(b), F.sum(load).alias(f"{b}_n"), F.count("*").alias(f"{b}_rows"), *more) for x, b, more in ((left, "ms", ()), (right, "qs", [(F.min(by) if beside is None else beside).alias("beside")]))]
    sizes = stored(sizes[0].join(sizes[1], by), "blocks")
    whole = sizes.where("ms = 1 and qs = 1").agg(F.sum(F.col("ms_n") + F.col("qs_n")).alias("n"), F.sum(F.col("ms_rows") + F.col("qs_rows")).alias("rows")).first()
    lots = max(parts(whole["n"] or 0, BLOCK_SHINGLES), parts(whole["rows"] or 0, BLOCK_ROWS))
    large = (F.col("ms") > 1) | (F.col("qs") > 1)
    sizes = sizes.select(by, "ms", "qs", large.alias("large"), F.when(large, F.col(by)).otherwise(F.pmod(F.xxhash64("beside"), F.lit(lots))).alias("lot"))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        given = [c for c in rows.columns if c != by]
        placed = rows.join(small(sizes, 48), by).select("large", "lot", by, *given, F.pmod(F.xxhash64("cid"), F.col(own)).alias(own), every.alias(other))
        columns = ["large", "lot", "ms", "qs", by, *given]
        if sets is not None:
            placed, columns = placed.join(sets, "cid"), [*columns, "shingles"]
        # New columns on both sides: the tables have ancestors in common.
        return placed.select(*(F.col(c).alias(c) for c in columns)).groupBy("large", "lot", "ms", "qs")

    return dealt(left, "ms", "qs").cogroup(dealt(right, "qs", "ms")).applyInPandas(run, schema)


def group_links(groups: DataFrame, asked: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links ``a``, ``b`` between the classes asked of a home and the members of that home.

    Both tables have ``cid``, ``home``, ``part`` and the set size ``n``; two classes of one part need
    no link. Of the links between two blocks only enough to span them are returned.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((2, 0), dtype=np.int64)]
        members, queries = left.groupby("home").indices, right.groupby("home").indices
        for home in members.keys() & queries.keys():
            of, ask = left.iloc[members[home]], right.iloc[queries[home]]
            mask = similar(list(of["shingles"]), list(ask["shingles"]), num, den)
            mask &= ask["part"].to_numpy()[:, None] != of["part"].to_numpy()
            r, c = spanning(mask)
            out.append(np.stack([ask["cid"].to_numpy()[r], of["cid"].to_numpy()[c]]))
        links = np.concatenate(out, axis=1)
        return pd.DataFrame({"a": links[0], "b": links[1]})

    return in_blocks(groups, asked, "home", run, "a long, b long", sets)


def near_homes(met: DataFrame, asking: DataFrame, num: int, den: int) -> DataFrame:
    """``a``, ``b``: the classes of ``asking`` and the homes ``met`` in a bucket whose signatures are near; with the class its ``part`` and ``n``.

    A home is near within ``most`` symbols and at sizes not too unlike for ``num / den``, and is of no use to
    a class of the one part that all its classes in the bucket have (``p`` = ``q``). Signatures are compared
    in the blocks; only near ones come out. A class meets a home in up to ``SYMBOLS`` buckets: small buckets of
    one smallest asking class lie together, and a pair comes out of them once.
    """

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((4, 0), dtype=np.int64)]
        homes, askers = left.groupby("bucket").indices, right.groupby("bucket").indices
        signs, own_signs = (np.frombuffer(b"".join(x["signature"]), dtype=np.uint8).reshape(-1, SYMBOLS) for x in (left, right))
        home, p, q, most, size = (left[c].to_numpy() for c in ("cid", "p", "q", "most", "n"))
        cid, part, own_size = (right[c].to_numpy() for c in ("cid", "part", "n"))
        for bucket in homes.keys() & askers.keys():
            of = homes[bucket]
            for i in askers[bucket]:
                near = ((part[i] != p[of]) | (part[i] != q[of])) & (np.minimum(own_size[i], size[of]) * den >= np.maximum(own_size[i], size[of]) * num)
                some = of[near]
                some = some[(signs[some] != own_signs[i]).sum(axis=1) <= most[some]]
                out.append(np.stack([np.full(len(some), cid[i]), home[some], np.full(len(some), part[i]), np.full(len(some), own_size[i])]))
        pairs = np.unique(np.concatenate(out, axis=1), axis=1)
        return pd.DataFrame(dict(zip(("a", "b", "part", "n"), pairs)))

    return in_blocks(met, asking, "bucket", run, "a long, b long, part long, n long", load=F.lit(0), beside=F.min("cid"))


def near_duplicates(docs: DataFrame, key: str, text: str, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Rows are linked when ``den * shared >= num * all`` for their shingle sets of ``width`` words, and
    carry the smallest key of their component. Texts without words, null ones included, link with
    nothing and stand for themselves. Repeated rows are in one component; repeats of the kept row
    share its key and are kept with it. Rows with a null key are left out; other columns are too; an
    empty table gives no rows.
    """
    # Two different sets share at most n of n + 1 shingles.
    smallest = max(1, -(-num // (den - num))) if den > num else 1 << 62
    docs = docs.where(F.col(key).isNotNull())
    signed = stored(signatures(docs, key, text, width, smallest), "signatures")
    by_set = signed.where("h1 is not null").groupBy("h1", "h2")
    classes = by_set.agg(F.min("key").alias("rep"), F.max("n_shingles").alias("n"), F.max("signature").alias("signature"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    keys = chunk_keys(classes.where("signature is not null"))
    buckets = keys.groupBy("bucket").agg(F.min("cid").alias("low"), F.max("cid").alias("high"), F.count("*").alias("size"))
    buckets = stored(buckets.where("low < high"), "buckets")
    members = stored(keys.join(buckets.where("size > 2").select("bucket", "size"), "bucket"), "members")
    twos = buckets.where("size = 2")

    # Each class against the centres of its buckets; the heaviest near one is its home, so that the
    # classes of a group have few homes between them.
    weight = stored(members.groupBy("cid").agg(F.sum("size").alias("weight")), "weights")
    side = classes.select("cid", "n", "signature")
    # Signatures come to the members once per class, and the centre's lies with its bucket: a pair is judged there.
    known = members.join(weight.join(side, "cid"), "cid")
    centres = known.groupBy("bucket").agg(F.max(F.struct("weight", "cid", "n", "signature")).alias("centre"))
    around = known.join(centres, "bucket").where(F.col("cid") != F.col("centre.cid"))
    around = around.select(F.col("cid").alias("a"), F.col("centre.cid").alias("b"), F.col("n").alias("na"), F.col("centre.n").alias("nb"), F.col("signature").alias("sa"), F.col("centre.signature").alias("sb"))
    ends = twos.select(F.col("high").alias("a"), F.col("low").alias("b")).distinct().join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
    most = F.lit(DISTANCE).cast("long").alias("most")
    stars = stored(with_distance(around.unionByName(ends).select("*", most), num, den).distinct(), "stars")
    heavy = stars.join(weight.withColumnRenamed("cid", "b"), "b", "left").select("a", F.struct(F.coalesce("weight", F.lit(0)).alias("weight"), (-F.col("distance")).alias("near"), "b").alias("x"))
    nearest = heavy.groupBy("a").agg(F.max("x").alias("x")).select(F.col("a").alias("cid"), F.col("x.b").alias("home"), (-F.col("x.near")).alias("distance"))
    alone = stars.select(F.col("b").alias("cid")).distinct().join(nearest, "cid", "left_anti")
    homes = stored(nearest.union(alone.select("cid", F.col("cid").alias("home"), F.lit(0).cast("long").alias("distance"))), "homes")
    sized = classes.select("cid", "n")
    sets = full_sets(docs, key, text, width, classes, homes.select("cid"))
    grouped = homes.join(sized, "cid").select("cid", "home", F.col("cid").alias("part"), "n")
    own = homes.select(F.col("home").alias("cid")).distinct().join(sized, "cid").select("cid", F.col("cid").alias("home"), F.col("cid").alias("part"), "n")
    links = stored(group_links(grouped, own, sets, num, den), "links")
    joined = stored(connected_components(links), "parts")

    # Buckets that still hold several components: all but the largest against the homes met there.
    weights = joined.groupBy("component").agg(F.count("*").alias("weight"))
    placed = homes.join(joined.join(weights, "component").withColumnRenamed("node", "cid"), "cid", "left")
    placed = placed.select("cid", "home", F.coalesce("component", "cid").alias("part"), F.coalesce("weight", F.lit(1)).alias("weight"))
    rows = members.select("bucket", "cid").union(twos.select("bucket", F.explode(F.array("low", "high")).alias("cid")))
    rows = rows.join(placed, "cid", "left").select(
        "bucket", "cid", F.coalesce("home", "cid").alias("home"), F.coalesce("part", "cid").alias("part"), F.coalesce("weight", F.lit(1)).alias("weight")
    )
    # Buckets of the same classes, told by their number and 128 bits, ask the same: one of them is enough.
    held = [F.count("*").alias("size"), F.bit_xor(F.xxhash64("cid")).alias("h1"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("h2")]
    mixed_buckets = rows.groupBy("bucket").agg(
        F.min("part").alias("p"), F.max("part").alias("q"), F.max(F.struct("weight", "part"))["part"].alias("main"), *held
    )
    differing = mixed_buckets.where("p < q").groupBy("size", "h1", "h2").agg(F.min(F.struct("bucket", "main")).alias("one"))
    rows = stored(rows.join(differing.select("one.bucket", "one.main"), "bucket"), "open")
    # A link lies within DISTANCE of a member, and the member within its home's radius.
    radius = homes.groupBy("home").agg((F.max("distance") + DISTANCE).alias("most"))
    met = rows.groupBy("bucket", F.col("home").alias("cid")).agg(F.min("part").alias("p"), F.max("part").alias("q"))
    met = met.join(radius.withColumnRenamed("home", "cid"), "cid", "left").withColumn("most", F.coalesce("most", F.lit(DISTANCE).cast("long")))
    signed_classes = classes.select("cid", "n", "signature")
    asking = rows.where("part <> main").select("bucket", "cid", "part").join(signed_classes, "cid")
    asking = stored(near_homes(met.join(signed_classes, "cid"), asking, num * num, den * den).distinct(), "asking")
    # Classes without a home near enough are homes of themselves.
    known = placed.select("cid", "home", "part")
    asked_of = asking.select(F.col("b").alias("cid")).distinct()
    own = asked_of.join(homes, "cid", "left_anti").select("cid", F.col("cid").alias("home"), F.col("cid").alias("part"))
    grouped = known.union(own).join(asked_of.withColumnRenamed("cid", "home"), "home", "left_semi").join(sized, "cid").select("cid", "home", "part", "n")
    asked = asking.select(F.col("a").alias("cid"), F.col("b").alias("home"), "part", "n")
    missing = asked.select("cid").union(own.select("cid")).distinct().join(homes, "cid", "left_anti")
    sets = sets.union(full_sets(docs, key, text, width, classes, missing))
    every = links.union(group_links(stored(grouped, "groups"), asked, sets, num, den))
    final = stored(connected_components(every), "components")

    named = classes.join(final, classes["cid"] == final["node"], "left").select("h1", "h2", "rep", F.coalesce("component", "cid").alias("part"))
    lowest = named.groupBy("part").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "part").select("h1", "h2", "component_id")
    result = signed.select("key", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "key")
    return result.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), (F.col("key") == component).alias("kept"))


def one_of_each(docs: DataFrame, key: str, text: str, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near duplicates keeps its smallest key.

    Each row is a document of its own, whatever other rows have its key. Null keys come last; of rows
    with one key the smallest by a hash of its columns stays. Rows without words all stay.
    """
    numbered = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    found = near_duplicates(numbered.select("row", F.col("doc").getField(text).alias("text")), "row", "text", width, num, den)
    own = F.col("doc").getField(key)
    place = F.struct(own.isNull().alias("no_key"), own.alias("key"), F.xxhash64("doc").alias("hash"), "row")
    placed = stored(found.select("row", "component_id").join(numbered.select("row", place.alias("place")), "row"), "places")
    first = placed.groupBy("component_id").agg(F.min("place")["row"].alias("row"))
    others = stored(placed.select("row").join(first.select("row"), "row", "left_anti"), "others")
    return numbered.join(small(others, 24), "row", "left_anti").select("doc.*")
