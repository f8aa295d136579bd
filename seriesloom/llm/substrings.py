"""Removal of repeated passages by suffix arrays over shards that share content.

Every window of ``length`` bytes picks its anchor, the leftmost of its smallest runs of ``ANCHOR`` bytes by
hash, from its content alone. Windows in a row with one anchor make a segment, so each window lies in
exactly one segment and equal windows lie in segments of equal anchors. Segments whose anchor occurs once
cannot hold a repeat. The others are collapsed to distinct ones with a weight and dealt into shards by
anchor. Each shard has its suffix array induced and its common prefixes computed; a window is repeated
when the windows equal to it have a weight of two or more.

An anchor with more segments than a shard holds is split: its windows are parted by how far they start
before the anchor, and each part is known by all the bytes that its windows share. At last a part is one
window, of which only the weight is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import batches, parts, ship, small, stored
from seriesloom.llm.suffixes import common_prefixes, suffix_array
from seriesloom.llm.words import mixed

ship(__name__)

ANCHOR = 64
#: Bytes of distinct segments in a shard, and the most that one anchor may have before it is split.
SHARD_BYTES = 1 << 20
#: Windows of a segment, at most; only texts of a short period reach it.
SEGMENT_WINDOWS = 4096
PIECE_BYTES = 1 << 22
SPLIT = 4
_RNG = np.random.default_rng(12)
VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))


def run_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` bytes in a row."""
    n = len(raw)
    powers = np.full(n, STEP, dtype=np.uint64)
    back = np.full(n, INVERSE, dtype=np.uint64)
    powers[0] = back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(VALUES[raw] * powers, out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * back[: n - width + 1])


def window_anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of ``length`` bytes the position of its anchor; and the hash at every position.

    ``raw`` has at least ``length`` bytes.
    """
    width = min(ANCHOR, length)
    hashes = run_hashes(raw, width)
    span = length - width + 1
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    # Smallest of every ``span`` in a row: the end of one block and the beginning of the next.
    blocks = -(-len(ranked) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(ranked)] = ranked
    table = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(raw) - length + 1
    lowest = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
    return (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes


def segments(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and anchor hash of the segments of a text, a piece at a time.

    Last, the number of anchors of that hash in the segment.
    """
    starts, windows, keys, counts = [], [], [], []
    for at in range(0, len(data) - length + 1, PIECE_BYTES):
        raw = np.frombuffer(data[at : at + PIECE_BYTES + length - 1], dtype=np.uint8)
        anchors, hashes = window_anchors(raw, length)
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        key = hashes[anchors[first]]
        # Neighbours of one hash, as in a text of a short period, are one segment.
        run = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        of = np.repeat(first[run], np.diff(np.append(run, len(first))))
        lot = (first - of) // SEGMENT_WINDOWS
        begins = np.concatenate([[True], (key[1:] != key[:-1]) | (lot[1:] != lot[:-1])])
        counts.append(np.diff(np.append(np.flatnonzero(begins), len(first))))
        first = first[begins]
        starts.append(first + at)
        windows.append(np.diff(np.append(first, len(anchors))))
        keys.append(key[begins])
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    return np.concatenate(starts), np.concatenate(windows), np.concatenate(keys).astype(np.int64), np.concatenate(counts)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def text_segments(rows: DataFrame, length: int) -> DataFrame:
    """``tid``, ``start``, ``windows``, ``anchor`` and ``anchors`` of every segment of ``rows`` (``tid``, ``text``, ``row``).

    ``anchors`` is how many of that hash it holds, and ``place`` a number of its own.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            table = pa.table([batch.column(0), batch.column(1).cast(pa.large_binary()), batch.column(2)], names=["tid", "text", "row"])
            for a, b in batches(table, PIECE_BYTES, "text"):
                some = table.slice(a, b - a)
                found = [segments(t, length) for t in some.column("text").to_pylist()]
                counts = np.array([len(f[0]) for f in found])
                start, windows, key, many = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in range(4))
                own = mixed(np.repeat(some.column("row").to_numpy().astype(np.uint64), counts))
                place = mixed(own + start.astype(np.uint64)).astype(np.int64)
                tid = some.column("tid").combine_chunks().take(pa.array(np.repeat(np.arange(len(found)), counts)))
                yield pa.RecordBatch.from_arrays([tid, *map(pa.array, (start, windows, key, many, place))], names=["tid", "start", "windows", "anchor", "anchors", "place"])

    return rows.select("tid", "text", "row").mapInArrow(run, "tid binary, start long, windows long, anchor long, anchors long, place long")


def cut_segments(rows: DataFrame, length: int) -> DataFrame:
    """``tid``, ``start``, ``anchor``, ``digest`` and ``bytes`` of the segments in ``wanted`` of each ``text``."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            texts = batch.column(1).cast(pa.large_binary())
            for i, wanted in enumerate(batch.column(2).to_pylist()):
                text = texts[i].as_py()
                for some in (wanted[k : k + 8192] for k in range(0, len(wanted), 8192)):
                    data = [text[w["start"] : w["start"] + w["windows"] + length - 1] for w in some]
                    columns = [pa.array([w[c] for w in some], pa.int64()) for c in ("start", "anchor")]
                    tid = pa.array([batch.column(0)[i].as_py()] * len(some), pa.binary())
                    yield pa.RecordBatch.from_arrays([tid, *columns, pa.array([_digest(d) for d in data], pa.binary()), pa.array(data, pa.binary())], names=["tid", "start", "anchor", "digest", "bytes"])

    return rows.select("tid", "text", "wanted").mapInArrow(run, "tid binary, start long, anchor long, digest binary, bytes binary")


def split_segments(rows: DataFrame, length: int, span: int) -> DataFrame:
    """Parts of the segments ``rows`` whose windows start in one range of ``span`` places before the anchor.

    Columns: the part's ``anchor``, ``digest`` and ``bytes``, its ``weight``, and the ``parent`` it starts in
    at ``start``. The new anchor hashes the old one, the range and all bytes its windows share.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            out = []
            for anchor, parent, data, weight in zip(*(c.to_pylist() for c in batch.columns)):
                places, _ = window_anchors(np.frombuffer(data, dtype=np.uint8), length)
                lead = (places - np.arange(len(places))) // span
                begins = np.flatnonzero(np.concatenate([[True], (places[1:] != places[:-1]) | (lead[1:] != lead[:-1])]))
                for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(places)]):
                    at, low = int(places[a]), int(lead[a]) * span
                    common = data[at - low : at - low - span + 1 + length]
                    name = _digest(b"%d:%d:%d:" % (anchor, span, low) + common)
                    part = data[a : b + length - 1]
                    out.append((int.from_bytes(name[:8], "little", signed=True), _digest(part), part, weight, parent, a))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "digest", "bytes", "weight", "parent", "start"])

    return rows.select("anchor", "digest", "bytes", "weight").mapInArrow(run, "anchor long, digest binary, bytes binary, weight long, parent binary, start long")


def repeated_windows(data: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment number, first and behind the last window of the runs of windows that occur twice or more.

    The segments stand in one string, each closed by a symbol below all bytes.
    """
    sizes = np.array([len(d) for d in data])
    ends = np.cumsum(sizes + 1)
    string = np.ones(int(ends[-1]) + 1, dtype=np.uint16)
    string[-1] = 0
    closing = np.zeros(len(string), dtype=bool)
    closing[ends - 1] = closing[-1] = True
    string[~closing] = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.uint16) + 2
    order = suffix_array(string, 258)
    shared = common_prefixes(string, order)[order]
    firsts = ends - sizes - 1
    owner = np.repeat(np.arange(len(data)), sizes + 1)
    place = np.arange(len(owner)) - firsts[owner]
    whole = place <= (sizes - length)[owner]
    value = np.append(np.where(whole, weights[owner], 0), 0)
    groups = np.flatnonzero(shared < length)
    totals = np.add.reduceat(value[order], groups)
    many = np.zeros(len(string), dtype=bool)
    many[order] = np.repeat(totals >= 2, np.diff(np.append(groups, len(order))))
    many = many[:-1] & whole
    # The last windows of a segment are always followed by places that are none.
    edges = np.flatnonzero(np.diff(many.astype(np.int8), prepend=0, append=0))
    a, b = edges[::2], edges[1::2]
    return owner[a], place[a], place[b - 1] + 1


def shard_windows(rows: DataFrame, length: int) -> DataFrame:
    """``digest``, ``a`` and ``b``: the repeated windows of ``rows`` (``anchor``, ``digest``, ``bytes``, ``weight``)."""
    total = rows.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = parts(total, SHARD_BYTES)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        of, a, b = repeated_windows(list(group["bytes"]), group["weight"].to_numpy(dtype=np.int64), length)
        return pd.DataFrame({"digest": group["digest"].to_numpy(dtype=object)[of], "a": a, "b": b})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, "digest binary, a long, b long")


def distinct_segments(rows: DataFrame) -> DataFrame:
    """One row per ``digest`` with its ``anchor``, ``bytes`` and summed ``weight``."""
    return rows.groupBy("digest").agg(F.first("anchor").alias("anchor"), F.first("bytes").alias("bytes"), F.sum("weight").alias("weight"))


def segment_windows(distinct: DataFrame, length: int) -> DataFrame:
    """``digest``, ``a`` and ``b``: the repeated windows of all segments, those of large anchors by parts."""
    spans = [length]
    while spans[-1] > 1:
        spans.append(-(-spans[-1] // SPLIT))
    found, links = [], []
    for span in spans[1:]:
        sizes = distinct.groupBy("anchor").agg(F.sum(F.octet_length("bytes")).alias("size"))
        large = stored(sizes.where(F.col("size") > SHARD_BYTES).select("anchor"), "large")
        if large.isEmpty():
            break
        found.append(stored(shard_windows(distinct.join(small(large, 16), "anchor", "left_anti"), length), "windows"))
        split = stored(split_segments(distinct.join(small(large, 16), "anchor", "left_semi"), length, span), "split")
        links.append(split.select(F.col("digest").alias("part"), "parent", "start"))
        distinct = stored(distinct_segments(split), "parts")
    out = stored(shard_windows(distinct, length), "windows")
    for link, own in zip(reversed(links), reversed(found)):
        up = link.join(out, link["part"] == out["digest"]).select(F.col("parent").alias("digest"), (F.col("a") + F.col("start")).alias("a"), (F.col("b") + F.col("start")).alias("b"))
        out = stored(up.union(own), "windows")
    return out


def _without(rows: DataFrame, key: str, kind: str, length: int) -> DataFrame:
    """Removes the windows in ``spans`` from ``text``."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables:
            texts, out = batch.column(1).cast(pa.large_binary()), []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                text, merged = texts[i].as_py(), []
                for a, b in sorted((s["a"], s["b"] + length - 1) for s in spans or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                bounds = [0, *(x for m in merged for x in m), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                out.append((len(text), len(text) - len(kept), [{"start": a, "end": b} for a, b in merged], kept))
            columns = list(zip(*out)) if out else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[key, "n_bytes", "n_removed", "spans", "kept"])

    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")


def without_repeats(docs: DataFrame, key: str, text: str, length: int = 400) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, the removed ``spans`` and the ``kept`` bytes of every row.

    Every byte is removed that lies in a string of ``length`` bytes which starts anywhere else too, in the
    same text or in another row; overlaps count, and no string reaches from one text into the next. Texts
    are read as UTF-8 bytes, so what is kept may end within a character. Null texts count as empty.
    Repeated rows repeat each other's whole text; keys, null ones included, are carried only; other columns
    are left out. Texts of any length are read whole, in pieces; an empty table gives no rows.
    """
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).alias("key"), data.alias("text"))
    # Rows of equal texts share their fate, so a text goes by 128 bits of its SHA-256.
    rows = rows.withColumn("tid", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))
    long_rows = rows.where(F.octet_length("text") >= length)
    found = stored(text_segments(long_rows.withColumn("row", F.monotonically_increasing_id()), length), "segments")
    anchors = found.groupBy("anchor").agg(F.min("place").alias("low"), F.max("place").alias("high"), F.max("anchors").alias("most"))
    anchors = stored(anchors.where("low < high or most > 1").select("anchor"), "anchors")
    wanted = found.select("tid", "start", "windows", "anchor").join(small(anchors, 16), "anchor", "left_semi")
    wanted = stored(wanted.groupBy("tid").agg(F.collect_set(F.struct("start", "windows", "anchor")).alias("wanted")), "wanted")
    again = long_rows.select("tid", "text").join(small(wanted.select("tid"), 40), "tid", "left_semi").join(wanted, "tid")
    cut = stored(cut_segments(again, length), "cut")
    distinct = stored(distinct_segments(cut.withColumn("weight", F.lit(1).cast("long"))), "distinct")
    windows = segment_windows(distinct, length)
    places = cut.select("digest", "tid", "start").distinct().join(windows, "digest")
    spans = places.groupBy("tid").agg(F.collect_set(F.struct((F.col("a") + F.col("start")).alias("a"), (F.col("b") + F.col("start")).alias("b"))).alias("spans"))
    spans = stored(spans, "spans")
    size = spans.agg(F.sum(F.size("spans") * 16 + 64)).first()[0] or 0
    joined = rows.join(F.broadcast(spans) if size <= 16 << 20 else spans, "tid", "left")
    return _without(joined.select("key", "text", "spans"), key, docs.schema[key].dataType.simpleString(), length)
