"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned onto their principal axes, so the leading coordinates carry most of a product.
Vectors are dealt into tiles along the first axis. Two tiles are compared only if their stretches are
near enough for the threshold, and within a pair of tiles the product over the leading coordinates plus
the product of the norms of the rest bounds the cosine; most pairs stop there. What is left is
computed on the given vectors in double precision.

Equal vectors are one class before any comparison, and a pair of tiles returns link counts and edges
that span its links, not the links, so dense groups cost arithmetic but no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import parts, ship, small, stored
from seriesloom.llm.components import connected_components, spanning
from seriesloom.llm.vectors import matrix, prepared_vectors

ship(__name__)

TILE = 8192
STRIP = 1024
LEADING = 16
SLACK = 1e-4  # above what single precision can be off by


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the axes of the unit vectors' second moments, largest first, as columns.

    Each task sums its products; length squared sums per length reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.array(batch.column(0).to_pylist(), dtype=np.int64)
            raw = batch.column(1).to_pylist()
            for dim in np.unique(dims).tolist():
                x = matrix([raw[i] for i in np.flatnonzero(dims == dim)], dim)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                sums[dim] = sums.get(dim, 0.0) + x.T @ x
        for dim, total in sums.items():
            at = np.arange(dim * dim, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dim * dim, dim, dtype=np.int32)), pa.array(at), pa.array(total.ravel())], names=["dim", "at", "value"])

    moments = classes.select("dim", "vector").mapInArrow(run, "dim int, at long, value double")
    axes = {}
    for row in moments.groupBy("dim", "at").agg(F.sum("value").alias("value")).collect():
        axes.setdefault(row["dim"], np.zeros(row["dim"] ** 2))[row["at"]] = row["value"]
    return {dim: np.ascontiguousarray(np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1]) for dim, m in axes.items()}


def tiled(classes: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """``classes`` with their place on the first axis and a ``tile`` of at most about ``TILE`` rows.

    Tiles are stretches of the first axis; a stretch that holds more, by ties, is split by hash.
    """
    first = {dim: a[:, 0].copy() for dim, a in axes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), batch.column(3).to_pylist())
            place = [float(np.frombuffer(v) @ first[dim]) / norm for dim, v, norm in raw]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.float64())], names=[*batch.schema.names, "place"])

    kinds = "cid long, dim int, n long, norm double, vector binary, place double"
    placed = stored(classes.select("cid", "dim", "n", "norm", "vector").mapInArrow(run, kinds), "placed")
    sizes = {r["dim"]: r["rows"] for r in placed.groupBy("dim").agg(F.count("*").alias("rows")).collect()}
    stretch = F.lit(0)
    for dim, rows in sizes.items():
        count = parts(rows, TILE)
        if count > 1:
            marks = [i / count for i in range(1, count)]
            cuts = placed.where(F.col("dim") == dim).agg(F.percentile_approx("place", marks, 10000)).first()[0]
            number = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("place")))
            stretch = F.when(F.col("dim") == dim, number).otherwise(stretch)
    placed = placed.withColumn("stretch", stretch)
    split = placed.groupBy("dim", "stretch").agg(F.ceil(F.count("*") / F.lit(1.25 * TILE)).alias("pieces"))
    placed = placed.join(small(split, 48), ["dim", "stretch"])
    part = F.pmod(F.xxhash64("cid"), F.col("pieces"))
    return placed.select("cid", "dim", "n", "norm", "vector", "place", F.concat_ws("-", "dim", "stretch", part).alias("tile"))


def tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """``pair``, ``side`` and ``tile`` for all pairs of tiles that can hold a link, each with itself too.

    Unit vectors with cosine ``threshold`` lie ``sqrt(2 - 2 threshold)`` apart at most, on any axis.
    Tiles meet through cells of that width, so far tiles are never paired.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    spans = tiles.groupBy("dim", "tile").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    cell = [F.floor(F.col(c) / reach).cast("long") for c in ("low", "high")]
    left = spans.select("dim", F.col("tile").alias("a"), "high", F.col("low").alias("la"), F.explode(F.sequence(cell[0] - 1, cell[1] + 1)).alias("cell"))
    right = spans.select("dim", F.col("tile").alias("b"), F.col("high").alias("hb"), F.col("low").alias("lb"), F.explode(F.sequence(*cell)).alias("cell"))
    near = (F.col("a") <= F.col("b")) & (F.col("lb") <= F.col("high") + reach) & (F.col("la") <= F.col("hb") + reach)
    pairs = left.join(right, ["dim", "cell"]).where(near).select("a", "b").distinct().withColumn("pair", F.monotonically_increasing_id())
    pairs = stored(pairs, "tile-pairs")
    sides = pairs.select("pair", F.lit(0).alias("side"), F.col("a").alias("tile"))
    return sides.union(pairs.where("a <> b").select("pair", F.lit(1).alias("side"), F.col("b").alias("tile")))


def compare_tiles(a: dict, b: dict, same: bool, axes: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per strip of ``a``: rows, link counts of rows and of all of ``b``, and spanning links."""
    lead = min(LEADING, axes.shape[0])
    ends = []
    for side in (a, b):
        turned = (side["x"] / side["norm"][:, None]) @ axes
        rest = np.sqrt(np.maximum(0.0, (turned[:, lead:] ** 2).sum(axis=1)))
        ends.append(np.column_stack([turned[:, :lead], rest]).astype(np.float32))
    for at in range(0, len(a["x"]), STRIP):
        rows = np.arange(at, min(at + STRIP, len(a["x"])))
        mask = ends[0][rows] @ ends[1].T >= threshold - SLACK
        if same:
            mask &= rows[:, None] < np.arange(len(b["x"]))
        i, j = np.nonzero(mask)
        if not len(i):
            continue
        if len(i) > mask.size // 50:
            cosine = (a["x"][rows] @ b["x"].T) / (a["norm"][rows, None] * b["norm"])
            close = mask & (np.abs(cosine - threshold) < 1e-9)
            mask &= cosine >= threshold
            i, j = np.nonzero(close)
        else:
            mask[:] = False
        for k in range(0, len(i), 1 << 16):
            r, c = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            products = (a["x"][rows[r]] * b["x"][c]).sum(axis=1)
            mask[r, c] = products / (a["norm"][rows[r]] * b["norm"][c]) >= threshold
        if mask.any():
            r, c = spanning(mask)
            yield rows, mask @ b["n"], mask.T @ a["n"][rows], np.column_stack([rows[r], c])


def near_duplicate_vectors(table: DataFrame, key: str, vector: str, threshold: float = 0.9) -> DataFrame:
    """``key``, ``n_links`` (rows linked directly), ``component_id`` (smallest key reachable), ``kept``.

    Rows are linked at cosine ``threshold`` or above. Vectors that are null, empty or zero or hold null
    or non-finite components link with nothing, as do vectors of unlike length. Repeated rows link as
    any others and share their key's result. Rows with a null key are left out; other columns are
    too; an empty table gives no rows. The threshold must lie above 0.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must lie above 0, and be 1 at most")
    rows = stored(prepared_vectors(table.where(F.col(key).isNotNull()), key, vector), "vectors")
    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("key").alias("rep"), F.count("*").alias("n"), F.first("dim").alias("dim"), F.first("norm").alias("norm"), F.first("vector").alias("vector")
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    axes = principal_axes(classes)
    tiles = stored(tiled(classes, axes), "tiles")
    pairs = tile_pairs(tiles, threshold)

    def blob(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cid")
        numbers = [group[c].to_numpy(dtype=t).tobytes() for c, t in (("cid", "i8"), ("n", "i8"), ("norm", "f8"))]
        return pd.DataFrame({"tile": [group["tile"].iloc[0]], "dim": [group["dim"].iloc[0]], "cids": numbers[:1], "ns": numbers[1:2], "norms": numbers[2:], "vectors": [b"".join(group["vector"])]})

    blobs = tiles.drop("place").groupBy("tile").applyInPandas(blob, "tile string, dim int, cids binary, ns binary, norms binary, vectors binary")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for r in group.sort_values("side").itertuples():
            cids, n, norm = np.frombuffer(r.cids, "i8"), np.frombuffer(r.ns, "i8"), np.frombuffer(r.norms, "f8")
            sides.append({"x": np.frombuffer(r.vectors, "f8").reshape(len(cids), r.dim), "cid": cids, "n": n, "norm": norm})
        a, b = sides[0], sides[-1]
        counts = [np.zeros(len(s["cid"]), dtype=np.int64) for s in (a, b)]
        edges = [np.zeros((0, 2), dtype=np.int64)]
        for at, of_a, of_b, linked in compare_tiles(a, b, len(sides) == 1, axes[a["x"].shape[1]], threshold):
            counts[0][at] += of_a
            counts[1] += of_b
            edges.append(linked)
        edge = np.concatenate(edges)
        has = [np.flatnonzero(c) for c in counts]
        ids = [a["cid"][has[0]], b["cid"][has[1]], a["cid"][edge[:, 0]]]
        added = np.concatenate([counts[0][has[0]], counts[1][has[1]], np.zeros(len(edge), dtype=np.int64)])
        to = np.concatenate([np.full(len(has[0]) + len(has[1]), -1), b["cid"][edge[:, 1]]])
        return pd.DataFrame({"cid": np.concatenate(ids), "added": added, "to": to})

    found = pairs.join(blobs, "tile").groupBy("pair").applyInPandas(compare, "cid long, added long, to long")
    found = stored(found, "vector-links")
    links = found.where("to < 0").groupBy("cid").agg(F.sum("added").alias("links"))
    joined = connected_components(found.where("to >= 0").select(F.col("cid").alias("a"), F.col("to").alias("b")))
    named = classes.select("cid", "digest", "rep", "n").join(joined, classes["cid"] == joined["node"], "left").withColumn("part", F.coalesce("component", "cid"))
    lowest = named.groupBy("part").agg(F.min("rep").alias("component_id"))
    named = named.join(lowest, "part").join(links, "cid", "left").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    component = F.coalesce("component_id", "key")
    return rows.select("key", "digest").join(named, "digest", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("key") == component).alias("kept"),
    )
