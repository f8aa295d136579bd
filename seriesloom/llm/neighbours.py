"""Approximate nearest neighbours by cross-polytope hashing.

A fast pseudo-rotation (three rounds of random signs and a Hadamard transform) turns a unit vector, and
the signed axis nearest to it is its bucket. Every table has a rotation of its own and holds every
row. A query looks into the buckets of its nearest signed axes in each table and ranks what it finds
by the inner product of the given vectors in double precision. The k-th best of it bounds the cosine
that a better row of a given norm needs; rows lie in bands of norms, and in each band the query goes on
through as many buckets as rows of that cosine ask for, or through all rows where that is less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import ship, small, stored
from seriesloom.llm.vectors import matrix, prepared_vectors

ship(__name__)

BLOCK = 4096
#: Steps and pairs of the measured table of probes, and the share of near rows that the probes are to find.
STEPS, PAIRS, FOUND = 32, 400, 0.97
#: Number of the bucket that stands for all rows of a band, and the ratio of norms within a band.
WHOLE, RATIO = -1, 1.1


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of every row; the row length is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(rows, width // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def signed_axes(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Products of the rotated rows with every signed axis: first all positive axes, then all negative."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    signs = np.random.default_rng([seed, table, width]).choice([-1.0, 1.0], (3, width))
    turned = np.zeros((len(x), width))
    turned[:, : x.shape[1]] = x
    for s in signs:
        turned = hadamard(turned * s)
    return np.concatenate([turned, -turned], axis=1)


def probes_needed(dim: int, tables: int, seed: int) -> np.ndarray:
    """How many buckets of every table to look into for rows at a cosine of 0, 1/STEPS, 2/STEPS ..:
    so many that of ``PAIRS`` random pairs at that cosine the share ``FOUND`` meets in some table."""
    rng = np.random.default_rng([seed, dim])
    x, y = rng.normal(size=(2, PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    cosines = np.arange(STEPS) / STEPS
    ranks = np.full((STEPS, PAIRS), 1 << 62)
    for table in range(tables):
        turned, across = signed_axes(x, table, seed), signed_axes(y, table, seed)
        axis = turned.argmax(axis=1)[:, None]
        for i, c in enumerate(cosines):
            near = c * turned + np.sqrt(1 - c * c) * across
            ranks[i] = np.minimum(ranks[i], (near > np.take_along_axis(near, axis, axis=1)).sum(axis=1) + 1)
    needed = np.quantile(ranks, FOUND, axis=1, method="higher")
    return np.maximum.accumulate(needed[::-1])[::-1]


def bucket_rows(rows: DataFrame, tables: int, seed: int, low: int, high: int, bands: dict[int, list[tuple[int, float]]] | None = None) -> DataFrame:
    """``bucket``, ``band``, ``id``, ``dim`` and ``vector``: each row for its nearest axes from number
    ``low`` to before ``high`` in each table.

    With ``bands`` (by length: each band and its largest norm) rows are queries and their ``bound`` the
    score to beat: each row for the axes from ``low`` on that each band needs, or once for the bucket
    ``WHOLE`` where all rows of the band are no more work or there is no bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needs: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, dims, raw = batch.column(0), np.array(batch.column(1).to_pylist(), dtype=np.int64), batch.column(3)
            norms, own, bounds = (np.array(batch.column(c).to_pylist(), dtype=np.float64) for c in (2, 4, 5))  # null is nan

            def out(at: np.ndarray, bucket: np.ndarray, band: np.ndarray, dim: int) -> pa.RecordBatch:
                of = pa.array(at)
                columns = [pa.array(bucket.astype(np.int64)), pa.array(band.astype(np.int32)), ids.take(of), pa.array(np.full(len(at), dim, dtype=np.int32)), raw.take(of)]
                return pa.RecordBatch.from_arrays(columns, names=["bucket", "band", "id", "dim", "vector"])

            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                axes = 2 << max(0, dim - 1).bit_length()
                wanted = [(own[at], np.full(len(at), min(high, axes)))]
                if bands is not None:
                    wanted = []
                    if dim not in needs:
                        needs[dim] = probes_needed(dim, tables, seed)
                    for band, top in bands.get(dim, ()):
                        cosine = bounds[at] / (norms[at] * top)
                        known = cosine > 0
                        step = np.where(known, np.minimum(np.floor(np.where(known, cosine, 0) * STEPS), STEPS - 1), 0).astype(np.int64)
                        probes = np.where(cosine > 1 + 1e-9, 0, np.minimum(needs[dim][step], axes))
                        whole = ~known | (tables * probes >= axes)
                        yield out(at[whole], np.full(whole.sum(), WHOLE), np.full(whole.sum(), band), dim)
                        wanted.append((np.full(len(at), band), np.where(whole, 0, probes)))
                if not any((count > low).any() for _, count in wanted):
                    continue
                x = matrix([raw[int(i)].as_py() for i in at], dim) / norms[at][:, None]
                for table in range(tables):
                    near = signed_axes(x, table, seed)
                    nearest = near.argmax(axis=1)[:, None] if high == 1 and bands is None else np.argsort(-near, axis=1, kind="stable")
                    for band, count in wanted:
                        number = np.arange(nearest.shape[1])
                        r, c = np.nonzero((number >= low) & (number < count[:, None]))
                        yield out(at[r], table * axes + nearest[r, c], band[r], dim)

    return rows.select("key", "dim", "norm", "vector", "band", "bound").mapInArrow(run, "bucket long, band int, id long, dim int, vector binary")


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Which of a query's rounded scores may be among its ``k`` best once they are exact."""
    scores = np.where(own, -np.inf, scores)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        slack = 1e-9 * max(1.0, abs(least)) if np.isfinite(least) else 0.0
        return np.flatnonzero((scores >= least - slack) & ~own)
    return np.flatnonzero(~own)


def found_in_buckets(index: DataFrame, queries: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """``query_id``, ``id``, ``score``: each query's ``k`` best in every bucket it looks into.

    ``keys`` say what a bucket is, the vectors' length among them. A bucket is cut by hash into blocks of about ``BLOCK`` rows and ``BLOCK`` queries, from counts, so
    that a common vector or a common query does not meet in one task.
    """
    blocks = [x.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias(n)) for x, n in ((index, "rows_in"), (queries, "queries_in"))]
    sizes = small(stored(blocks[0].join(blocks[1], keys), "blocks"), 48)
    number = F.pmod(F.xxhash64("id"), F.col("rows_in")).alias("r"), F.pmod(F.xxhash64("id"), F.col("queries_in")).alias("q")
    every = [F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias(a) for n, a in (("queries_in", "q"), ("rows_in", "r"))]
    rows = index.join(sizes, keys).select(*keys, "id", "vector", number[0], every[0])
    asked = queries.join(sizes, keys).select(*keys, "id", "vector", number[1], every[1])

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        of, found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            x, ids = matrix(list(left["vector"]), dim), left["id"].to_numpy()
            y, query_ids = matrix(list(right["vector"]), dim), right["id"].to_numpy()
            for a in range(0, len(y), 256):
                rough = y[a : a + 256] @ x.T
                for i in range(len(rough)):
                    query = query_ids[a + i]
                    near = _best(rough[i], ids == query, k)
                    exact = (x[near] * y[a + i]).sum(axis=1)
                    chosen = np.lexsort((ids[near], -exact))[:k]
                    of.append(np.full(len(chosen), query))
                    found.append(ids[near][chosen])
                    scores.append(exact[chosen])
        return pd.DataFrame({"query_id": np.concatenate(of), "id": np.concatenate(found), "score": np.concatenate(scores)})

    group = [*keys, "r", "q"]
    return rows.groupBy(*group).cogroup(asked.groupBy(*group)).applyInPandas(run, "query_id long, id long, score double")


def nearest_neighbours(
    table: DataFrame, key: str, vector: str, is_query, k: int = 20, tables: int = 8, probes: int = 16, seed: int = 8
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` of each query's ``k`` nearest rows found.

    ``is_query`` is a condition on ``key``. Candidates are all rows but those with the query's own key;
    nearness is the largest inner product, ties go to the smaller key. The k-th best row found with
    ``tables`` times ``probes`` sets how many buckets are looked into in each band of norms, from a table
    measured for the vectors' length, so that any row of the true ``k`` best is found with a chance of
    about ``FOUND`` at least; the less structure and the more dimensions, the more rows are compared, up to
    all of them. A query that finds fewer than ``k`` is compared with every row, so it gets all there
    are. Vectors that are null, empty or zero or hold null or non-finite components take no part, nor do
    rows with a null key; vectors of another length are no candidates. Repeated keys are one query and
    one candidate each. No rows give no rows.
    """
    rows = prepared_vectors(table.where(F.col(key).isNotNull()), key, vector)
    band = F.floor(F.log("norm") / float(np.log(RATIO))).cast("int")
    rows = rows.where("vector is not null").withColumn("key", F.col("key").cast("long")).withColumn("band", band)
    rows = stored(rows.withColumn("bound", F.lit(None).cast("double")), "vectors")
    index = stored(bucket_rows(rows, tables, seed, 0, 1), "index")
    queries = rows.where(is_query(F.col("key")))
    asked = stored(bucket_rows(queries, tables, seed, 0, probes), "probes")
    found = stored(found_in_buckets(index, asked, k, ["dim", "bucket"]), "found")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")

    def ranked(pairs: DataFrame) -> DataFrame:
        once = pairs.repartition("query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    bounds = ranked(found).where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    bounded = queries.drop("bound").join(bounds, queries["key"] == bounds["query_id"], "left")
    bands: dict[int, list[tuple[int, float]]] = {}
    for r in rows.groupBy("dim", "band").agg(F.max("norm").alias("top")).collect():
        bands.setdefault(r["dim"], []).append((r["band"], r["top"]))
    more = stored(bucket_rows(bounded, tables, seed, probes, 0, bands), "more")
    whole, some = more.where(F.col("bucket") == WHOLE), more.where(F.col("bucket") != WHOLE)
    if some.take(1):
        found = found.union(found_in_buckets(index, some, k, ["dim", "band", "bucket"]))
    if whole.take(1):
        every = rows.select(F.col("key").alias("id"), "dim", "band", "vector")
        found = found.union(found_in_buckets(every, whole, k, ["dim", "band"]))
    return ranked(found).select("query_id", "rank", "id", "score")
