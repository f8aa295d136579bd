"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import ship, stored

ship(__name__)


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each vertex ``u``; counted with partial minima, so a hub is no burden."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``a``, ``b``).

    A round ties each node's larger neighbours to its smallest one, then each node's smaller
    neighbours to its smallest; edges that no longer change are stars around the answer. The number
    of rounds grows with the logarithm of the longest chain. Every round is written to the shared
    folder; the driver sees a count and a check sum. Self-links, repeated links and nulls are
    ignored; no edges give no rows.
    """
    kept = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = None
    while True:
        kept = stored(kept, "edges")
        count, mark = kept.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (count, mark) == state or not count:
            return kept.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                kept.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).groupBy("node").agg(F.min("component").alias("component"))
        state = (count, mark)
        both = kept.union(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(both).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        low = _lowest(large)
        small = large.join(low, "u")
        kept = (
            small.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(small.select("u", F.col("low").alias("v")))
            .where("u <> v")
            .distinct()
        )


def spanning(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of links that connect what all links of ``mask`` connect."""
    rows, cols = np.nonzero(mask)
    if len(rows) <= 4 * sum(mask.shape):
        return rows, cols
    # From one column after another, link the rows reached first, then the columns those reach first.
    out_r, out_c = [], []
    seen_r, seen_c = np.zeros(mask.shape[0], dtype=bool), ~mask.any(axis=0)
    for root in np.flatnonzero(~seen_c).tolist():
        if seen_c[root]:
            continue
        seen_c[root] = True
        front = np.array([root])
        while len(front):
            new_rows = np.flatnonzero(mask[:, front].any(axis=1) & ~seen_r)
            out_r.append(new_rows)
            out_c.append(front[mask[np.ix_(new_rows, front)].argmax(axis=1)])
            seen_r[new_rows] = True
            new_cols = np.flatnonzero(mask[new_rows].any(axis=0) & ~seen_c)
            out_r.append(new_rows[mask[np.ix_(new_rows, new_cols)].argmax(axis=0)] if len(new_cols) else new_cols)
            out_c.append(new_cols)
            seen_c[new_cols] = True
            front = new_cols
    return np.concatenate(out_r), np.concatenate(out_c)
