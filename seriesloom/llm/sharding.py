"""Sharding by jump consistent hashing, in DataFrame functions only.

A key's shard follows from the key and the number of shards alone. There is no ring and no table, and
one more shard takes rows only into itself, about one in ``shards + 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import stored

MULTIPLIER = 2862933555777941757  # of the published generator
LOW32 = 0xFFFFFFFF
CHUNK_BITS = 16


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """``(hi:lo * MULTIPLIER + 1) mod 2^64`` on 32-bit halves, so that no product overflows."""
    c_hi, c_lo = MULTIPLIER >> 32, MULTIPLIER & LOW32
    upper = F.shiftright(lo, 16) * F.lit(c_lo)
    lower = lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(c_lo)
    low = F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + lower + F.lit(1)
    carry = F.shiftright(upper, 16) + F.shiftright(low, 32)
    cross = hi * F.lit(c_lo & 0xFFFF) + F.shiftleft((hi * F.lit(c_lo >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (carry + cross + lo * F.lit(c_hi)).bitwiseAND(F.lit(LOW32)), low.bitwiseAND(F.lit(LOW32))


def jump(key: Column, shards: int) -> Column:
    """Struct of ``shard`` among ``shards`` and ``grown``, the shard among ``shards + 1``.

    Each jump goes at least one shard further, so ``shards`` steps always suffice; steps after the
    last jump leave the state as it is. The first jump past the end also tells where the key goes
    when one shard is added. A null key counts as 0.
    """
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to"),
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(LOW32)).alias("lo"),
    )

    def step(state: Column, _: Column) -> Column:
        hi, lo = _next_state(state["hi"], state["lo"])
        span = F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + F.lit(1)).cast("double")
        to = F.floor((state["to"] + F.lit(1)).cast("double") * span).cast("long")
        moved = F.struct(state["to"].alias("at"), to.alias("to"), hi.alias("hi"), lo.alias("lo"))
        return F.when(state["to"] >= F.lit(shards), state).otherwise(moved)

    def finish(state: Column) -> Column:
        grown = F.when(state["to"] == F.lit(shards), state["to"]).otherwise(state["at"])
        return F.struct(state["at"].cast("int").alias("shard"), grown.cast("int").alias("grown"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, finish)


def shard_rows(rows: DataFrame, key: str, shards: int, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row with ``shard``, ``grown_shard`` and a gapless ``slot`` per shard.

    Rows are numbered in chunks of consecutive input rows: a chunk's count per shard gives the offsets
    and each chunk is numbered on its own, so neither a shard nor a repeated key meets in one task.
    Slots follow the order of the input files; the same files read with the same split size give the
    same slots. Equal keys, repeated rows and null keys (0) share a shard, each with a slot of its
    own; an empty table gives no rows; columns not in ``keep`` are left out.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    held = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    placed = rows.select(*held, jump(F.col(key), shards).alias("place"))
    row = F.monotonically_increasing_id()
    placed = stored(placed.select("*", row.alias("row")), "shards").select(
        *(f"c{i}" for i in range(len(keep))), "place.*", "row", F.shiftright("row", CHUNK_BITS).alias("chunk")
    )
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("row"))
    return placed.join(offsets, ["shard", "chunk"]).select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)),
        "shard", (F.col("offset") + within - 1).cast("long").alias("slot"), F.col("grown").alias("grown_shard"),
    )
