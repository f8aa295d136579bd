"""Joins of a large table with a lookup table whose size and key balance are not known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from seriesloom.session import materialise

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32
#: The commonest words of a table too large to broadcast: most rows and bytes, and levels per doubling of the count.
COMMON_ROWS, COMMON_BYTES = 400_000, 32 * 1024 * 1024
LEVELS = 8


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(ROW_OVERHEAD)
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, ArrayType):
            size = size + F.coalesce(F.size(field.name), F.lit(0)) * 8
        else:
            size = size + 8
    return size


def elements(df: DataFrame, keys: Sequence[str], array: Column, name: str) -> DataFrame:
    """One row per array element, none for an empty array.

    The outer form with a filter behind it: a plain explode makes the optimizer test the array for
    emptiness first, which works out an expensive array (a split or a pattern search) again.
    """
    return df.select(*keys, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def numbered_elements(df: DataFrame, keys: Sequence[str], array: Column, name: str, position: str = "pos") -> DataFrame:
    """As :func:`elements`, with the position from 0."""
    return df.select(*keys, F.posexplode_outer(array).alias(position, name)).where(F.col(position).isNotNull())


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table is small in rows and in bytes: one aggregate, nothing moves but the sums."""
    row = dim.agg(F.count("*").alias("n"), F.sum(_row_bytes(dim)).alias("bytes")).first()
    return row["n"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def sized(dim: DataFrame) -> DataFrame:
    """The table marked for broadcast if it is small enough; otherwise unmarked, for a shuffle join."""
    return F.broadcast(dim) if fits_broadcast(dim) else dim


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str,
    spread: Sequence[str],
    key_counts: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``facts`` to ``dim`` (one row per key) by broadcast if small, by a salted shuffle if not.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. ``spread`` names fact columns
    that differ between the rows of one key. ``key_counts(key, n)`` saves the counting pass when the
    caller has the counts at hand. ``dim`` is read twice: pass a stored or checkpointed table.
    """
    if fits_broadcast(dim, max_rows):
        return facts.join(F.broadcast(dim), key, how)
    return salted_join(facts, dim, key, how, spread, key_counts)


def word_lookup(
    docs: DataFrame,
    doc_id: str,
    words: Column,
    dim: DataFrame,
    key: str,
    how: str,
    key_counts: DataFrame | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(doc_id, pos, key, ...)``: every word of every document looked up in ``dim``.

    With a small ``dim`` the words are looked up where the texts are read, so only what is kept moves
    on: grouping the result by document sends one partial row per document. With a large one the commonest
    words, whether ``dim`` has them or not, are still looked up there, and the others go through
    :func:`salted_join`.
    """
    facts = numbered_elements(docs, [doc_id], words, key)
    if fits_broadcast(dim, max_rows):
        return facts.join(F.broadcast(dim), key, how)
    if key_counts is None:
        key_counts = materialise(facts.groupBy(key).agg(F.count("*").alias("n")))
    common = common_words(dim, key, key_counts)
    matched = {"inner": F.col("_in_dim"), "left_semi": F.col("_in_dim"), "left_anti": ~F.col("_in_dim"), "left": F.lit(True)}[how]
    near = facts.join(F.broadcast(common.where(matched)), key)
    rest = facts.join(F.broadcast(common.select(key)), key, "left_anti")
    far = salted_join(rest, dim, key, how, [doc_id, "pos"], key_counts.join(F.broadcast(common.select(key)), key, "left_anti"))
    return near.select(*far.columns).unionAll(far)


def common_words(dim: DataFrame, key: str, key_counts: DataFrame) -> DataFrame:
    """The commonest keys of ``key_counts`` with their columns of ``dim``, stored; ``_in_dim`` tells whether it has them.

    As many as ``COMMON_ROWS`` and ``COMMON_BYTES`` allow; keys are taken by levels of their count, of which
    there are a few hundred, so keys of equal counts stay together.
    """
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    marked = dim.withColumn("_in_dim", F.lit(True))
    known = key_counts.where(F.col(key).isNotNull()).select(key, level.alias("_level")).join(marked, key, "left")
    known = materialise(known.withColumn("_in_dim", F.coalesce("_in_dim", F.lit(False))))
    levels = known.groupBy("_level").agg(F.count("*").alias("n"), F.sum(_row_bytes(known)).alias("bytes")).orderBy(F.desc("_level")).collect()
    rows = size = 0
    least = None
    for found in levels:
        rows, size = rows + found["n"], size + found["bytes"]
        if rows > COMMON_ROWS or size > COMMON_BYTES:
            break
        least = found["_level"]
    return known.where(F.col("_level") >= F.lit(least).cast("int")).drop("_level")


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str,
    spread: Sequence[str],
    key_counts: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Shuffle join in which each hot key is spread over as many partitions as its rows would fill.

    A key is hot when it holds more rows than a mean partition, so there are fewer hot keys than
    ``partitions`` (the session's shuffle partitions) and fewer extra copies of their lookup rows:
    that bounds the broadcast of the hot keys and the growth of ``dim``. Null keys match nothing and
    are spread as well; every other key goes to one partition as in a plain join.
    """
    partitions = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if key_counts is None:
        key_counts = facts.groupBy(key).agg(F.count("*").alias("n"))
    mean = F.greatest(key_counts.agg(F.sum("n").alias("total")).scalar() / partitions, F.lit(1.0))
    hot = key_counts.where((F.col("n") > mean) & F.col(key).isNotNull()).select(key, F.ceil(F.col("n") / mean).cast("int").alias("_salts"))
    salts = F.when(F.col(key).isNull(), F.lit(partitions)).otherwise(F.coalesce("_salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), salts).cast("int")
    salted_facts = facts.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    every_salt = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_dim = dim.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(every_salt)).drop("_salts")
    return salted_facts.join(salted_dim, [key, "_salt"], how).drop("_salt")
