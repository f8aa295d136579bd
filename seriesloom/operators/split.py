"""Exact seeded train/test splits that never sort the whole table.

Rows are ranked by ``md5(key | seed)``; the first ``ceil(n * fraction)`` ranks are the test part. The
rank cut is found in a few passes over the key column when the split is made: counts per hash prefix
name the one prefix in which the quota is reached (a longer prefix where that one is still large), and
only the rows of that prefix are ranked. The
result compares each row with the cut and adds no shuffle to the plan. The key must be unique.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesloom.operators.lookup import sized
from seriesloom.session import materialise

TEST_FRACTION = 0.25
VALID_FRACTION = 0.2
PREFIX_DIGITS = 4
HASH_DIGITS = 32
BUCKET_ROWS = 1_000_000


def key_hash(key: str, seed: int | str) -> Column:
    """Hash that ranks the rows; the same in any engine with md5."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def _part_sizes(n: Column, fraction: float) -> Column:
    return F.ceil(n * F.lit(fraction)).cast("long")


def _crossing(ranked: DataFrame, quotas: DataFrame, digits: int) -> DataFrame:
    """For every stratum the hash prefix in which its quota is reached, its rows, and how many of them belong."""
    prefix = F.substring("_h", 1, digits)
    counts = ranked.groupBy("_stratum", prefix.alias("_p")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy("_stratum").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("_upto", F.sum("_n").over(upto)).join(quotas, "_stratum")
    before = F.col("_upto") - F.col("_n")
    reached = running.where((F.col("_upto") >= F.col("_quota")) & (before < F.col("_quota")))
    return reached.select("_stratum", "_p", "_n", (F.col("_quota") - before).alias("_need"))


def _bucket(ranked: DataFrame, quotas: DataFrame, digits: int, bucket_rows: int) -> DataFrame:
    """The rows of every stratum's crossing prefix, with ``_need``.

    While a prefix holds more than ``bucket_rows`` rows, longer prefixes inside it are counted, so what
    is ranked in the end stays small at any table size.
    """
    rows, length = ranked, digits
    while True:
        reached = materialise(_crossing(rows, quotas, length))
        inside = rows.withColumn("_p", F.substring("_h", 1, length)).join(sized(reached), ["_stratum", "_p"])
        largest = reached.agg(F.max("_n")).first()[0] or 0
        if largest <= bucket_rows or length >= HASH_DIGITS:
            return inside
        quotas = reached.select("_stratum", F.col("_need").alias("_quota"))
        rows, length = inside.select("_h", "_stratum", "_k"), min(length + digits, HASH_DIGITS)


def _last_inside(bucket: DataFrame) -> DataFrame:
    """For every stratum the (hash, key) of the last row inside its quota."""
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_h", "_k"))
    last = bucket.withColumn("_rank", rank).where(F.col("_rank") == F.col("_need"))
    return last.select("_stratum", F.col("_h").alias("_cut_h"), F.col("_k").alias("_cut_k"))


def _ranked(df: DataFrame, key: str, seed: int | str, stratum: Column) -> DataFrame:
    return df.select(key_hash(key, seed).alias("_h"), stratum.alias("_stratum"), F.col(key).alias("_k"))


def _is_inside(key: str, cut_hash: Column, cut_key: Column) -> Column:
    return (F.col("_h") < cut_hash) | ((F.col("_h") == cut_hash) & (F.col(key) <= cut_key))


def _flag(
    df: DataFrame,
    basis: DataFrame,
    key: str,
    seed: int | str,
    label: str | None,
    fraction: float,
    flag: str,
    digits: int = PREFIX_DIGITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Finds the cuts of ``basis`` now and adds ``flag`` to ``df``: the row ranks inside the quota.

    Without strata the cut is one value pair. With them it is a stored table of one row per class.
    """
    if label is None:
        quotas = basis.agg(F.count("*").alias("_n")).select(F.lit(0).alias("_stratum"), _part_sizes(F.col("_n"), fraction).alias("_quota"))
    else:
        quotas = stratified_quotas(basis, label, fraction)
    stratum = F.lit(0) if label is None else F.col(label)
    cuts = _last_inside(_bucket(_ranked(basis, key, seed, stratum), quotas, digits, bucket_rows))
    hashed = df.withColumn("_h", key_hash(key, seed))
    if label is None:
        cut = cuts.first()
        inside = _is_inside(key, F.lit(cut["_cut_h"]), F.lit(cut["_cut_k"])) if cut else F.lit(False)
        return hashed.withColumn(flag, inside).drop("_h")
    marked = hashed.withColumn("_stratum", stratum).join(sized(materialise(cuts)), "_stratum", "left")
    inside = F.coalesce(_is_inside(key, F.col("_cut_h"), F.col("_cut_k")), F.lit(False))
    return marked.withColumn(flag, inside).select(*df.columns, flag)


def _two_parts(marked: DataFrame, columns: list[str], names: tuple[str, str]) -> DataFrame:
    return marked.select(*columns, F.when(F.col("_in"), names[0]).otherwise(names[1]).alias("split"))


def exact_split(
    df: DataFrame,
    key: str,
    seed: int | str,
    fraction: float = TEST_FRACTION,
    names: tuple[str, str] = ("test", "train"),
    digits: int = PREFIX_DIGITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Adds ``split``: exactly ``ceil(n * fraction)`` rows are ``names[0]``, the others ``names[1]``."""
    return _two_parts(_flag(df, df, key, seed, None, fraction, "_in", digits, bucket_rows), df.columns, names)


def stratified_quotas(df: DataFrame, label: str, fraction: float = TEST_FRACTION) -> DataFrame:
    """Test rows per class. Train rows follow the class shares by largest remainder.

    Ties of the remainder go to the class that comes first in ``label`` order, so ``label`` should be
    the class index. One row per class.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("n")).scalar()
    train_total = total - _part_sizes(total, fraction)
    share = counts.withColumn("_exact", F.col("_n") * train_total / total).withColumn("_floor", F.floor("_exact"))
    left_over = train_total - share.agg(F.sum("_floor").alias("f")).scalar()
    by_remainder = Window.orderBy(F.round(F.col("_floor") - F.col("_exact"), 9), F.col(label))
    train = F.col("_floor") + F.when(F.row_number().over(by_remainder) <= left_over, 1).otherwise(0)
    return share.withColumn("_train", train).select(F.col(label).alias("_stratum"), (F.col("_n") - F.col("_train")).alias("_quota"))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    seed: int | str,
    fraction: float = TEST_FRACTION,
    names: tuple[str, str] = ("test", "train"),
    digits: int = PREFIX_DIGITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """As :func:`exact_split` with the class shares kept. ``label`` is a column of few classes."""
    return _two_parts(_flag(df, df, key, seed, label, fraction, "_in", digits, bucket_rows), df.columns, names)


def three_way_split(
    df: DataFrame,
    key: str,
    seed: int | str,
    label: str | None = None,
    test_fraction: float = TEST_FRACTION,
    valid_fraction: float = VALID_FRACTION,
) -> DataFrame:
    """``test`` first, then ``valid`` out of what is left, the rest ``train``.

    Both cuts are found first; the rows are marked in one pass.
    """
    marked = _flag(df, df, key, seed, label, test_fraction, "_test")
    both = _flag(marked, marked.where(~F.col("_test")), key, f"{seed}v", label, valid_fraction, "_valid")
    part = F.when(F.col("_test"), "test").when(F.col("_valid"), "valid").otherwise("train")
    return both.select(*df.columns, part.alias("split"))


def threshold_split(df: DataFrame, key: str, seed: int | str, fraction: float = TEST_FRACTION) -> DataFrame:
    """The one-pass form: the share is met on average, not exactly."""
    limit = format(math.floor(fraction * 16**8), "08x")
    inside = F.substring(key_hash(key, seed), 1, 8) < F.lit(limit)
    return df.withColumn("split", F.when(inside, "test").otherwise("train"))
