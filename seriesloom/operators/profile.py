"""Counts, shares, means and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.numeric import percent


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values a column takes."""
    return df.select(column).distinct()


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share of all rows in percent, one decimal."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.withColumn("share_pct", percent(F.col("n"), total.scalar()))


def class_means(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each column per class."""
    return df.groupBy(label).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def daily_means(df: DataFrame, date: str, scores: Sequence[str]) -> DataFrame:
    """Mean of one or several document scores per day; documents without a score do not count."""
    return df.groupBy(date).agg(*[F.avg(c).alias(c) for c in scores])


def mean_and_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population standard deviation of each column."""
    stats: list[Column] = []
    for c in columns:
        stats += [F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"std_{c}")]
    return df.agg(*stats)


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are kept.

    A column with one value has no width: it is spread half a unit to both sides.
    """
    value = F.col(column).cast("double")
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("range"))
    lo, hi = F.col("range.lo"), F.col("range.hi")
    flat = lo == hi
    widened = edges.select(
        F.struct(F.when(flat, lo - 0.5).otherwise(lo).alias("lo"), F.when(flat, hi + 0.5).otherwise(hi).alias("hi")).alias(
            "range"
        )
    )
    limits = widened.scalar()
    low, width = limits["lo"], limits["hi"] - limits["lo"]
    bin_of = F.least(F.floor((value - low) * bins / width), F.lit(bins - 1)).cast("int")
    counted = df.where(value.isNotNull()).groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (low + width * F.col("bin") / bins).alias("bin_low"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )
