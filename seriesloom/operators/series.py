"""Order-dependent work on daily tables.

A daily table has one row per series and date, so a window over one series holds at most one row per
calendar day (about 37,000 in a century) whatever the size of the raw data behind it. Every window
here runs on such a table; :func:`daily_panel` builds one from raw rows by pre-aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def daily_panel(df: DataFrame, series: str, date: str, measures: Mapping[str, Column]) -> DataFrame:
    """One row per series and date; partial sums per task come first, so a hot series is no hot task."""
    return df.groupBy(series, date).agg(*[expr.alias(name) for name, expr in measures.items()])


def next_day_label(panel: DataFrame, series: str, date: str, value: str, label: str = "label") -> DataFrame:
    """Each row with the value of its series' next trading day and that day; the newest row has none."""
    w = Window.partitionBy(series).orderBy(date)
    return panel.withColumns({label: F.lead(value).over(w), f"{label}_date": F.lead(date).over(w)})


def labelled_rows(panel: DataFrame, series: str, date: str, value: str, label: str = "label") -> DataFrame:
    """As :func:`next_day_label`, without the newest row of each series."""
    return next_day_label(panel, series, date, value, label).where(F.col(f"{label}_date").isNotNull())


def consecutive_batches(days: DataFrame, series: str, date: str, size: int = 5) -> DataFrame:
    """Runs of consecutive days, cut from the newest day back into batches of at most ``size``.

    Counting back from the newest day, date plus row number is constant within a run.
    """
    newest_first = Window.partitionBy(series).orderBy(F.desc(date))
    in_run = Window.partitionBy(series, "_run").orderBy(F.desc(date))
    return (
        days.select(series, date)
        .distinct()
        .withColumn("_run", F.date_add(F.col(date), F.row_number().over(newest_first)))
        .withColumn("_chunk", F.floor((F.row_number().over(in_run) - 1) / size))
        .groupBy(series, "_run", "_chunk")
        .agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"), F.count("*").alias("n_days"))
        .select(series, "start_date", "end_date", "n_days")
    )


def last_days(df: DataFrame, series: str, date: str, n: int) -> DataFrame:
    """The newest ``n`` days of each series; Spark cuts to ``n`` per task before the shuffle."""
    w = Window.partitionBy(series).orderBy(F.desc(date))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def actual_and_predicted(
    predicted: DataFrame, series: str, date: str, value: str, label: str = "label", limit: int = 0, as_plotted: bool = False
) -> DataFrame:
    """Actual and predicted value by date, the newest ``limit`` days of each series (0: all).

    A prediction made from a row is for the next trading day, so it is listed under the label's date
    with the label as the actual value. ``as_plotted`` lists it under the date of the input row with
    that row's own value, the way the original charts show it.
    """
    day, actual = (date, value) if as_plotted else (f"{label}_date", label)
    table = predicted.select(
        series, F.col(day).alias("date"), F.col(actual).alias("actual"), F.col("prediction").alias("predicted")
    )
    return last_days(table, series, "date", limit) if limit else table
