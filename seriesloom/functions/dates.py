"""Date text and date columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slash_date_to_int(text: Column) -> Column:
    """``'Y/M/D'`` to an int by joining the parts as written: ``2000/1/4`` gives 200014.

    Text without exactly two slashes gives null.
    """
    joined = F.replace(text, F.lit("/"), F.lit(""))
    two_slashes = F.length(text) - F.length(joined) == 2
    return F.when(two_slashes, joined.try_cast("int"))


def date_to_int(date: Column) -> Column:
    """A real date as the int ``yyyymmdd``."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def dotted_to_slash(text: Column) -> Column:
    """``'YYYY.MM.DD.'`` to ``'YYYY/MM/DD'``: the first two dots become slashes, later ones go."""
    parts = F.split(text, r"\.", -1)
    return F.concat(F.array_join(F.slice(parts, 1, 3), "/"), F.array_join(F.slice(parts, 4, F.size(parts)), ""))


def slash_to_date(text: Column) -> Column:
    """``'Y/M/D'`` with or without zero padding to a date; text that is no date gives null."""
    return F.try_to_date(text, "y/M/d")


def day_gap(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)
