"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: market capitalisation is modelled in units of 10**12.
CAP_UNIT = 1_000_000_000_000


def rescale(value: Column, unit: float = CAP_UNIT) -> Column:
    """A value in larger units."""
    return value / F.lit(float(unit))


def log10_rounded(value: Column, digits: int = 6) -> Column:
    """Base-10 logarithm, rounded."""
    return F.round(F.log10(value), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, rounded half up."""
    return F.round(part * 100 / whole, digits)


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two equally long arrays, in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two equally long arrays; null when either is all zeros."""
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return dot(left, right) / F.nullif(norms, F.lit(0.0))
