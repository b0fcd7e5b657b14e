"""Element-wise arithmetic on ``ARRAY<DOUBLE>`` columns with built-in higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def abs_difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.abs(x - y))


def scale(a: Column, factor: Column) -> Column:
    return F.transform(a, lambda x: x * factor)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(multiply(a, b), F.lit(0.0), lambda acc, x: acc + x)


def rounded(a: Column, places: int) -> Column:
    return F.transform(a, lambda x: F.round(x, places))


def element_average(vec: Column, dim: int) -> list[Column]:
    """One ``avg`` per element: a plain hash aggregate with map-side combine, no explode."""
    return [F.avg(F.get(vec, F.lit(i))) for i in range(dim)]
