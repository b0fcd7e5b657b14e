"""Two-valued rule predicates: NULL input is a violation when required, a pass when optional."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def required_range(name: str, low: float, high: float) -> Column:
    return _holds(F.col(name).between(low, high))


def optional_range(name: str, low: float, high: float) -> Column:
    return F.col(name).isNull() | _holds(F.col(name).between(low, high))


def required_domain(name: str, values: Sequence) -> Column:
    return _holds(F.col(name).isin(*values))


def required_present(name: str) -> Column:
    return F.col(name).isNotNull()


def not_below(upper: str, lower: str) -> Column:
    return _holds(F.col(upper) >= F.col(lower))


def is_missing(col: Column, is_floating: bool = False) -> Column:
    """NULL, or NaN for floating columns."""
    return (col.isNull() | F.isnan(col)) if is_floating else col.isNull()
