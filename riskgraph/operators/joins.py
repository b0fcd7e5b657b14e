"""Joins against lookup tables.

The planner knows the bytes of stored lookups, adaptive execution those of computed ones: small sides are broadcast,
large ones are shuffled and their skewed keys split. There is no row count and no switch here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(large: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    return large.join(lookup, on, how)
