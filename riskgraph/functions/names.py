"""Plan-time column naming: runs on the schema, never on the data."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame


def normalize_name(raw: str) -> str:
    """Lower-case identifier: every run of other characters becomes one underscore."""
    words = [w for w in re.split(r"[^0-9A-Za-z]+", raw) if w]
    return "_".join(words).lower()


def normalize_names(raw_names: Iterable[str]) -> list[str]:
    """Normalise a header; blanks become ``column`` and the n-th repeat gets ``_n``."""
    used: Counter[str] = Counter()
    out = []
    for raw in raw_names:
        name = normalize_name(raw) or "column"
        used[name] += 1
        out.append(name if used[name] == 1 else f"{name}_{used[name]}")
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))
