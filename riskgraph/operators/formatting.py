"""Structural formatting of raw snapshots: header repair, renaming, fingerprint and lineage columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.functions.names import normalize_columns, normalize_name
from riskgraph.functions.standardise import row_digest

DELIMITERS = (";", ",")


def split_single_column(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expand a frame whose only column is an unsplit delimited line; any other frame passes unchanged."""
    if len(df.columns) != 1:
        return df
    header = df.columns[0]
    for mark in DELIMITERS:
        if [normalize_name(part) for part in header.split(mark)] == list(expected):
            cells = F.split(F.col(f"`{header}`"), mark, -1)
            return df.select(*[F.trim(F.get(cells, F.lit(i))).alias(name) for i, name in enumerate(expected)])
    return df


def format_dataset(df_raw: DataFrame, dataset: str, run_ts: str, expected: Sequence[str] | None = None) -> DataFrame:
    """Repair (when a header is expected), rename, then append source, fingerprint and timestamp."""
    shaped = normalize_columns(split_single_column(df_raw, expected) if expected else df_raw)
    return shaped.withColumns({
        "_source_dataset": F.lit(dataset),
        "_formatted_record_id": row_digest(dataset, shaped.columns),
        "_formatted_at_utc": F.lit(run_ts),
    })
