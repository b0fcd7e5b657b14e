"""Mergeable states of the canonical table's aggregates: a new run reads its own rows only.

A state holds counts and sums per cell, never means, so states of runs add up. They are stored by run
(``snapshots.write_run``); a run that is repeated overwrites its state. Sources and indicators bound their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V

CELL = ["source_dataset", "age_group_code", "gender"]
#: Columns of the profile: (name, column, rounded to), as means; and (name, column) as missing shares.
PROFILE_MEANS = (
    ("target_positive_rate", "target", 4), ("age_proxy_avg", "age_years_proxy", 3), ("bmi_avg", "bmi", 3), ("systolic_bp_avg", "systolic_bp", 3),
    ("high_bp_rate", "high_blood_pressure_flag", 4), ("high_chol_rate", "high_cholesterol_flag", 4),
)
PROFILE_MISSING = (("bmi_missing_pct", "bmi"), ("smoking_missing_pct", "smoking_flag"), ("activity_missing_pct", "physical_activity_flag"))


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def measurement_states(canonical: DataFrame) -> DataFrame:
    """(source, band, gender, indicator, observations, total): one pass, all indicators side by side."""
    stats = [
        F.struct(F.lit(i.id).alias("indicator_id"), F.count(F.col(i.column)).alias("observations"), F.sum(_number(i.column)).alias("total")).alias(f"s{n}")
        for n, i in enumerate(V.INDICATORS)
    ]
    cells = canonical.dropna(subset=CELL).groupBy(*CELL).agg(*stats)
    return cells.select(*CELL, F.explode(F.array(*[f"s{n}" for n in range(len(stats))])).alias("m")).select(*CELL, "m.*").where("observations > 0")


def merged_measurements(states: DataFrame) -> DataFrame:
    """The measurements of all runs whose states are given; equal to ``aggregate_measurements`` over all their rows."""
    names = states.sparkSession.createDataFrame([(i.id, i.label, i.kind) for i in V.INDICATORS], "indicator_id string, indicator_label string, kind string")
    sums = states.groupBy(*CELL, "indicator_id").agg(F.sum("observations").alias("observations"), F.sum("total").alias("total"))
    return sums.join(F.broadcast(names), "indicator_id").select(
        *CELL, "indicator_id", "indicator_label", "kind", "observations", F.round(F.col("total") / F.col("observations"), 6).alias("value"))


def profile_states(canonical: DataFrame) -> DataFrame:
    """Rows, positives, and of each profiled column the known values and their sum, per source."""
    columns = sorted({c for _, c, _ in PROFILE_MEANS} | {c for _, c in PROFILE_MISSING})
    return canonical.groupBy("source_dataset").agg(
        F.count(F.lit(1)).alias("rows_total"), F.count_if(F.col("target")).alias("target_positive_rows"),
        *[F.count(c).alias(f"known_{c}") for c in columns], *[F.sum(_number(c)).alias(f"sum_{c}") for c in columns])


def merged_profile(states: DataFrame, created_at: str) -> DataFrame:
    """The profile of all runs whose states are given; equal to ``dataset_profile`` over all their rows."""
    sums = states.groupBy("source_dataset").agg(*[F.sum(c).alias(c) for c in states.columns if c not in ("source_dataset", "run_partition")])
    return sums.select(
        "source_dataset", "rows_total", "target_positive_rows",
        *[F.round(F.try_divide(f"sum_{c}", f"known_{c}"), places).alias(name) for name, c, places in PROFILE_MEANS],
        *[F.round(F.try_divide(F.col("rows_total") - F.col(f"known_{c}"), F.col("rows_total")) * 100.0, 3).alias(name) for name, c in PROFILE_MISSING],
        F.lit(created_at).alias("profile_created_at_utc"))
