"""Harmonising cleaned sources into one canonical table, and the reports over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators.lineage import cut
from riskgraph.operators.ranking import largest_key, ordinal_in_key


# Canonical fields each source supplies; a field that is not listed is a typed NULL.
CARDIO_FIELDS: Mapping[str, str | Column] = {
    "source_record_id": "patient_id", "age_years_proxy": "age_years", "age_group_code": "age_group_code",
    "gender": "gender", "bmi": "bmi", "systolic_bp": "systolic_bp", "diastolic_bp": "diastolic_bp",
    "high_blood_pressure_flag": "systolic_bp >= 130 OR diastolic_bp >= 80",
    "high_cholesterol_flag": "cholesterol_level >= 2", "glucose_risk_flag": "glucose_level >= 2",
    "smoking_flag": "is_smoker", "physical_activity_flag": "is_active", "heavy_alcohol_flag": "drinks_alcohol",
    "target": "has_cardiovascular_disease",
}
CDC_FIELDS: Mapping[str, str | Column] = {
    "source_record_id": "respondent_id",
    **{c: c for c in (
        "age_years_proxy", "age_group_code", "gender", "bmi", "high_blood_pressure_flag", "high_cholesterol_flag",
        "smoking_flag", "physical_activity_flag", "heavy_alcohol_flag", "general_health_score",
        "mental_unhealthy_days", "physical_unhealthy_days", "difficulty_walking_flag",
    )},
    "target": "has_heart_disease",
}
CLEVELAND_FIELDS: Mapping[str, str | Column] = {
    "source_record_id": "record_key", "age_years_proxy": "age_years", "age_group_code": "age_group_code",
    "gender": "gender", "systolic_bp": "resting_bp", "high_blood_pressure_flag": "resting_bp >= 130",
    "high_cholesterol_flag": "serum_cholesterol >= 200", "glucose_risk_flag": "fasting_blood_sugar_high",
    "max_heart_rate": "max_heart_rate", "exercise_induced_angina": "exercise_induced_angina",
    "target": "has_heart_disease",
}
FIELDS = {V.CARDIO: CARDIO_FIELDS, V.CDC: CDC_FIELDS, V.CLEVELAND: CLEVELAND_FIELDS}


def to_canonical(
    clean: DataFrame, dataset: str, run_id: str, created_at: str, fields: Mapping[str, str | Column] | None = None
) -> DataFrame:
    """Project one cleaned source onto the 25 canonical columns."""
    supplied = {
        **(fields or FIELDS[dataset]),
        "source_dataset": F.lit(dataset),
        "trusted_run_id": "_run_id",
        "trusted_processed_at_utc": "_processed_at_utc",
        "exploitation_run_id": F.lit(run_id),
        "exploitation_created_at_utc": F.lit(created_at),
    }
    out = []
    for name, kind in V.CANONICAL_COLUMNS:
        value = supplied.get(name, F.lit(None))
        out.append((F.expr(value) if isinstance(value, str) else value).cast(kind).alias(name))
    return clean.select(*out)


def union_canonical(parts: Sequence[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def with_record_ordinal(canonical: DataFrame, unique_sources: Sequence[str] = (V.CARDIO, V.CLEVELAND)) -> DataFrame:
    """Append ``record_ordinal``: unique within (source_dataset, source_record_id).

    Sources whose contract proves unique ids get 1 without any shuffle. The ids of the others are counted: if none
    repeats, theirs is 1 too, else those sources are numbered and written once, for all who read them.
    """
    unique = F.col("source_dataset").isin(*unique_sources) if unique_sources else F.lit(False)
    known = canonical.where(unique).withColumn("record_ordinal", F.lit(1).cast("long"))
    repeated = canonical.where(~F.coalesce(unique, F.lit(False)))
    order = [c for c in canonical.columns if c not in ("source_dataset", "source_record_id")]
    keys = ["source_dataset", "source_record_id"]
    largest = largest_key(repeated, keys)
    if largest <= 1:
        return canonical.withColumn("record_ordinal", F.lit(1).cast("long"))
    numbered = cut(ordinal_in_key(repeated, keys, order, "record_ordinal", largest))
    return known.unionByName(numbered)


def dataset_profile(canonical: DataFrame, created_at: str) -> DataFrame:
    """One row per source: sizes, positive rate, averages and missing shares. One partial/final aggregate."""
    def rate(name: str) -> Column:
        return F.round(F.avg(F.col(name).cast("double")), 4)

    def missing(name: str) -> Column:
        return F.round(F.try_divide(F.count_if(F.col(name).isNull()), F.count(F.lit(1))) * 100.0, 3)

    return canonical.groupBy("source_dataset").agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("target")).alias("target_positive_rows"),
        rate("target").alias("target_positive_rate"),
        F.round(F.avg("age_years_proxy"), 3).alias("age_proxy_avg"),
        F.round(F.avg("bmi"), 3).alias("bmi_avg"),
        F.round(F.avg("systolic_bp"), 3).alias("systolic_bp_avg"),
        rate("high_blood_pressure_flag").alias("high_bp_rate"),
        rate("high_cholesterol_flag").alias("high_chol_rate"),
        missing("bmi").alias("bmi_missing_pct"),
        missing("smoking_flag").alias("smoking_missing_pct"),
        missing("physical_activity_flag").alias("activity_missing_pct"),
        F.lit(created_at).alias("profile_created_at_utc"),
    )


def profile_listing(profile: DataFrame) -> DataFrame:
    return profile.select(
        "source_dataset", "rows_total", "target_positive_rate", "age_proxy_avg", "bmi_avg", "high_bp_rate",
        "high_chol_rate", "bmi_missing_pct", "smoking_missing_pct", "activity_missing_pct",
    ).orderBy("source_dataset")


def aggregate_measurements(canonical: DataFrame) -> DataFrame:
    """Count and mean of each indicator per (source, band, gender).

    All 17 indicators are aggregated side by side in one pass, so rows are not multiplied before the shuffle;
    only the aggregated cells are turned into rows.
    """
    keys = ["source_dataset", "age_group_code", "gender"]
    stats = [
        F.struct(
            F.lit(i.id).alias("indicator_id"), F.lit(i.label).alias("indicator_label"), F.lit(i.kind).alias("kind"),
            F.count(F.col(i.column)).alias("observations"),
            F.round(F.avg(F.col(i.column).cast("double")), 6).alias("value"),
        ).alias(f"s{n}")
        for n, i in enumerate(V.INDICATORS)
    ]
    cells = canonical.dropna(subset=keys).groupBy(*keys).agg(*stats)
    rows = cells.select(*keys, F.explode(F.array(*[F.col(f"s{n}") for n in range(len(stats))])).alias("m"))
    return rows.select(*keys, "m.*").where(F.col("observations") > 0)


def top_violations(quality: DataFrame, limit: int = 20) -> DataFrame:
    return quality.select("dataset", "rule_name", "violations", "violation_pct", "action_applied").orderBy(
        F.desc("violations"), "dataset", "rule_name").limit(limit)


def top_reasons(quarantine: DataFrame, limit: int = 15) -> DataFrame:
    counts = quarantine.groupBy("dataset", "quarantine_reason").agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), "dataset", "quarantine_reason").limit(limit)


def quarantine_summary(quality: DataFrame) -> DataFrame:
    is_total = F.col("rule_name") == "rows_quarantined_total"
    summary = quality.groupBy("dataset").agg(
        F.sum(F.when(~is_total, F.col("violations"))).alias("rule_violations"),
        F.max(F.when(is_total, F.col("violations"))).alias("quarantined_rows"),
        F.max("total_rows").alias("source_rows"),
    )
    share = F.coalesce("quarantined_rows", F.lit(0)) / F.greatest("source_rows", F.lit(1)) * 100.0
    return summary.withColumn("quarantine_pct", F.round(share, 6)).orderBy("dataset")


# --- fixed values: coverage report columns -----------------------------------------------------------
COVERAGE = (
    ("bmi", "bmi_coverage"), ("systolic_bp", "systolic_bp_coverage"), ("smoking_flag", "smoking_coverage"),
    ("high_blood_pressure_flag", "high_bp_coverage"), ("high_cholesterol_flag", "high_chol_coverage"),
    ("max_heart_rate", "max_hr_coverage"), ("general_health_score", "general_health_coverage"),
)


def coverage_matrix(canonical: DataFrame) -> DataFrame:
    shares = [F.round(F.avg(F.col(c).isNotNull().cast("double")) * 100.0, 6).alias(a) for c, a in COVERAGE]
    return canonical.groupBy("source_dataset").agg(*shares).orderBy("source_dataset")


def rate_pivot(outcome_by_age: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Mean outcome rate: one row per age label, one column per dataset (named, so no extra distinct job)."""
    short = F.element_at(F.split("dataset", "/"), -1)
    named = outcome_by_age.withColumn("_short", short).groupBy("ageGroupLabel").pivot("_short", list(datasets))
    return named.agg(F.round(F.avg("avgOutcomeRate"), 6))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Summary statistics of numeric columns, one row per column, from one aggregate."""
    stats = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("rows"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def indicator_spread(consistency: DataFrame) -> DataFrame:
    spread = F.round(F.col("maxRate") - F.col("minRate"), 6)
    return consistency.withColumn("spread", spread).orderBy(F.desc("spread"), "indicatorLabel")


def lineage(canonical: DataFrame, separator: str = ", ") -> DataFrame:
    """One lineage row. Distinct names are reduced by a grouped aggregate before they meet in one row."""
    runs = canonical.groupBy("source_dataset", "trusted_run_id").agg(
        F.min("exploitation_run_id").alias("run"), F.min("exploitation_created_at_utc").alias("created"),
        F.count(F.lit(1)).alias("n"),
    )
    return runs.agg(
        F.min("run").alias("exploitation_run_id"),
        F.min("created").alias("created_at_utc"),
        F.array_join(F.sort_array(F.collect_set("source_dataset")), separator).alias("source_datasets"),
        F.array_join(F.sort_array(F.collect_set("trusted_run_id")), separator).alias("trusted_run_ids"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_integration"),
    )


def row_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ]
    return union_canonical(parts)
