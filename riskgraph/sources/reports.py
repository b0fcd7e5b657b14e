"""Manifest, embedding tables, reports and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators.embedding import embedding_table, from_embedding_table

# --- fixed values: texts of the manifest -------------------------------------------------------------
LANGUAGE = "RDF/RDFS"
CLASS_HIERARCHY = "Concept > {DemographicConcept, HealthConcept}; Observation > {HealthRecord, AggregateMeasurement}"
PROPERTY_HIERARCHY = (
    "hasObservedFactor > {hasObservedRiskFactor, hasObservedProtectiveFactor}; "
    "belongsToDemographicConcept > {belongsToAgeGroup, hasGender, belongsToPopulationGroup}"
)
VOCABULARY_CLASSES = (
    "HealthRecord", "Dataset", "PopulationGroup", "AgeGroup", "Gender", "Indicator", "AggregateMeasurement", "Outcome",
    "KnowledgeGraphRun",
)
INTEGRATION_CONCEPTS = ("AgeGroup", "Gender", "PopulationGroup", "Indicator", "Outcome")


def graph_manifest(
    counts: DataFrame, validation: DataFrame, full_inferred: DataFrame, analytics_inferred: DataFrame, run_id: str,
    created_at: str, graph_file: str, analytics_file: str, schema_file: str, queries: list[str],
) -> DataFrame:
    """One nested row; every number is an aggregate computed on Spark."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(*df.columns).alias(name)).withColumn("_one", F.lit(1))

    full = full_inferred.agg(F.count(F.lit(1)).alias("full_graph_inferred_triples")).withColumn("_one", F.lit(1))
    small = analytics_inferred.agg(F.count(F.lit(1)).alias("analytics_graph_inferred_triples")).withColumn("_one", F.lit(1))
    joined = one(counts, "counts").join(one(validation, "validation"), "_one").join(full, "_one").join(small, "_one")
    return joined.select(
        F.lit(run_id).alias("run_id"), F.lit(created_at).alias("created_at_utc"), F.lit(LANGUAGE).alias("language"),
        F.lit("riskgraph").alias("generator"),
        F.struct(
            F.lit(graph_file).alias("graph_file"), F.lit(analytics_file).alias("analytics_graph_file"),
            F.lit(schema_file).alias("schema_file"), F.lit("riskgraph.operators.patterns").alias("sparql_query_dir"),
        ).alias("storage"),
        F.struct(
            F.array(*map(F.lit, VOCABULARY_CLASSES)).alias("classes"),
            F.array(*map(F.lit, INTEGRATION_CONCEPTS)).alias("integration_concepts"),
            F.lit(len(V.INDICATORS)).alias("indicator_count"),
        ).alias("common_vocabulary"),
        "counts",
        F.struct(
            F.lit(True).alias("entailment_applied"), "full_graph_inferred_triples", "analytics_graph_inferred_triples",
            F.lit(CLASS_HIERARCHY).alias("class_hierarchy"), F.lit(PROPERTY_HIERARCHY).alias("property_hierarchy"),
        ).alias("rdfs_reasoning"),
        "validation", F.array(*map(F.lit, queries)).alias("queries"),
    )


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def write_embeddings(vectors: DataFrame, path: str, dim: int = V.EMBEDDING_DIM, as_csv: bool = False) -> None:
    """Parquet with one array column, or the wide CSV form."""
    if as_csv:
        embedding_table(vectors, dim).write.mode("overwrite").option("header", True).csv(path)
    else:
        vectors.select("node", "vec").write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str, as_csv: bool = False) -> DataFrame:
    if as_csv:
        return from_embedding_table(spark.read.option("header", True).csv(path))
    return spark.read.parquet(path)


# --- fixed values: columns of the sample audit ---------------------------------------------------------
AUDIT_COLUMNS = (
    "source_dataset", "source_record_id", "population_group", "target", "observed_indicator_count",
    "risk_indicator_count", "protective_indicator_count",
)


def write_sample_audit(samples: DataFrame, path: str) -> None:
    samples.select(*AUDIT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
