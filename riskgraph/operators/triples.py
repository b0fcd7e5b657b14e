"""Materialising the knowledge graph as a five-column triple table ``(s, p, o, o_kind, o_type)``.

Each generator is a narrow projection plus an explode: triples are produced where the rows are. Blocks that are
distinct by construction (records, measurements) are never shuffled for deduplication.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.functions import iri

TRIPLE_COLUMNS = ("s", "p", "o", "o_kind", "o_type")
TRIPLE_SCHEMA = "s string, p string, o string, o_kind string, o_type string"


class Triple(NamedTuple):
    """Template of one triple per row. The predicate is known when the plan is built."""

    s: Column
    p: str
    o: Column
    kind: str
    datatype: str | None = None


def link(s: Column, p: str, o: Column) -> Triple:
    """An IRI-valued triple."""
    return Triple(s, p, o, "iri")


def literal(s: Column, p: str, value: Column, xsd: str | None = None) -> Triple:
    """A literal triple; a plain label has no datatype. A NaN is no value, like NULL."""
    text = value.cast("string")
    return Triple(s, p, F.nullif(text, F.lit("NaN")) if xsd == "double" else text, "literal", V.XSD + xsd if xsd else None)


def emit(df: DataFrame, templates: Sequence[Triple], only: Collection[str] | None = None) -> DataFrame:
    """Turn each row into its triples (``stack``, a plain generator); those without an object are dropped.

    ``only`` names the predicates a reader needs: the others are never produced.
    """
    wanted = [t for t in templates if only is None or t.p in only]
    if not wanted:
        return df.sparkSession.createDataFrame([], TRIPLE_SCHEMA)
    cells = [c for t in wanted for c in (t.s, F.lit(t.p), t.o, F.lit(t.kind), F.lit(t.datatype).cast("string"))]
    stacked = df.select(F.stack(F.lit(len(wanted)), *cells).alias(*TRIPLE_COLUMNS))
    return stacked.where(F.col("o").isNotNull())


def hr(name: str) -> str:
    return V.hr(name)


def _static(spark: SparkSession, rows: list[tuple[str, str, str, str, str | None]]) -> DataFrame:
    return spark.createDataFrame(rows, TRIPLE_SCHEMA)


def schema_triples(spark: SparkSession) -> DataFrame:
    """Classes, properties and both hierarchies: 185 triples of fixed vocabulary."""
    rows: list[tuple] = []

    def iri_row(s: str, p: str, o: str) -> None:
        rows.append((s, p, o, "iri", None))

    def text_row(s: str, p: str, o: str) -> None:
        rows.append((s, p, o, "literal", None))

    for name, label in V.CLASSES:
        iri_row(hr(name), V.RDF_TYPE, V.RDFS_CLASS)
        text_row(hr(name), V.RDFS_LABEL, label)
    properties = [(n, d, hr(r), c) for n, d, r, c in V.OBJECT_PROPERTIES]
    properties += [(n, d, V.XSD + r, c) for n, d, r, c in V.DATA_PROPERTIES]
    for name, domain, value_range, comment in properties:
        iri_row(hr(name), V.RDF_TYPE, V.RDF_PROPERTY)
        iri_row(hr(name), V.RDFS_DOMAIN, hr(domain))
        iri_row(hr(name), V.RDFS_RANGE, value_range)
        text_row(hr(name), V.RDFS_LABEL, name)
        text_row(hr(name), V.RDFS_COMMENT, comment)
    for relation, pairs in ((V.RDFS_SUBCLASS, V.SUBCLASS_OF), (V.RDFS_SUBPROPERTY, V.SUBPROPERTY_OF)):
        for child, parent in pairs:
            iri_row(hr(child), relation, hr(parent))
    return _static(spark, rows)


def vocabulary_triples(spark: SparkSession) -> DataFrame:
    """Age groups, genders, indicators and outcomes: 136 triples of fixed vocabulary."""
    rows: list[tuple] = []

    def concept(node: str, kind: str, label: str, **attributes: tuple[str, str]) -> None:
        rows.append((node, V.RDF_TYPE, hr(kind), "iri", None))
        rows.append((node, V.RDFS_LABEL, label, "literal", None))
        rows.extend((node, hr(p), value, "literal", V.XSD + xsd) for p, (value, xsd) in attributes.items())

    for code, label in enumerate(V.AGE_BAND_LABELS, 1):
        concept(hr(f"age-group/{code}"), "AgeGroup", label, ageGroupCode=(str(code), "integer"))
    for gender in V.GENDERS:
        concept(hr(f"gender/{gender}"), "Gender", gender)
    for i in V.INDICATORS:
        concept(
            hr(f"indicator/{i.id}"), "Indicator", i.label, indicatorColumn=(i.column, "string"),
            indicatorCategory=(i.category, "string"), valueKind=(i.kind, "string"),
        )
    for name, label in V.OUTCOMES:
        concept(hr(name), "Outcome", label)
    return _static(spark, rows)


def dataset_triples(profile: DataFrame) -> DataFrame:
    node = iri.dataset_iri(F.col("source_dataset"))
    return emit(profile.where(F.col("source_dataset").isNotNull()), [
        link(node, V.RDF_TYPE, F.lit(hr("Dataset"))),
        literal(node, V.RDFS_LABEL, F.col("source_dataset")),
        literal(node, hr("rowsTotal"), F.col("rows_total"), "integer"),
        literal(node, hr("targetPositiveRate"), iri.double_text(F.col("target_positive_rate")), "double"),
    ])


def run_triples(profile: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Provenance of one generation run; the source names come from the small per-source profile."""
    spark = profile.sparkSession
    run = hr(f"kg-run/{run_id}")
    fixed = _static(spark, [
        (run, V.RDF_TYPE, hr("KnowledgeGraphRun"), "iri", None),
        (run, V.RDFS_LABEL, f"KG generation run {run_id}", "literal", None),
        (run, hr("runId"), run_id, "literal", V.XSD + "string"),
        (run, hr("createdAtUtc"), created_at, "literal", V.XSD + "dateTime"),
        (run, V.DCTERMS + "conformsTo", V.RDFS, "iri", None),
    ])
    sources = profile.where(F.col("source_dataset").isNotNull())
    covered = emit(sources, [link(F.lit(run), hr("generatedGraph"), iri.dataset_iri(F.col("source_dataset")))])
    return fixed.unionByName(covered)


def population_groups(keys: DataFrame) -> DataFrame:
    """Distinct (age_group_code, gender) pairs as group nodes; partial aggregation leaves one row per pair and task."""
    distinct = keys.select("age_group_code", "gender").distinct()
    code, gender = F.col("age_group_code"), F.col("gender")
    node = iri.population_group_iri(code, gender)
    # Code 0 reads as unknown in the label, as a missing code does.
    shown = F.coalesce(F.nullif(code, F.lit(0)).cast("string"), F.lit("unknown"))
    label = F.concat(F.lit("Age "), shown, F.lit(" / gender "), F.coalesce(gender, F.lit("unknown")))
    # Genders that share a slug share a node; one label is kept so that the node stays functional.
    nodes = distinct.groupBy(node.alias("node")).agg(
        F.min(label).alias("label"), F.min(iri.age_group_iri(code)).alias("age"), F.min(iri.gender_iri(gender)).alias("g")
    )
    subject = F.col("node")
    return emit(nodes, [
        link(subject, V.RDF_TYPE, F.lit(hr("PopulationGroup"))),
        literal(subject, V.RDFS_LABEL, F.col("label")),
        link(subject, hr("populationGroupAgeGroup"), F.col("age")),
        link(subject, hr("populationGroupGender"), F.col("g")),
    ])


def record_triples(records: DataFrame, only: Collection[str] | None = None) -> DataFrame:
    """Nine fixed triples per record and one per true risk or protective factor. No shuffle.

    ``records`` is the canonical table with ``record_ordinal``; ``only`` restricts the predicates produced.
    """
    code, gender, dataset = F.col("age_group_code"), F.col("gender"), F.col("source_dataset")
    base = records.select(
        "*",
        iri.record_iri(dataset, F.col("source_record_id"), F.col("record_ordinal")).alias("_node"),
        iri.dataset_iri(dataset).alias("_dataset"), iri.age_group_iri(code).alias("_age"),
        iri.gender_iri(gender).alias("_gender"), iri.population_group_iri(code, gender).alias("_group"),
        iri.outcome_iri(F.col("target")).alias("_outcome"),
    )
    s = F.col("_node")
    factors = [
        link(s, hr(prop), F.when(F.col(column), F.lit(hr(f"indicator/{factor}"))))
        for prop, columns in (
            ("hasObservedRiskFactor", V.RISK_COLUMNS), ("hasObservedProtectiveFactor", V.PROTECTIVE_COLUMNS))
        for column, factor in columns.items()
    ]
    return emit(base, [
        link(s, V.RDF_TYPE, F.lit(hr("HealthRecord"))),
        link(s, hr("fromDataset"), F.col("_dataset")),
        link(s, hr("belongsToAgeGroup"), F.col("_age")),
        link(s, hr("hasGender"), F.col("_gender")),
        link(s, hr("belongsToPopulationGroup"), F.col("_group")),
        link(s, hr("hasOutcome"), F.col("_outcome")),
        literal(s, hr("sourceRecordId"), F.col("source_record_id"), "string"),
        literal(s, hr("recordOrdinal"), F.col("record_ordinal"), "integer"),
        literal(s, hr("sourceDatasetName"), dataset, "string"),
        *factors,
    ], only)


def measurement_triples(measurements: DataFrame) -> DataFrame:
    """Eight triples per aggregate measurement, the inverse link of its group included."""
    dataset, code, gender = F.col("source_dataset"), F.col("age_group_code"), F.col("gender")
    node = iri.measurement_iri(dataset, F.nullif(code, F.lit(0)), gender, F.col("indicator_id"))
    group = iri.population_group_iri(code, gender)
    base = measurements.select("*", node.alias("_node"), group.alias("_group"))
    s, g = F.col("_node"), F.col("_group")
    label = F.concat(
        F.col("indicator_label"), F.lit(" for "), dataset, F.lit(", age "), code.cast("string"), F.lit(", gender "), gender
    )
    is_rate = F.col("kind") == "boolean"
    value = iri.double_text(F.col("value"))
    return emit(base, [
        link(s, V.RDF_TYPE, F.lit(hr("AggregateMeasurement"))),
        link(s, hr("fromDataset"), iri.dataset_iri(dataset)),
        link(s, hr("forPopulationGroup"), g),
        link(s, hr("measuresIndicator"), iri.indicator_iri(F.col("indicator_id"))),
        link(g, hr("hasAggregateMeasurement"), s),
        literal(s, V.RDFS_LABEL, label),
        literal(s, hr("observationCount"), F.col("observations"), "integer"),
        literal(s, hr("positiveRate"), F.when(is_rate, value), "double"),
        literal(s, hr("meanValue"), F.when(~is_rate, value), "double"),
    ])


def graph_union(parts: Iterable[DataFrame]) -> DataFrame:
    """Set union of arbitrary graphs: one shuffle of everything. Prefer the builders below where they apply."""
    return reduce(DataFrame.unionByName, parts).dropDuplicates(list(TRIPLE_COLUMNS))


def _shared(spark: SparkSession, profile: DataFrame, group_keys: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """The small blocks of a graph, deduplicated among themselves."""
    return graph_union([
        schema_triples(spark), vocabulary_triples(spark), run_triples(profile, run_id, created_at),
        dataset_triples(profile), population_groups(group_keys),
    ])


def analytics_graph(profile: DataFrame, measurements: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Schema, vocabulary, datasets, measurements and the groups they use; no records."""
    shared = _shared(profile.sparkSession, profile, measurements, run_id, created_at)
    return shared.unionByName(measurement_triples(measurements))


def full_graph(
    records: DataFrame, groups: DataFrame, profile: DataFrame, measurements: DataFrame, run_id: str, created_at: str
) -> DataFrame:
    """The analytics graph plus one star per record. ``groups`` holds the demographic keys of all records.

    Record and measurement blocks are sets by construction (one IRI per row, distinct predicates or objects),
    so only the small shared blocks are deduplicated; the bulk of the graph is never shuffled.
    """
    shared = _shared(records.sparkSession, profile, groups, run_id, created_at)
    return shared.unionByName(measurement_triples(measurements)).unionByName(record_triples(records))


def manifest_counts(records: DataFrame, measurements: DataFrame, graph: DataFrame, groups: bool = False) -> DataFrame:
    """Rows, record nodes, measurements, triples and datasets as one row of single-pass counts.

    With ``groups`` the validation counts of record and group nodes come from the same pass over the graph.
    """
    typed = F.col("p") == V.RDF_TYPE
    is_record, is_group = typed & (F.col("o") == hr("HealthRecord")), typed & (F.col("o") == hr("PopulationGroup"))
    from_graph = graph.agg(
        F.count(F.lit(1)).alias("triples"), F.count_if(is_record).alias("health_record_resources"),
        F.count_if(is_record).alias("health_record_count"), F.count_if(is_group).alias("population_group_count")
    )
    per_source = records.groupBy("source_dataset").agg(F.count(F.lit(1)).alias("n"))
    from_rows = per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("trusted_rows_processed"), F.count("source_dataset").alias("datasets")
    )
    from_cells = measurements.agg(F.count(F.lit(1)).alias("aggregate_measurements"))
    keyed = [d.withColumn("_one", F.lit(1)) for d in (from_rows, from_graph, from_cells)]
    joined = keyed[0].join(keyed[1], "_one").join(keyed[2], "_one")
    checks = ("health_record_count", "population_group_count") if groups else ()
    return joined.select(
        "trusted_rows_processed", "health_record_resources", "aggregate_measurements", "triples", "datasets", *checks
    )


def validation_counts(graph: DataFrame) -> DataFrame:
    typed = graph.where(F.col("p") == V.RDF_TYPE)
    return typed.agg(
        F.count_if(F.col("o") == hr("HealthRecord")).alias("health_record_count"),
        F.count_if(F.col("o") == hr("PopulationGroup")).alias("population_group_count"),
    )
