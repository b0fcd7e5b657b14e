"""Graph-pattern analytics over the triple table.

``match`` filters one triple pattern; ``star`` folds several functional predicates of a subject into one wide row
with a single aggregate instead of one join per predicate. Labels and other vocabulary reach the rows through
size-checked lookup joins, and aggregates run before those joins wherever the result allows it. Where the vocabulary
is at hand apart from the records, pass it, so that labels are not sought among record triples.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators.joins import lookup_join
from riskgraph.operators.triples import hr

POSITIVE = hr("outcome/heart-disease-positive")
OUTCOME = hr(f"indicator/{V.OUTCOME_INDICATOR}")


def match(
    triples: DataFrame, p: str, s: str | None = None, o: str | None = None, *, object_is: str | None = None
) -> DataFrame:
    """Solutions of one pattern. ``s`` and ``o`` name variables; ``object_is`` fixes the object."""
    found = triples.where(F.col("p") == p)
    if object_is is not None:
        found = found.where((F.col("o") == object_is) & (F.col("o_kind") == "iri"))
    out = [F.col(c).alias(v) for c, v in (("s", s), ("o", o)) if v]
    return found.select(*out)


def join_patterns(*solutions: DataFrame) -> DataFrame:
    """Natural join on shared variables, keeping duplicates: the general form for non-functional predicates."""
    first, *rest = solutions
    for other in rest:
        shared = [c for c in first.columns if c in other.columns]
        if not shared:
            raise ValueError("patterns share no variable")
        first = first.join(other, shared)
    return first


def star(triples: DataFrame, kind: str, subject: str, predicates: Mapping[str, str]) -> DataFrame:
    """One row per node of class ``kind`` that has every predicate (variable -> predicate IRI, functional)."""
    wanted = [*predicates.values()]
    is_kind = (F.col("p") == V.RDF_TYPE) & (F.col("o") == hr(kind))
    rows = triples.where(F.col("p").isin(*wanted) | is_kind)
    values = [F.max(F.when(F.col("p") == p, F.col("o"))).alias(name) for name, p in predicates.items()]
    wide = rows.groupBy(F.col("s").alias(subject)).agg(F.max(is_kind).alias("_is_kind"), *values)
    complete = F.col("_is_kind")
    for name in predicates:
        complete = complete & F.col(name).isNotNull()
    return wide.where(complete).drop("_is_kind")


def labels(triples: DataFrame, kind: str, node: str, label: str) -> DataFrame:
    """Labels of the vocabulary nodes of one class, whose number does not grow with the records."""
    nodes = match(triples, V.RDF_TYPE, s="s", object_is=hr(kind))
    texts = triples.where(F.col("p") == V.RDFS_LABEL)
    return texts.join(nodes, "s", "left_semi").select(F.col("s").alias(node), F.col("o").alias(label))


def _measurements(triples: DataFrame, **predicates: str) -> DataFrame:
    return star(triples, "AggregateMeasurement", "measurement", {k: hr(v) for k, v in predicates.items()})


def entities_of_group(
    triples: DataFrame, vocabulary: DataFrame | None = None, group: str = hr("population-group/age-9/gender-female"),
    limit: int = 50,
) -> DataFrame:
    """Records of one population group with their dataset and outcome label; ordered, so the cut is stable."""
    members = match(triples, hr("belongsToPopulationGroup"), s="s", object_is=group)
    mine = triples.where(
        F.col("p").isin(V.RDF_TYPE, hr("fromDataset"), hr("hasOutcome"))
    ).join(members, "s", "left_semi")
    records = star(mine, "HealthRecord", "record", {"dataset": hr("fromDataset"), "outcome": hr("hasOutcome")})
    named = lookup_join(records, labels(vocabulary or triples, "Outcome", "outcome", "outcomeLabel"), "outcome")
    return named.select("record", "dataset", "outcomeLabel").orderBy("record").limit(limit)


def shared_indicators(triples: DataFrame) -> DataFrame:
    cells = _measurements(triples, indicator="measuresIndicator", dataset="fromDataset")
    counts = (
        cells.select("indicator", "dataset").distinct().groupBy("indicator")
        .agg(F.count("dataset").alias("datasetCount")).where(F.col("datasetCount") > 1)
    )
    named = lookup_join(counts, labels(triples, "Indicator", "indicator", "label"), "indicator")
    return named.select("indicator", "label", "datasetCount").orderBy(F.desc("datasetCount"), "label")


def rank_groups(triples: DataFrame, min_observations: int = V.MIN_GROUP_OBSERVATIONS, limit: int = 20) -> DataFrame:
    cells = _measurements(
        triples, indicator="measuresIndicator", populationGroup="forPopulationGroup", dataset="fromDataset",
        rate="positiveRate", count="observationCount",
    ).where(F.col("indicator") == OUTCOME)
    typed = cells.select(
        "populationGroup", "dataset", F.col("rate").try_cast("double").alias("positiveRate"),
        F.col("count").try_cast("long").alias("observations"),
    ).where(F.col("observations") >= min_observations)
    return typed.orderBy(F.desc("positiveRate"), F.desc("observations"), "populationGroup", "dataset").limit(limit)


def combine_indicators(triples: DataFrame, limit: int = 50) -> DataFrame:
    """Outcome rate with optional blood-pressure and cholesterol rates per group and dataset: one pivot, no join."""
    cells = _measurements(
        triples, indicator="measuresIndicator", populationGroup="forPopulationGroup", dataset="fromDataset",
        rate="positiveRate",
    )
    named = {
        "heartDiseaseRate": OUTCOME, "highBpRate": hr("indicator/high-blood-pressure"),
        "highCholesterolRate": hr("indicator/high-cholesterol"),
    }
    wide = cells.groupBy("populationGroup", "dataset").agg(*[
        F.max(F.when(F.col("indicator") == node, F.col("rate").try_cast("double"))).alias(alias)
        for alias, node in named.items()
    ])
    found = wide.where(F.col("heartDiseaseRate").isNotNull())
    return found.orderBy(F.desc("heartDiseaseRate"), "populationGroup", "dataset").limit(limit)


def multi_source_groups(triples: DataFrame) -> DataFrame:
    records = star(
        triples, "HealthRecord", "record",
        {"populationGroup": hr("belongsToPopulationGroup"), "dataset": hr("fromDataset")},
    )
    per_source = records.groupBy("populationGroup", "dataset").agg(F.count(F.lit(1)).alias("n"))
    return per_source.groupBy("populationGroup").agg(
        F.count(F.lit(1)).alias("datasetCount"), F.sum("n").alias("recordCount")
    ).where(F.col("datasetCount") > 1).orderBy(F.desc("datasetCount"), F.desc("recordCount"), "populationGroup")


def indicator_consistency(triples: DataFrame) -> DataFrame:
    cells = _measurements(triples, indicator="measuresIndicator", dataset="fromDataset", rate="positiveRate")
    kinds = triples.where((F.col("p") == hr("valueKind")) & (F.col("o") == "boolean")).select(F.col("s").alias("indicator"))
    boolean = lookup_join(cells, kinds, "indicator", "left_semi").withColumn("rate", F.col("rate").try_cast("double"))
    per_source = boolean.groupBy("indicator", "dataset").agg(
        F.min("rate").alias("low"), F.max("rate").alias("high"), F.sum("rate").alias("total"), F.count("rate").alias("n")
    )
    stats = per_source.groupBy("indicator").agg(
        F.count(F.lit(1)).alias("datasets"), F.min("low").alias("minRate"), F.max("high").alias("maxRate"),
        F.round(F.sum("total") / F.sum("n"), 6).alias("avgRate"),
    ).where(F.col("datasets") > 1)
    named = lookup_join(stats, labels(triples, "Indicator", "indicator", "indicatorLabel"), "indicator")
    return named.orderBy(F.desc(F.round(F.col("maxRate") - F.col("minRate"), 6)), "indicatorLabel").select(
        "indicatorLabel", "datasets", "minRate", "maxRate", "avgRate"
    )


def outcome_by_age(triples: DataFrame) -> DataFrame:
    cells = _measurements(
        triples, indicator="measuresIndicator", populationGroup="forPopulationGroup", dataset="fromDataset",
        rate="positiveRate", count="observationCount",
    ).where(F.col("indicator") == OUTCOME)
    bands = match(triples, hr("populationGroupAgeGroup"), s="populationGroup", o="ageGroup")
    placed = lookup_join(cells, bands, "populationGroup")
    named = lookup_join(placed, labels(triples, "AgeGroup", "ageGroup", "ageGroupLabel"), "ageGroup")
    return named.groupBy("ageGroupLabel", "dataset").agg(
        F.round(F.avg(F.col("rate").try_cast("double")), 6).alias("avgOutcomeRate"),
        F.sum(F.col("count").try_cast("long")).alias("totalObservations"),
    ).orderBy("dataset", "ageGroupLabel")


def _positive_factors(triples: DataFrame, predicate: str) -> DataFrame:
    """Positive records folded to their sorted distinct factor set; at most one entry per vocabulary factor."""
    factor = F.when(F.col("p") == predicate, F.col("o"))
    is_record = (F.col("p") == V.RDF_TYPE) & (F.col("o") == hr("HealthRecord"))
    is_positive = (F.col("p") == hr("hasOutcome")) & (F.col("o") == POSITIVE)
    rows = triples.where((F.col("p") == predicate) | is_record | is_positive)
    folded = rows.groupBy("s").agg(
        F.max(is_record).alias("_record"), F.max(is_positive).alias("_positive"),
        F.sort_array(F.collect_set(factor)).alias("factors"),
    )
    return folded.where(F.col("_record") & F.col("_positive")).select("factors")


def cooccurring_risk_factors(triples: DataFrame, vocabulary: DataFrame | None = None, limit: int = 20) -> DataFrame:
    """Pairs of risk factors in positive records.

    Records are first counted per distinct factor set (at most 2**7 of them); pairs are then formed once per set
    and weighted by its count, so the number of pairs does not depend on the number of records.
    """
    sets = _positive_factors(triples, hr("hasObservedRiskFactor")).where(F.size("factors") > 1)
    counted = sets.groupBy("factors").agg(F.count(F.lit(1)).alias("n"))
    first = counted.select("n", "factors", F.explode("factors").alias("a"))
    pairs = first.select("n", "a", F.explode(F.filter("factors", lambda f: f > F.col("a"))).alias("b"))
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("coOccurringRecords"))
    first_label = labels(vocabulary or triples, "Indicator", "a", "indicator1Label")
    second_label = labels(vocabulary or triples, "Indicator", "b", "indicator2Label")
    named = lookup_join(lookup_join(totals, first_label, "a"), second_label, "b")
    return named.select("indicator1Label", "indicator2Label", "coOccurringRecords").orderBy(
        F.desc("coOccurringRecords"), "indicator1Label", "indicator2Label").limit(limit)


def inferred_factors(entailed: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """All observed factors through the super-property; needs sub-property entailment."""
    concepts = vocabulary or entailed
    per_factor = (
        _positive_factors(entailed, hr("hasObservedFactor")).select(F.explode("factors").alias("factor"))
        .groupBy("factor").agg(F.count(F.lit(1)).alias("recordCount"))
    )
    category = concepts.where(F.col("p") == hr("indicatorCategory")).select(
        F.col("s").alias("factor"), F.col("o").alias("factorCategory"))
    named = lookup_join(lookup_join(per_factor, labels(concepts, "Indicator", "factor", "factorLabel"), "factor"), category, "factor")
    return named.select("factorLabel", "factorCategory", "recordCount").orderBy(F.desc("recordCount"), "factorLabel")


# --- fixed values: classes of the structure summary --------------------------------------------------
STRUCTURE = (
    ("datasets", "Dataset"), ("indicators", "Indicator"), ("population_groups", "PopulationGroup"),
    ("age_groups", "AgeGroup"), ("genders", "Gender"), ("outcomes", "Outcome"),
    ("aggregate_measurements", "AggregateMeasurement"),
)


def structure_summary(triples: DataFrame) -> DataFrame:
    """Instances per class. Type triples form a set, so a plain count per class is the distinct count."""
    names = {hr(cls): label for label, cls in STRUCTURE}
    typed = triples.where((F.col("p") == V.RDF_TYPE) & F.col("o").isin(*names)).groupBy("o").agg(
        F.count(F.lit(1)).alias("instances"))
    wanted = triples.sparkSession.createDataFrame([(c, n) for c, n in names.items()], "o string, class string")
    return wanted.join(typed, "o", "left").select("class", F.coalesce("instances", F.lit(0)).alias("instances"))


def average_rate(triples: DataFrame) -> DataFrame:
    cells = _measurements(
        triples, indicator="measuresIndicator", populationGroup="forPopulationGroup", rate="positiveRate"
    ).where(F.col("indicator") == OUTCOME)
    return cells.groupBy("populationGroup").agg(
        F.round(F.avg(F.col("rate").try_cast("double")), 6).alias("avgRate")
    ).orderBy(F.desc("avgRate"), "populationGroup")


def report_rows(result: DataFrame, row_cap: int = 200) -> DataFrame:
    """Report view of a result: total row count, whether the cap applies, and the first rows as one array.

    The cap is the feature: the report carries the count of all rows and shows the first ``row_cap``.
    """
    total = result.agg(F.count(F.lit(1)).alias("rows_returned")).withColumn("_one", F.lit(1))
    shown = result.limit(row_cap).agg(F.collect_list(F.struct(*result.columns)).alias("rows")).withColumn("_one", F.lit(1))
    joined = total.join(shown, "_one")
    return joined.select("rows_returned", "rows", (F.col("rows_returned") > row_cap).alias("row_cap_applied"))


# Named patterns: name -> (operator, graph it runs on).
CATALOGUE: Mapping[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "01_entities_by_population_group": (entities_of_group, "full"),
    "02_indicators_shared_by_datasets": (shared_indicators, "analytics"),
    "03_rank_population_groups_by_outcome_rate": (rank_groups, "analytics"),
    "04_combine_indicators_same_group": (combine_indicators, "analytics"),
    "05_population_groups_connected_to_multiple_sources": (multi_source_groups, "full"),
    "06_indicator_consistency_across_datasets": (indicator_consistency, "analytics"),
    "07_outcome_rate_by_age_group": (outcome_by_age, "analytics"),
    "08_top_risk_factor_cooccurrence": (cooccurring_risk_factors, "full"),
    "09_observed_factors_via_rdfs_inference": (inferred_factors, "full"),
}
