"""The query registry: one entry per operator, each over whole tables of one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.functions import iri, standardise as st, vectors
from riskgraph.functions.names import normalize_columns
from riskgraph.operators import (
    comparison, contracts, dictionary, embedding, entailment, features, formatting, harmonise, metrics, models, partials, patterns,
    sampling, triples,
)
from riskgraph.operators.lineage import cut, scratch
from riskgraph.plans import zones
from riskgraph.plans.bindings import EVENTS_CONTRACT, LINEITEM_CONTRACT, RUN_ID, RUN_TS, Tables, events_from, lineitem_from
from riskgraph.sources import ntriples, snapshots, tables
from riskgraph.streaming.ingest import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


# ---- slice -----------------------------------------------------------------------------------------------
@register
def flagship_group_rank(t: Tables) -> DataFrame:
    """Contract on orders, canonical projection, group aggregate, ranked groups."""
    clean = t.evaluated["orders"].clean()
    canonical = harmonise.to_canonical(clean, "orders", RUN_ID, RUN_TS, t.fields["orders"])
    cells = harmonise.aggregate_measurements(canonical).where(F.col("indicator_id") == V.OUTCOME_INDICATOR)
    ranked = cells.where(F.col("observations") >= V.MIN_GROUP_OBSERVATIONS).select(
        "source_dataset", "age_group_code", "gender", F.col("value").alias("positive_rate"), "observations")
    return ranked.orderBy(F.desc("positive_rate"), F.desc("observations"), "age_group_code", "gender").limit(20)


# ---- formatting ------------------------------------------------------------------------------------------
@register
def fmt_normalise_names(t: Tables) -> DataFrame:
    raw = t.read("nation").toDF(" N-Nation  Key!", "n.name", "N Name")
    return normalize_columns(raw)


@register
def fmt_split_single_column(t: Tables) -> DataFrame:
    supplier = t.read("supplier")
    line = F.concat_ws(";", "s_suppkey", F.concat(F.lit(" "), "s_name"), "s_nationkey")
    lost = F.when(F.col("s_suppkey") % 10 == 0, F.concat_ws(";", "s_suppkey", "s_name")).otherwise(line)
    raw = supplier.select(lost.alias("S Suppkey;s-name;S_NationKey"))
    return formatting.split_single_column(raw, ["s_suppkey", "s_name", "s_nationkey"])


@register
def fmt_fingerprint(t: Tables) -> DataFrame:
    customer = t.read("customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return formatting.format_dataset(customer, "customer", RUN_TS)


# ---- scalars ---------------------------------------------------------------------------------------------
@register
def sc_parse_flags(t: Tables) -> DataFrame:
    rows = t.read("events").select("event_id", *_odd_texts())
    return rows.select(
        "event_id", st.parse_binary(F.col("word")).alias("flag"),
        st.parse_binary_or_positive(F.col("word")).alias("flag_or_positive"),
        st.parse_binary(F.col("event_id") % 3).alias("number_flag"),
    )


def _odd_texts() -> list:
    """A text column of every accepted and rejected spelling, derived from the row id."""
    words = ["YES", " y ", "2", "", "0", "0.0", "-3", "no", "N", "true", "1.0", "maybe", "7.25", "False"]
    return [F.get(F.array(*map(F.lit, words)), (F.col("event_id") % len(words)).cast("int")).alias("word")]


@register
def sc_flags_of_text(t: Tables) -> DataFrame:
    """Flags and numbers as the text of ``events.props`` and the first word of each document give them."""
    number = F.regexp_extract("props", '"k": *([^,}]*)', 1)
    events = t.read("events").select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), number.alias("word"))
    first = F.regexp_extract("text", r"^\s*(\S+)", 1)
    docs = t.read("documents").where("text is not null").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), first.alias("word"))
    return events.unionByName(docs).select(
        "kind", "id", st.parse_binary(F.col("word")).alias("flag"), st.parse_binary_or_positive(F.col("word")).alias("flag_or_positive"),
        st.to_double(F.col("word")).alias("number"), st.to_int(F.col("word")).alias("whole"))


@register
def sc_bands_of_text(t: Tables) -> DataFrame:
    """Bands and their midpoints as the text of ``events.props`` names them."""
    band = st.age_band_of_label(F.regexp_extract("props", '"k": *([^,}]*)', 1))
    return t.read("events").select("event_id", band.alias("band"), st.age_band_midpoint(band).alias("midpoint"))


@register
def sc_kinds_of_graph(t: Tables) -> DataFrame:
    """Nodes of the full graph by kind."""
    nodes = t.full.select(F.explode(F.array("s", F.when(F.col("o_kind") == "iri", F.col("o")))).alias("node")).where("node is not null").distinct()
    return nodes.groupBy(iri.node_kind(F.col("node")).alias("kind")).agg(F.count(F.lit(1)).alias("nodes"))


@register
def sc_parse_class(t: Tables) -> DataFrame:
    parsed = st.parse_gender(F.col("o_orderstatus"), ("f", "female"), ("o", "male"))
    return t.read("orders").select("o_orderkey", parsed.alias("gender"))


@register
def sc_band_ladder(t: Tables) -> DataFrame:
    years = F.floor(F.col("l_quantity") * 2)
    rows = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", st.age_band_of_years(years).alias("band"))
    return rows


@register
def sc_band_decode_midpoint(t: Tables) -> DataFrame:
    n = (F.col("event_id") % 17).cast("int")
    label = F.get(F.array(*map(F.lit, V.AGE_BAND_LABELS)), n)
    text = F.when(F.col("event_id") % 2 == 0, label).otherwise(F.concat(n.cast("string"), F.lit(".0")))
    band = st.age_band_of_label(F.coalesce(text, F.lit("old")))
    return t.read("events").select("event_id", band.alias("band"), st.age_band_midpoint(band).alias("midpoint"))


@register
def sc_stable_key(t: Tables) -> DataFrame:
    rows = t.read("part").select("p_partkey", "p_name", "p_brand", "p_size").withColumn("_lineage", F.lit("x"))
    return rows.select("p_partkey", st.stable_record_key(rows, "part").alias("record_key"))


@register
def sc_days_to_years(t: Tables) -> DataFrame:
    days = F.date_diff(F.lit("2026-01-01").cast("date"), F.col("o_orderdate").cast("date")) * 10
    return t.read("orders").select("o_orderkey", st.days_to_years(days).alias("years"))


@register
def sc_ratio_guarded(t: Tables) -> DataFrame:
    height = (F.col("p_size") - 10).cast("double")
    ratio = st.body_mass_index(F.col("p_retailprice"), height)
    return t.read("part").select("p_partkey", F.round(ratio, 6).alias("ratio"))


@register
def sc_slug_iri(t: Tables) -> DataFrame:
    name = F.when(F.col("p_partkey") % 7 == 0, " --- ").when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(
        F.concat_ws(" / ", "p_type", "p_brand", "p_name"))
    code = F.when(F.col("p_size") <= 13, F.col("p_size"))
    return t.read("part").select(
        "p_partkey", iri.slug(name).alias("slug"), iri.dataset_iri(name).alias("dataset"),
        iri.population_group_iri(code, F.col("p_brand")).alias("population_group"),
        iri.age_group_iri(code).alias("age_group"), iri.gender_iri(name).alias("gender"),
        iri.outcome_iri(F.when(F.col("p_size") > 5, F.col("p_size") > 25)).alias("outcome"),
        iri.record_iri(F.lit("part"), F.col("p_partkey"), F.lit(1)).alias("record"),
        iri.measurement_iri(F.lit("part"), code, F.col("p_brand"), F.lit("smoking")).alias("measurement"),
    )


@register
def sc_node_kind(t: Tables) -> DataFrame:
    kinds = [k for k, _ in V.NODE_KINDS] + ["record/", "x#predicate/"]
    prefix = F.get(F.array(*map(F.lit, kinds)), (F.col("p_partkey") % len(kinds)).cast("int"))
    node = F.concat(F.lit(V.HR), prefix, F.col("p_partkey").cast("string"))
    return t.read("part").select("p_partkey", iri.node_kind(node).alias("kind"))


@register
def sc_coercions(t: Tables) -> DataFrame:
    """Missing test and coercions on mixed text."""
    texts = ["12.7", "NaN", "abc", " 5 ", "-0.5", "1e3"]
    text = F.get(F.array(*map(F.lit, texts)), (F.col("event_id") % 7).cast("int"))
    number = F.nanvl(st.to_double(text), F.lit(None).cast("double"))
    return t.read("events").select(
        "event_id", text.isNull().alias("missing"), number.alias("number"), st.to_int(text).alias("whole"))


# ---- contracts -------------------------------------------------------------------------------------------
@register
def dq_rule_metrics(t: Tables) -> DataFrame:
    return t.trusted.quality


@register
def dq_quarantine(t: Tables) -> DataFrame:
    return t.trusted.quarantine


def _clean(name: str) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        return t.evaluated[name].clean()

    build.__name__ = f"dq_clean_{name}"
    return register(build)


for _name in ("orders", "lineitem", "events"):
    _clean(_name)


@register
def dq_uniqueness(t: Tables) -> DataFrame:
    """Rows and survivors per source: unique keys where the contract asks for it, all rows where it opts out."""
    parts = []
    for name, e in t.evaluated.items():
        first = F.get("_ok", F.lit(len(e.contract.rules))) if e.contract.unique else F.lit(True)
        parts.append(e.frame.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(first).alias("survivors"),
        ).select(F.lit(name).alias("dataset"), "rows", "survivors"))
    return harmonise.union_canonical(parts)


@register
def dq_required_sources(t: Tables) -> DataFrame:
    return contracts.missing_sources(t.canonical, ["orders", "lineitem", "events", "returns"])


# ---- harmonise -------------------------------------------------------------------------------------------
@register
def hz_canonical_union(t: Tables) -> DataFrame:
    return t.canonical


@register
def hz_profile(t: Tables) -> DataFrame:
    return harmonise.dataset_profile(t.canonical, RUN_TS)


@register
def hz_profile_listing(t: Tables) -> DataFrame:
    return harmonise.profile_listing(harmonise.dataset_profile(t.canonical, RUN_TS))


@register
def hz_measurements(t: Tables) -> DataFrame:
    return harmonise.aggregate_measurements(t.canonical)


def _by_runs(t: Tables, states: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The canonical rows as three runs, each aggregated alone and stored; all states read back."""
    root = _scratch(t)
    canonical = t.zone.canonical
    part = F.pmod(F.xxhash64("source_record_id"), F.lit(3))
    for run in range(3):
        snapshots.write_run(states(canonical.where(part == run)), root, "states", f"run-{run}")
    return t.spark.read.parquet(f"{root}/states")


@register
def hz_measurements_merged(t: Tables) -> DataFrame:
    return partials.merged_measurements(_by_runs(t, partials.measurement_states))


@register
def hz_profile_merged(t: Tables) -> DataFrame:
    return partials.merged_profile(_by_runs(t, partials.profile_states), RUN_TS)


@register
def hz_top_violations(t: Tables) -> DataFrame:
    return harmonise.top_violations(t.trusted.quality)


@register
def hz_top_reasons(t: Tables) -> DataFrame:
    return harmonise.top_reasons(t.trusted.quarantine)


@register
def hz_quarantine_summary(t: Tables) -> DataFrame:
    return harmonise.quarantine_summary(t.trusted.quality)


@register
def hz_coverage(t: Tables) -> DataFrame:
    return harmonise.coverage_matrix(t.canonical)


@register
def hz_rate_pivot(t: Tables) -> DataFrame:
    return harmonise.rate_pivot(patterns.outcome_by_age(t.analytics), ["orders", "lineitem", "events"])


@register
def hz_value_counts(t: Tables) -> DataFrame:
    return harmonise.value_counts(t.canonical, ["source_dataset", "target"])


@register
def hz_describe(t: Tables) -> DataFrame:
    described = harmonise.describe_columns(t.canonical, ["age_years_proxy", "age_group_code"])
    return described.select("column", "rows", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@register
def hz_spread(t: Tables) -> DataFrame:
    return harmonise.indicator_spread(patterns.indicator_consistency(t.analytics))


@register
def hz_lineage(t: Tables) -> DataFrame:
    return harmonise.lineage(t.canonical)


@register
def hz_row_audit(t: Tables) -> DataFrame:
    return harmonise.row_audit({
        **{f"trusted.{n}": df for n, df in t.trusted.clean.items()}, "metadata.quarantine": t.trusted.quarantine,
        "metadata.quality_report": t.trusted.quality,
    })


# ---- graph -----------------------------------------------------------------------------------------------
@register
def kg_schema(t: Tables) -> DataFrame:
    """Fixed vocabulary joined to the data: how often each schema and vocabulary node is used by the records."""
    fixed = triples.schema_triples(t.spark).unionByName(triples.vocabulary_triples(t.spark))
    use = t.full.where(F.col("o_kind") == "iri").groupBy(F.col("o").alias("s")).agg(F.count(F.lit(1)).alias("used"))
    return fixed.join(use, "s", "left").select("s", "p", "o", "o_kind", "o_type", F.coalesce("used", F.lit(0)).alias("used"))


@register
def kg_record_triples(t: Tables) -> DataFrame:
    return triples.record_triples(t.zone.records)


@register
def kg_measurement_triples(t: Tables) -> DataFrame:
    return triples.measurement_triples(t.zone.measurements)


@register
def kg_groups(t: Tables) -> DataFrame:
    return triples.population_groups(t.canonical)


@register
def kg_datasets_run(t: Tables) -> DataFrame:
    profile = t.zone.profile
    return triples.dataset_triples(profile).unionByName(triples.run_triples(profile, RUN_ID, RUN_TS))


@register
def kg_full(t: Tables) -> DataFrame:
    return t.full


@register
def kg_analytics(t: Tables) -> DataFrame:
    return t.analytics


@register
def kg_closure(t: Tables) -> DataFrame:
    """Closure of both schema hierarchies, read from the analytics graph."""
    return entailment.closure(
        entailment.schema_edges(t.analytics, V.RDFS_SUBCLASS).unionByName(
            entailment.schema_edges(t.analytics, V.RDFS_SUBPROPERTY)))


@register
def kg_rdfs7(t: Tables) -> DataFrame:
    return entailment.inferred_triples(t.full, t.schema, skip_subclass=True)


@register
def kg_by_numbers(t: Tables) -> DataFrame:
    """Sub-property entailment on the dictionary-encoded graph, decoded at the end."""
    encoded = dictionary.encode(t.full)
    return dictionary.decode(cut(dictionary.inferred_ids(encoded, t.schema)), encoded.terms_with(t.schema))


@register
def kg_incremental(t: Tables) -> DataFrame:
    """The graph as two runs: the second one's delta against the stored entailment of the first."""
    root = _scratch(t)
    ntriples.write_partitioned(t.full.withColumn("late", F.pmod(F.xxhash64("s"), F.lit(4)) == 0), f"{root}/graph", "late", "p")
    graph = t.spark.read.schema(f"{triples.TRIPLE_SCHEMA}, late boolean").parquet(f"{root}/graph")
    new, stored = graph.where("late").drop("late"), graph.where("not late").drop("late")
    inferred = cut(entailment.inferred_triples(stored, t.schema, skip_subclass=True), codec="zstd")
    added, removed = entailment.entailed_delta(new, stored, inferred, t.schema, skip_subclass=True)
    return entailment.with_delta(inferred, added, removed)


@register
def kg_rdfs9(t: Tables) -> DataFrame:
    return entailment.inferred_triples(t.analytics, t.schema)


@register
def kg_inferred_count(t: Tables) -> DataFrame:
    full = entailment.inferred_triples(t.full, t.schema, skip_subclass=True)
    small = entailment.inferred_triples(t.analytics, t.schema)
    return harmonise.row_audit({"full": full, "analytics": small})


@register
def kg_validation(t: Tables) -> DataFrame:
    return triples.manifest_counts(t.zone.canonical, t.zone.measurements, t.full, groups=True)


# ---- patterns --------------------------------------------------------------------------------------------
def _pattern(key: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    def build(t: Tables) -> DataFrame:
        return operator(t.analytics)

    build.__name__ = key
    register(build)


_pattern("pat_02_shared_indicators", patterns.shared_indicators)
_pattern("pat_03_rank_groups", patterns.rank_groups)
_pattern("pat_04_combine_indicators", patterns.combine_indicators)
_pattern("pat_06_consistency", patterns.indicator_consistency)
_pattern("pat_07_outcome_by_age", patterns.outcome_by_age)
_pattern("pat_structure", patterns.structure_summary)
_pattern("pat_avg_rate", patterns.average_rate)


@register
def pat_01_entities(t: Tables) -> DataFrame:
    graph = t.record_graph("belongsToPopulationGroup", "fromDataset", "hasOutcome")
    return patterns.entities_of_group(graph, t.vocabulary)


@register
def pat_05_multi_source_groups(t: Tables) -> DataFrame:
    return patterns.multi_source_groups(t.record_graph("belongsToPopulationGroup", "fromDataset"))


@register
def pat_08_cooccurrence(t: Tables) -> DataFrame:
    return patterns.cooccurring_risk_factors(t.record_graph("hasObservedRiskFactor", "hasOutcome"), t.vocabulary)


@register
def pat_09_inferred_factors(t: Tables) -> DataFrame:
    graph = t.record_graph("hasObservedRiskFactor", "hasObservedProtectiveFactor", "hasOutcome")
    entailed = entailment.materialise(graph, t.schema, skip_subclass=True)
    return patterns.inferred_factors(entailed, t.vocabulary)


@register
def pat_00_match_join(t: Tables) -> DataFrame:
    """Two patterns joined on their shared variable: measured indicators per dataset, as a bag."""
    measured = patterns.match(t.analytics, triples.hr("measuresIndicator"), s="m", o="indicator")
    source = patterns.match(t.analytics, triples.hr("fromDataset"), s="m", o="dataset")
    return patterns.join_patterns(measured, source).groupBy("indicator", "dataset").agg(F.count(F.lit(1)).alias("n"))


@register
def pat_report_rows(t: Tables) -> DataFrame:
    report = patterns.report_rows(pat_05_multi_source_groups(t), row_cap=20)
    return report.select("rows_returned", F.size("rows").alias("rows_shown"), "row_cap_applied")


# ---- vectors ---------------------------------------------------------------------------------------------
@register
def emb_iri_triples(t: Tables) -> DataFrame:
    graph = t.analytics_entailed
    return embedding.iri_triples(graph, embedding.held_out_nodes(graph))


@register
def emb_edges(t: Tables) -> DataFrame:
    graph = t.analytics_entailed
    return embedding.typed_edges(embedding.iri_triples(graph, embedding.held_out_nodes(graph)))


@register
def emb_adjacency(t: Tables) -> DataFrame:
    entries = embedding.normalised_adjacency(cut(emb_edges(t)))
    return entries.select("i", "j", F.round("w", 9).alias("w"))


@register
def emb_svd(t: Tables) -> DataFrame:
    return embedding.rounded_vectors(embedding.svd_embedding(cut(emb_edges(t))))


@register
def emb_train(t: Tables) -> DataFrame:
    _, table = embedding.best_model(cut(emb_iri_triples(t)))
    return table


def _vec(t: Tables) -> DataFrame:
    double = F.transform("embedding", lambda x: x.cast("double"))
    return t.read("embeddings").select(F.col("vec_id").cast("string").alias("node"), double.alias("vec"), "vec_id", "label")


@register
def emb_rank_metrics(t: Tables) -> DataFrame:
    """Every vector asks for its successor by id; ranks over all vectors."""
    v = _vec(t)
    nxt = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("node").alias("target"), F.col("vec").alias("t"))
    queries = v.select("vec_id", F.col("node").alias("query_id"), F.col("vec").alias("q")).join(nxt, "vec_id")
    return embedding.rank_metrics(embedding.target_ranks(queries.drop("vec_id"), v.select("node", "vec")))


@register
def emb_rank_filtered(t: Tables) -> DataFrame:
    """As above, over coarse vectors that tie often: ties count a half, other vectors of the target's label are left out."""
    coarse = F.transform("vec", lambda x: F.when(x > 0, 1.0).otherwise(0.0))
    v = cut(_vec(t).withColumn("vec", coarse))
    nxt = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("node").alias("target"), F.col("vec").alias("t"), F.col("label").alias("wanted"))
    queries = v.select("vec_id", F.col("node").alias("query_id"), F.col("vec").alias("q")).join(nxt, "vec_id").drop("vec_id")
    ranks = embedding.target_ranks(queries, v.select("node", "vec", "label"), average_ties=True, apart=("wanted", "label"))
    return embedding.rank_metrics(ranks)


@register
def emb_mean(t: Tables) -> DataFrame:
    """Mean vector per source over the label groups its documents fall in, in long form."""
    v = _vec(t)
    members = t.read("documents").select("source", "lang", F.col("doc_id").cast("string").alias("node"))
    means = features.mean_embedding(members, v, ["source", "lang"], 64)
    return means.select("source", "lang", F.posexplode("vec").alias("pos", "x")).select(
        "source", "lang", "pos", F.round("x", 6).alias("value"))


def _node_vectors(t: Tables) -> DataFrame:
    """Table vectors assigned by hash to the dataset, group and indicator nodes; one group stays without."""
    nodes = t.analytics.where(
        F.col("s").startswith(V.hr("dataset/")) | F.col("s").startswith(V.hr("population-group/"))
        | F.col("s").startswith(V.hr("indicator/"))
    ).select(F.col("s").alias("node")).distinct().where(F.col("node") != V.hr("population-group/age-13/gender-male"))
    v = _vec(t)
    place = F.conv(F.substring(F.md5("node"), 1, 6), 16, 10).cast("long") % v.count()
    return nodes.withColumn("vec_id", place).join(v.select("vec_id", "vec"), "vec_id").select("node", "vec")


def _checksums(features_col: str, dim: int) -> list:
    """Two order-sensitive sums per row stand for the whole vector."""
    f = F.col(features_col)
    weights = F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda k: k.cast("double"))
    return [F.size(f).alias("width"), F.round(F.aggregate(f, F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
            F.round(vectors.dot(f, weights), 4).alias("weighted")]


@register
def emb_kg_features(t: Tables) -> DataFrame:
    rows = features.kg_features(t.records, cut(_node_vectors(t)), 64, _checksums("features", 7 * 64 + 3))
    return rows.drop("record_ordinal")


@register
def emb_hybrid_features(t: Tables) -> DataFrame:
    rows = features.hybrid_features(t.records, cut(_node_vectors(t)), 64)
    joined = rows.withColumn("kg", F.concat("kg_group", "kg_dataset", "kg_interact"))
    tabular = [c for c in rows.columns if c.startswith("tab_")]
    return joined.select("source_dataset", "source_record_id", "target", *tabular, *_checksums("kg", 3 * 64))


# ---- sampling --------------------------------------------------------------------------------------------
SAMPLE_ROWS = 5000


def _identity():
    return models.record_identity()


@register
def smp_stratified(t: Tables) -> DataFrame:
    chosen = sampling.stratified_sample(t.records, ["source_dataset", "target"], _identity(), SAMPLE_ROWS)
    return chosen.select("source_dataset", "source_record_id", "target")


@register
def smp_trimmed(t: Tables) -> DataFrame:
    chosen = sampling.stratified_sample(
        t.records, ["source_dataset", "target", "age_group_code"], _identity(), 999, trim=True)
    return chosen.select("source_dataset", "source_record_id", "target")


@register
def smp_split(t: Tables) -> DataFrame:
    split = sampling.stratified_split(t.records, "target", _identity())
    return split.select("source_dataset", "source_record_id", "target", "is_test")


@register
def smp_folds(t: Tables) -> DataFrame:
    return sampling.stratified_folds(t.records, "target", _identity()).select(
        "source_dataset", "source_record_id", "target", "fold")


@register
def smp_class_weights(t: Tables) -> DataFrame:
    weights = sampling.class_weights(t.canonical, "target")
    return weights.select("target", "rows", F.round("weight", 9).alias("weight"))


@register
def smp_model_frame(t: Tables) -> DataFrame:
    return features.model_frame(t.records, V.ENRICHED_NUMERIC, V.ENRICHED_CATEGORICAL).drop("record_ordinal")


@register
def smp_impute_stats(t: Tables) -> DataFrame:
    stats = features.impute_stats(t.records, ["age_years_proxy", "bmi", "systolic_bp", "diastolic_bp"])
    return stats.select("feature", F.round("median", 6).alias("median"), F.round("mean", 6).alias("mean"),
                        F.round("deviation", 6).alias("deviation"))


@register
def smp_level_modes(t: Tables) -> DataFrame:
    frame = features.model_frame(t.records, V.CORE_NUMERIC, V.CORE_CATEGORICAL)
    return features.level_modes(frame, V.CORE_CATEGORICAL)


@register
def smp_class_guard(t: Tables) -> DataFrame:
    """Per source: smallest class, whether both classes are present, whether they can be stratified."""
    counts = t.canonical.groupBy("source_dataset").agg(
        F.count_if(F.col("target")).alias("positive"), F.count_if(~F.col("target")).alias("negative"))
    least = F.least("positive", "negative")
    return counts.select("source_dataset", least.alias("smallest"), (least > 0).alias("two_classes"), (least >= 2).alias("can_stratify"))


# ---- evaluation ------------------------------------------------------------------------------------------
def _scored(t: Tables) -> DataFrame:
    """Label and a score with many distinct values and ties, over all canonical records."""
    return t.canonical.select(
        "source_dataset", F.col("target").cast("int").alias("y"),
        (F.coalesce("systolic_bp", F.col("bmi") * 5) / 300.0).alias("p"))


def _predicted(t: Tables) -> DataFrame:
    return _scored(t).withColumn("pred", (F.col("p") >= 0.5).cast("int"))


@register
def ev_threshold(t: Tables) -> DataFrame:
    return metrics.f1_threshold(_scored(t)).select(F.round("threshold", 9).alias("threshold"))


@register
def ev_confusion(t: Tables) -> DataFrame:
    return metrics.confusion(_predicted(t))


@register
def ev_point_metrics(t: Tables) -> DataFrame:
    points = metrics.point_metrics(metrics.confusion(_predicted(t)))
    return points.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register
def ev_roc_auc(t: Tables) -> DataFrame:
    return metrics.roc_auc(_scored(t)).select(F.round("roc_auc", 9).alias("roc_auc"))


@register
def ev_average_precision(t: Tables) -> DataFrame:
    return metrics.average_precision(_scored(t)).select(F.round("pr_auc", 9).alias("pr_auc"))


@register
def ev_documents(t: Tables) -> DataFrame:
    """Document length as a score for the toxicity label."""
    scored = t.read("labels").join(t.read("documents").select("doc_id", "n_chars"), "doc_id").select(
        F.col("toxic").alias("y"), F.col("n_chars").cast("double").alias("p"))
    result = metrics.classification_metrics(scored, 1000.0)
    return result.select(*[F.round(c, 9).alias(c) for c in V.METRIC_KEYS])


# The three sources play the roles of three model pipelines.
ROLES = (("orders", "tabular_core"), ("lineitem", "tabular_enriched"), ("events", "kg_embedding"))


def _comparison(t: Tables) -> DataFrame:
    scored = cut(_scored(t))
    reports = []
    for source, name in ROLES:
        result = metrics.classification_metrics(scored.where(F.col("source_dataset") == source), 0.5)
        reports.append(result.select(
            F.lit(name).alias("pipeline"), F.lit(source).alias("selected_model"),
            *[F.round(c, 9).alias(c) for c in V.METRIC_KEYS]))
    return comparison.comparison_table([*reports, None])


@register
def ev_comparison(t: Tables) -> DataFrame:
    return _comparison(t)


@register
def ev_best_per_metric(t: Tables) -> DataFrame:
    return comparison.best_per_metric(cut(_comparison(t)), [name for _, name in ROLES])


@register
def ev_deltas(t: Tables) -> DataFrame:
    return comparison.deltas_vs_tabular(cut(_comparison(t)))


@register
def ev_cv_table(t: Tables) -> DataFrame:
    """Group rates stand for scores: sources are pipelines, genders are candidate models."""
    rates = t.canonical.groupBy("source_dataset", "gender").agg(
        F.round(F.avg(F.col("target").cast("double")), 6).alias("m"),
        F.round(F.avg(F.col("high_cholesterol_flag").cast("double")), 6).alias("s"))
    name = F.when(F.col("source_dataset") == "orders", "roc_auc").otherwise("pr_auc")
    scores = F.create_map(
        F.concat(F.lit("cv_"), name, F.lit("_mean")), F.col("m"), F.concat(F.lit("cv_"), name, F.lit("_std")), F.col("s"))
    reports = rates.groupBy(F.col("source_dataset").alias("pipeline")).agg(
        F.map_from_entries(F.collect_list(F.struct("gender", scores))).alias("candidate_models"))
    return comparison.cv_table_from_map(reports)


# ---- models ----------------------------------------------------------------------------------------------
@register
def ml_candidates(t: Tables) -> DataFrame:
    """Core and enriched pipelines: selection among the tabular candidates, threshold, test metrics."""
    core = models.train_core(t.records)
    enriched = models.train_enriched(t.records)
    return comparison.comparison_table([core.report, enriched.report])


def _graph_vectors(t: Tables) -> DataFrame:
    return cut(embedding.svd_embedding(cut(emb_edges(t))))


@register
def ml_graph_model(t: Tables) -> DataFrame:
    """Classifier on graph features alone, over spectral node vectors."""
    trained = models.train_kg(t.records, _graph_vectors(t))
    return comparison.comparison_table([trained.report])


@register
def ml_hybrid_model(t: Tables) -> DataFrame:
    """Classifier on tabular and graph features together."""
    trained = models.train_hybrid(t.records, _graph_vectors(t))
    return comparison.comparison_table([trained.report])


@register
def ml_importance(t: Tables) -> DataFrame:
    trained = models.train_core(t.records)
    return models.feature_importance(trained.selected.model, trained.selected.names)


@register
def pat_by_subject(t: Tables) -> DataFrame:
    """Groups of several sources from a stored graph that is bucketed by subject."""
    stored = tables.write_by_subject(
        t.record_graph("belongsToPopulationGroup", "fromDataset"), f"by_subject_{uuid.uuid4().hex}", 8, f"{_scratch(t)}/graph")
    return patterns.multi_source_groups(stored)


@register
def dq_one_write(t: Tables) -> DataFrame:
    """Metrics of all sources, each observed while one write made its clean rows and its quarantine."""
    return zones.assemble_trusted([e.split() for e in t.evaluated.values()]).quality


@register
def dq_one_write_quarantine(t: Tables) -> DataFrame:
    return zones.assemble_trusted([e.split() for e in t.evaluated.values()]).quarantine


@register
def io_published(t: Tables) -> DataFrame:
    """Two runs of a table; the pointer moves to the second, obsolete pointers go, and the published rows are read."""
    root, database = _scratch(t), f"zone_{uuid.uuid4().hex}"
    supplier = t.read("supplier")
    for run, rows in (("run-a", supplier.where("s_acctbal > 0")), ("run-b", supplier)):
        snapshots.write_run(rows, root, "supplier", run)
        tables.publish_run(t.spark, root, database, {"kept": "supplier", "obsolete": "supplier"}, run)
    tables.drop_obsolete(t.spark, database, ["kept"])
    names = [r.table_name for r in tables.list_tables(t.spark, database).collect()]
    return tables.read_tables(t.spark, database, names)["kept"]


# ---- sources, sinks, streams --------------------------------------------------------------------------------
def _scratch(t: Tables) -> str:
    return scratch(t.spark, "io")


@register
def io_snapshot_latest(t: Tables) -> DataFrame:
    """Two snapshots of a table; the later one is read back, then published under a run id and read again."""
    root = _scratch(t)
    supplier = t.read("supplier")
    snapshots.write_snapshot(supplier.where(F.col("s_acctbal") > 0), root, "supplier", "20260101_000000")
    snapshots.write_snapshot(supplier, root, "supplier", "20260102_000000")
    latest = snapshots.read_latest(t.spark, root, "supplier")
    snapshots.write_run(latest, root, "supplier_runs", "run-a")
    return snapshots.read_run(t.spark, root, "supplier_runs", "run-a")


@register
def io_ntriples_roundtrip(t: Tables) -> DataFrame:
    """Document texts as literals: export, import, and every triple must be the one that went in."""
    node = F.concat(F.lit(V.HR), F.lit("document/"), F.col("doc_id").cast("string"))
    graph = triples.emit(t.read("documents"), [
        triples.literal(node, V.RDFS_COMMENT, F.col("text")),
        triples.literal(node, V.hr("observationCount"), F.col("n_chars"), "integer"),
        triples.link(node, V.RDF_TYPE, F.lit(V.hr("Dataset"))),
    ])
    path = f"{_scratch(t)}/graph"
    ntriples.write_ntriples(graph, path)
    return ntriples.read_ntriples(t.spark, path)


@register
def io_ntriples_odd(t: Tables) -> DataFrame:
    """Lines as other writers put them, from documents: blank nodes, no spaces, tags, code points, comments, broken lines."""
    docs = t.read("documents").select(F.col("doc_id").cast("string").alias("d"), "lang", "source", "n_chars")
    d, lang, source = F.col("d"), F.col("lang"), F.col("source")
    lines = F.array(
        F.concat(F.lit("_:d"), d, F.lit(" <urn:in> _:"), source, F.lit(" .")), F.concat(F.lit("<urn:d:"), d, F.lit("><urn:lang><urn:l:"), lang, F.lit(">.")),
        F.concat(F.lit("<urn:d:"), d, F.lit('>\t<urn:note> "\\u00e9 \\\\'), source, F.lit('"@'), lang, F.lit(" . # as told")),
        F.concat(F.lit("# "), d), F.concat(F.lit("<urn:d:"), d, F.lit("> broken "), source))
    rows = docs.select(F.explode(lines).alias("value"))
    path = f"{_scratch(t)}/lines"
    rows.write.text(path)
    failed = ntriples.malformed(t.spark.read.text(path)).select(
        F.lit("malformed").alias("s"), F.lit("urn:line").alias("p"), F.col("value").alias("o"), F.lit("literal").alias("o_kind"), F.lit(None).cast("string").alias("o_type"))
    return ntriples.read_ntriples(t.spark, path).unionByName(failed)


@register
def st_ingest_unique(t: Tables) -> DataFrame:
    """Lines keyed by their order, in several files taken two at a time: uniqueness holds over all batches."""
    root = _scratch(t)
    lines = t.read("lineitem")
    lines.repartition(5).write.parquet(f"{root}/incoming")
    keyed = lambda df: lineitem_from(df, F.col("l_orderkey").cast("string"))
    run = ingest_new_files(
        t.spark, f"{root}/incoming", "parquet", lines.schema, keyed, LINEITEM_CONTRACT, f"{root}/out", f"{root}/state", RUN_ID, RUN_TS, max_files=2)
    run.awaitTermination()
    found = t.spark.read.parquet(f"{root}/out/metrics").where(F.col("rule_name") != contracts.TOTAL_RULE)
    return found.groupBy("rule_name").agg(F.sum("total_rows").alias("total_rows"), F.sum("violations").alias("violations"))


@register
def st_ingest_contract(t: Tables) -> DataFrame:
    """The events contract over a file stream; the metrics table it leaves behind."""
    root = _scratch(t)
    events = t.read("events")
    events.write.parquet(f"{root}/incoming")
    run = ingest_new_files(
        t.spark, f"{root}/incoming", "parquet", events.schema, events_from, EVENTS_CONTRACT, f"{root}/out",
        f"{root}/state", RUN_ID, RUN_TS)
    run.awaitTermination()
    return t.spark.read.parquet(f"{root}/out/metrics").groupBy("rule_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("violations").alias("violations"))
