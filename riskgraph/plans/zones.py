"""The zones end to end: raw frames -> trusted tables -> canonical table -> graphs. All lazy until written."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskgraph import vocabulary as V
from riskgraph.operators import entailment, harmonise, triples
from riskgraph.operators.catalogue import SOURCES
from riskgraph.operators.contracts import Evaluated, Split, evaluate, require_sources, union_quarantine
from riskgraph.operators.formatting import format_dataset
from riskgraph.operators.harmonise import union_canonical
from riskgraph.operators.lineage import cut


@dataclass(frozen=True)
class Trusted:
    clean: Mapping[str, DataFrame]
    quarantine: DataFrame
    quality: DataFrame


@dataclass(frozen=True)
class Exploitation:
    """Canonical table and what is derived from it; ``records`` carries the ordinal that makes record IRIs unique."""

    canonical: DataFrame
    records: DataFrame
    profile: DataFrame
    measurements: DataFrame


@dataclass(frozen=True)
class Graphs:
    schema: DataFrame
    full: DataFrame
    full_inferred: DataFrame
    analytics: DataFrame
    analytics_inferred: DataFrame

    @property
    def full_entailed(self) -> DataFrame:
        return self.full.unionByName(self.full_inferred)

    @property
    def analytics_entailed(self) -> DataFrame:
        return self.analytics.unionByName(self.analytics_inferred)


def formatted(raw: Mapping[str, DataFrame], run_ts: str) -> dict[str, DataFrame]:
    return {name: format_dataset(df, name, run_ts, SOURCES[name][2]) for name, df in raw.items()}


def assemble_trusted(parts: list[Evaluated] | list[Split]) -> Trusted:
    spark = parts[0].metrics().sparkSession
    return Trusted(
        {e.contract.dataset: e.clean() for e in parts},
        union_quarantine(spark, [e.quarantine() for e in parts]),
        union_canonical([e.metrics() for e in parts]),
    )


def trusted(frames: Mapping[str, DataFrame], run_id: str, run_ts: str, share: bool = True) -> Trusted:
    """Evaluate each source's contract; with ``share`` one write of a source makes all three outputs."""
    parts = []
    for name, df in frames.items():
        standardise, contract, _ = SOURCES[name]
        checked = evaluate(standardise(df), contract, run_id, run_ts)
        parts.append(checked.split() if share else checked)
    return assemble_trusted(parts)


def exploitation(
    clean: Mapping[str, DataFrame], run_id: str, run_ts: str, fields: Mapping[str, Mapping] = harmonise.FIELDS,
    unique_sources: tuple[str, ...] = (V.CARDIO, V.CLEVELAND), keep: Callable[[DataFrame], DataFrame] = cut,
) -> Exploitation:
    """``keep`` writes the canonical table once; profile, measurements and records then read columns of it."""
    parts = [harmonise.to_canonical(df, name, run_id, run_ts, fields[name]) for name, df in clean.items()]
    canonical = keep(union_canonical(parts))
    return Exploitation(
        canonical, harmonise.with_record_ordinal(canonical, unique_sources),
        harmonise.dataset_profile(canonical, run_ts), harmonise.aggregate_measurements(canonical),
    )


def full_graph(zone: Exploitation, run_id: str, run_ts: str) -> DataFrame:
    return triples.full_graph(zone.records, zone.canonical, zone.profile, zone.measurements, run_id, run_ts)


def analytics_graph(zone: Exploitation, run_id: str, run_ts: str) -> DataFrame:
    """The compact graph, written once: it grows with sources, groups and indicators, not with records."""
    return cut(triples.analytics_graph(zone.profile, zone.measurements, run_id, run_ts))


def graphs(zone: Exploitation, run_id: str, run_ts: str) -> Graphs:
    """Both graphs with their entailment: sub-properties on the full graph, sub-classes too on the small one."""
    schema = triples.schema_triples(zone.canonical.sparkSession)
    full, analytics = full_graph(zone, run_id, run_ts), analytics_graph(zone, run_id, run_ts)
    return Graphs(
        schema, full, entailment.inferred_triples(full, schema, skip_subclass=True),
        analytics, entailment.inferred_triples(analytics, schema),
    )


def run(raw: Mapping[str, DataFrame], run_id: str, run_ts: str) -> tuple[Trusted, Exploitation, Graphs]:
    """Raw frames of the three sources to graphs."""
    safe = trusted(formatted(raw, run_ts), run_id, run_ts)
    zone = exploitation(safe.clean, run_id, run_ts)
    require_sources(zone.canonical, list(V.REQUIRED_SOURCES))
    return safe, zone, graphs(zone, run_id, run_ts)
