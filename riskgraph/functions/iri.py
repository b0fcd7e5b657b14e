"""IRI builders, typed-literal text and node kinds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskgraph import vocabulary as V


def slug(col: Column, fallback: str = "unknown") -> Column:
    """Lower-case words joined by dashes; nothing left means the fallback."""
    words = F.regexp_replace(F.lower(F.trim(col.cast("string"))), "[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(words, "^-|-$", "")
    return F.coalesce(F.regexp_replace(trimmed, "^$", fallback), F.lit(fallback))


def _iri(*parts: Column | str) -> Column:
    return F.concat(F.lit(V.HR), *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _or_unknown(code: Column) -> Column:
    return F.coalesce(code.cast("string"), F.lit("unknown"))


def dataset_iri(name: Column) -> Column:
    return _iri("dataset/", slug(name))


def indicator_iri(indicator_id: Column | str) -> Column:
    return _iri("indicator/", indicator_id)


def age_group_iri(code: Column) -> Column:
    return _iri("age-group/", _or_unknown(code))


def gender_iri(gender: Column) -> Column:
    return _iri("gender/", slug(gender))


def population_group_iri(code: Column, gender: Column) -> Column:
    return _iri("population-group/age-", _or_unknown(code), "/gender-", slug(gender))


def outcome_iri(target: Column) -> Column:
    positive, negative, unknown = (name for name, _ in V.OUTCOMES)
    return _iri(F.when(target, positive).when(~target, negative).otherwise(unknown))


def record_hash(record_id: Column, ordinal: Column) -> Column:
    return F.sha1(F.concat(F.coalesce(record_id.cast("string"), F.lit("None")), F.lit("|"), ordinal.cast("string")))


def record_iri(dataset: Column, record_id: Column, ordinal: Column) -> Column:
    return _iri("record/", slug(dataset), "/", record_hash(record_id, ordinal))


def measurement_iri(dataset: Column, code: Column, gender: Column, indicator_id: Column) -> Column:
    return _iri(
        "aggregate-measurement/", slug(dataset), "/age-", _or_unknown(code), "/gender-", slug(gender), "/", indicator_id
    )


def double_text(col: Column) -> Column:
    """Plain decimal text of a double already rounded to at most six places (no exponent form)."""
    return F.coalesce(col.try_cast("decimal(20,6)").cast("string"), col.cast("string"))


def node_kind(node: Column) -> Column:
    """Kind of a node by IRI prefix; the first match of the fixed table wins."""
    by_prefix = reduce(
        lambda chain, kind: chain.when(node.startswith(V.hr(kind[0])), kind[1]),
        V.NODE_KINDS[1:],
        F.when(node.startswith(V.hr(V.NODE_KINDS[0][0])), V.NODE_KINDS[0][1]),
    )
    return by_prefix.when(node.contains(V.PREDICATE_MARK), "predicate").otherwise("other")
