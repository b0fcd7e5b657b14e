"""Materialising RDFS entailment: sub-property (rdfs7) and sub-class (rdfs9) propagation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators.joins import lookup_join
from riskgraph.operators.lineage import cut
from riskgraph.operators.triples import TRIPLE_COLUMNS


def closure(pairs: DataFrame) -> DataFrame:
    """Transitive closure of ``(child, parent)`` edges of a schema, as one recursive query.

    A path does not come back to a node it has been at, which ends cycles. A hierarchy deeper than 1,000 raises.
    """
    return pairs.sparkSession.sql(
        """
        WITH RECURSIVE reached(child, parent, path) MAX RECURSION LEVEL 1000 AS (
          SELECT child, parent, array(parent) FROM (SELECT DISTINCT child, parent FROM {edges})
          UNION ALL
          SELECT r.child, e.parent, r.path || array(e.parent)
          FROM reached r JOIN {edges} e ON r.parent = e.child WHERE NOT array_contains(r.path, e.parent))
        SELECT DISTINCT child, parent FROM reached
        """, edges=pairs)


def schema_edges(graph: DataFrame, relation: str) -> DataFrame:
    return graph.where(F.col("p") == relation).select(F.col("s").alias("child"), F.col("o").alias("parent"))


def subproperty_triples(graph: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s p o), p under q  =>  (s q o). The few closure pairs travel, the triples stay where they are."""
    lookup = pairs.select(F.col("child").alias("p"), F.col("parent").alias("q"))
    return lookup_join(graph, lookup, "p").select("s", F.col("q").alias("p"), "o", "o_kind", "o_type")


def subclass_triples(graph: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s type c), c under d  =>  (s type d)."""
    lookup = pairs.select(F.col("child").alias("o"), F.col("parent").alias("d"))
    typed = graph.where((F.col("p") == V.RDF_TYPE) & (F.col("o_kind") == "iri"))
    return lookup_join(typed, lookup, "o").select("s", "p", F.col("d").alias("o"), "o_kind", "o_type")


def inferred_triples(graph: DataFrame, schema: DataFrame | None = None, skip_subclass: bool = False) -> DataFrame:
    """New distinct triples of one entailment pass.

    ``schema`` holds the hierarchies; pass it when it is known apart from the data, so that the closure does not
    scan the whole graph. Each triple yields what it entails, and itself where an inference could repeat it; only their
    numbers are shuffled (``_fresh``).
    """
    axioms = graph if schema is None else schema
    # Written, so that the planner knows how few they are: of a recursive query it does not, and would move the graph.
    properties = cut(closure(schema_edges(axioms, V.RDFS_SUBPROPERTY)))
    heirs = _parents(properties).select(F.col("child").alias("p"), F.col("parents").alias("_above"))
    below = properties.select(F.col("parent").alias("p")).distinct().withColumn("_head", F.lit(True))
    marked = lookup_join(lookup_join(graph, heirs, "p", "left"), below, "p", "left")
    again = F.transform(F.coalesce("_above", F.array()), lambda q: F.struct(q.alias("p"), F.col("o").alias("o"), F.lit(True).alias("_new")))
    known = F.col("_head").isNotNull()
    if not skip_subclass:
        classes = cut(closure(schema_edges(axioms, V.RDFS_SUBCLASS)))
        typed = (F.col("p") == V.RDF_TYPE) & (F.col("o_kind") == "iri")
        kinds = _parents(classes).select(F.col("child").alias("o"), F.col("parents").alias("_kinds"))
        tops = classes.select(F.col("parent").alias("o")).distinct().withColumn("_top", F.lit(True))
        marked = lookup_join(lookup_join(marked, kinds, "o", "left"), tops, "o", "left")
        broader = F.when(typed, F.col("_kinds"))
        again = F.concat(again, F.transform(F.coalesce(broader, F.array()), lambda d: F.struct(F.col("p").alias("p"), d.alias("o"), F.lit(True).alias("_new"))))
        known |= (F.col("p") == V.RDF_TYPE) & F.col("_top").isNotNull()
    own = F.when(known, F.array(F.struct(F.col("p").alias("p"), F.col("o").alias("o"), F.lit(False).alias("_new")))).otherwise(F.array())
    each = marked.select("s", "o_kind", "o_type", F.explode(F.concat(own, again)).alias("t"))
    triples = each.select("s", F.col("t.p").alias("p"), F.col("t.o").alias("o"), "o_kind", "o_type", F.col("t._new").alias("_new"))
    return _fresh(triples)


def _fresh(marked: DataFrame) -> DataFrame:
    """Each triple once that is derived (``_new``) and nowhere asserted.

    The one shuffle moves a 64-bit hash of each triple, not its terms. A derived triple that shares its hash with no other
    row is fresh where it stands; the others, copies and collisions alike, are gathered and compared by their terms.
    """
    hashed = marked.withColumn("_hash", F.xxhash64(*TRIPLE_COLUMNS))
    met = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.bool_or("_new").alias("_any"))
    shared = cut(met.where("_n > 1 AND _any").select("_hash"))
    if shared.isEmpty():
        return marked.where("_new").select(*TRIPLE_COLUMNS)
    alone = lookup_join(hashed.where("_new"), shared, "_hash", "left_anti").select(*TRIPLE_COLUMNS)
    gathered = lookup_join(hashed, shared, "_hash", "left_semi").groupBy(*TRIPLE_COLUMNS).agg(F.every("_new").alias("_only"))
    return alone.unionByName(gathered.where("_only").select(*TRIPLE_COLUMNS))


def entailed_delta(new: DataFrame, stored: DataFrame, inferred: DataFrame, schema: DataFrame, skip_subclass: bool = False) -> tuple[DataFrame, DataFrame]:
    """What a run of ``new`` triples changes in the ``inferred`` ones of a ``stored`` graph: (added, removed).

    Added is what the new triples entail and neither side asserts or has inferred; removed is what was inferred and is
    now asserted. ``inferred_triples`` of everything equals ``inferred`` less the removed and with the added. Only the new
    triples are entailed. Of the stored graph only triples that an inference could repeat are read: those of the
    predicates that stand above others, and types by a class above others; a graph partitioned by predicate reads no
    other folder.
    """
    derived = inferred_triples(new, schema, skip_subclass)
    heads = [r.parent for r in closure(schema_edges(schema, V.RDFS_SUBPROPERTY)).select("parent").distinct().collect()]  # of the schema
    repeatable = F.col("p").isin(*heads)
    if not skip_subclass:
        tops = cut(closure(schema_edges(schema, V.RDFS_SUBCLASS))).select(F.col("parent").alias("o")).distinct()
        typed = lookup_join(stored.where(F.col("p") == V.RDF_TYPE), tops, "o", "left_semi").select(*TRIPLE_COLUMNS)
        known = stored.where(repeatable & (F.col("p") != V.RDF_TYPE)).select(*TRIPLE_COLUMNS).unionByName(typed)
    else:
        known = stored.where(repeatable).select(*TRIPLE_COLUMNS)
    marked = derived.withColumn("_new", F.lit(True)).unionByName(known.unionByName(inferred.select(*TRIPLE_COLUMNS)).withColumn("_new", F.lit(False)))
    added = _fresh(marked)
    # Only triples that an inference could repeat can have been inferred; the planner knows the bytes of these few.
    if not skip_subclass:
        typed = lookup_join(new.where(F.col("p") == V.RDF_TYPE), tops, "o", "left_semi").select(*TRIPLE_COLUMNS)
        asserted = new.where(repeatable & (F.col("p") != V.RDF_TYPE)).select(*TRIPLE_COLUMNS).unionByName(typed)
    else:
        asserted = new.where(repeatable).select(*TRIPLE_COLUMNS)
    return added, _matched(inferred, cut(asserted), "left_semi")


def _matched(triples: DataFrame, few: DataFrame, how: str) -> DataFrame:
    """Triples that are (``left_semi``) or are not (``left_anti``) among a few others."""
    other = few.toDF(*[f"_{c}" for c in TRIPLE_COLUMNS])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TRIPLE_COLUMNS])
    return triples.join(other, same, how).select(*TRIPLE_COLUMNS)


def with_delta(inferred: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The inferred triples after a run; those that stay are not moved."""
    return _matched(inferred, cut(removed), "left_anti").unionByName(added.select(*TRIPLE_COLUMNS))


def _parents(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("child").agg(F.collect_set("parent").alias("parents"))


def materialise(graph: DataFrame, schema: DataFrame | None = None, skip_subclass: bool = False) -> DataFrame:
    """The graph with its entailed triples; still a set."""
    return graph.unionByName(inferred_triples(graph, schema, skip_subclass))
