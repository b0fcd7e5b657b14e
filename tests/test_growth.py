"""Plans whose work must grow no faster than the input: how often rows are moved, and what is written."""

from pyspark.sql import functions as F

from riskgraph.operators.embedding import target_ranks
from riskgraph.operators.entailment import entailed_delta, inferred_triples, with_delta
from riskgraph.operators.harmonise import with_record_ordinal
from riskgraph.operators.lineage import cut
from riskgraph.operators.ranking import first_of_key, ordinal_in_key
from riskgraph.operators.triples import TRIPLE_SCHEMA, hr, schema_triples


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moves(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_rows_of_repeated_keys_move_once(spark):
    df = spark.range(0, 4000).select((F.col("id") % 1500).cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    flagged = first_of_key(df, ["k"], ["v"], "first")
    assert moves(flagged) == 1 and "Join" not in plan_of(flagged)
    assert flagged.where("first").count() == 1500
    assert moves(ordinal_in_key(df, ["k"], ["v"], "n")) == 1


def test_unique_ids_are_numbered_where_they_are(spark):
    df = spark.range(0, 50).select(F.lit("events").alias("source_dataset"), F.col("id").cast("string").alias("source_record_id"))
    out = with_record_ordinal(df, ())
    assert moves(out) == 0 and {r.record_ordinal for r in out.collect()} == {1}
    twice = with_record_ordinal(df.unionByName(df), ())
    assert sorted(r.record_ordinal for r in twice.collect()) == [1] * 50 + [2] * 50


def test_entailment_moves_no_asserted_triple(spark):
    """The hierarchies are sent along; only what is derived is shuffled."""
    n = F.col("id").cast("string")
    graph = spark.range(0, 2000).select(
        F.concat(F.lit("urn:"), n).alias("s"), F.when(F.col("id") % 2 == 0, hr("hasGender")).otherwise(hr("belongsToAgeGroup")).alias("p"), F.lit("urn:g").alias("o"), F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("o_type"))
    inferred = inferred_triples(graph, schema_triples(spark), skip_subclass=True)
    plan = plan_of(inferred)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert inferred.count() == 2000


def test_filtered_ranks_write_no_row_for_what_is_left_out(spark):
    """Entities of the target's label are left out by a mask: ranks equal those by (query, node) rows; NULL is like NULL."""
    labelled = [(str(i), [float(i % 7), float(i % 5)], None if i % 11 == 0 else i % 3) for i in range(60)]
    entities = spark.createDataFrame(labelled, "node string, vec array<double>, label int")
    asked = [(f"q{i}", str((i + 1) % 60), labelled[i][1], labelled[(i + 1) % 60][1], labelled[(i + 1) % 60][2]) for i in range(0, 60, 4)]
    queries = spark.createDataFrame(asked, "query_id string, target string, q array<double>, t array<double>, wanted int")
    known = spark.createDataFrame([(a[0], n) for a in asked for n, _, label in labelled if label == a[4]], "query_id string, node string")
    ranks = target_ranks(queries, entities, average_ties=True, block_rows=17, apart=("wanted", "label"))
    assert "Join" not in plan_of(ranks)
    by_rows = target_ranks(queries, entities, average_ties=True, known=known)
    assert {tuple(r) for r in ranks.collect()} == {tuple(r) for r in by_rows.collect()}


def test_a_run_moves_its_own_triples(spark):
    """What was inferred and stays is neither shuffled nor sorted to take the few asserted ones out."""
    row = lambda s, p: (s, hr(p), "urn:g", "iri", None)
    frame = lambda rows: spark.createDataFrame(rows, TRIPLE_SCHEMA)
    stored, new = frame([row("urn:a", "hasGender"), row("urn:b", "hasGender")]), frame([row("urn:b", "belongsToDemographicConcept"), row("urn:c", "hasGender")])
    schema = schema_triples(spark)
    inferred = cut(inferred_triples(stored, schema, skip_subclass=True))
    added, removed = entailed_delta(new, stored, inferred, schema, skip_subclass=True)
    assert moves(removed) == 0
    after = with_delta(inferred, cut(added), removed)
    assert moves(after) == 0
    assert {r.s for r in removed.collect()} == {"urn:b"} and {r.s for r in after.collect()} == {"urn:a", "urn:c"}


def moved_terms(df):
    return [line for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line and "o_kind" in line]


def test_inferred_triples_are_not_shuffled_by_their_terms(spark):
    """Only hashes tell whether a triple is new; the few that share one are compared by their terms."""
    row = lambda s, p, o="urn:g": (s, hr(p), o, "iri", None)
    rows = [row(f"urn:{i}", "hasGender") for i in range(50)]
    schema = schema_triples(spark)
    frame = lambda x: spark.createDataFrame(x, TRIPLE_SCHEMA)
    inferred = inferred_triples(frame(rows), schema, skip_subclass=True)
    assert not moved_terms(inferred) and inferred.count() == 50
    odd = [row("urn:1", "belongsToAgeGroup"), row("urn:2", "belongsToDemographicConcept"), row("urn:3", "hasGender"), row("urn:4", "hasGender", None), row("urn:4", "hasGender", None)]
    want = sorted(f"urn:{i}" for i in range(50) if i != 2) + ["urn:4"]
    got = inferred_triples(frame(rows + odd), schema, skip_subclass=True).collect()
    assert sorted(r.s for r in got) == sorted(want) and {r.p for r in got} == {hr("belongsToDemographicConcept")}
    added, _ = entailed_delta(frame([row("urn:new", "hasGender")]), frame(rows), cut(inferred), schema, skip_subclass=True)
    assert not moved_terms(added) and [r.s for r in added.collect()] == ["urn:new"]


def test_triples_that_collide_are_told_apart(spark, monkeypatch):
    from riskgraph.operators import entailment

    monkeypatch.setattr(entailment.F, "xxhash64", lambda *columns: F.length("s") % 2)
    rows = [(s, hr("hasGender"), "urn:g", "iri", None) for s in ("a", "bb", "ccc")] + [("a", hr("belongsToDemographicConcept"), "urn:g", "iri", None)]
    got = inferred_triples(spark.createDataFrame(rows, TRIPLE_SCHEMA), schema_triples(spark), skip_subclass=True)
    assert sorted(r.s for r in got.collect()) == ["bb", "ccc"]


def test_a_stored_graph_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Rows go to the file of their predicate as they come; the session's setting is as before."""
    from pyspark.sql import DataFrameWriter

    from riskgraph.sources import ntriples

    rows = [(f"urn:{i}", f"p{i % 9}", "o", "iri", None) for i in range(90)]
    before, seen, parquet = spark.conf.get(ntriples.WRITERS), [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **b: (seen.append(spark.conf.get(ntriples.WRITERS)), parquet(*a, **b)))
    ntriples.write_partitioned(spark.createDataFrame(rows, TRIPLE_SCHEMA), str(tmp_path / "g"), "p")
    assert seen == [str(ntriples.OPEN_FILES)] and spark.conf.get(ntriples.WRITERS) == before
    assert {r.s for r in spark.read.parquet(str(tmp_path / "g")).where("p = 'p3'").collect()} == {f"urn:{i}" for i in range(3, 90, 9)}


def test_only_the_subjects_join_moves_decoded_triples(spark):
    """Predicates and objects in use are few: their terms are sent to the rows; a schema's terms do not move the dictionary."""
    from riskgraph.operators import dictionary

    n = F.col("id").cast("string")
    graph = spark.range(0, 3000).select(
        F.concat(F.lit("urn:"), F.sha1(n)).alias("s"), F.lit(hr("hasGender")).alias("p"), F.concat(F.lit("urn:g"), F.col("id") % 3).alias("o"), F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("o_type"))
    schema = schema_triples(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        encoded = dictionary.encode(graph)
        terms = encoded.terms_with(schema)
        assert terms.count() == terms.distinct().count() == graph.unionByName(schema).selectExpr("explode(array(s || ' iri', p || ' iri', o || ' ' || o_kind))").distinct().count()
        found = dictionary.decode(cut(dictionary.inferred_ids(encoded, schema)), terms)
        assert plan_of(found).count("SortMergeJoin") == 1 and plan_of(found).count("BroadcastHashJoin") == 2
        assert found.count() == 3000 and {tuple(r) for r in found.collect()} == {tuple(r) for r in inferred_triples(graph, schema, skip_subclass=True).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
