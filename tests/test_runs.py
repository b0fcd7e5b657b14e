"""Runs that add to what earlier ones have left: states, entailment, pointers, stored graphs."""

import pytest
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators import dictionary, entailment, harmonise, partials, triples
from riskgraph.plans import zones
from riskgraph.sources import snapshots, tables
from tests import fixtures


@pytest.fixture(scope="module")
def canonical(spark):
    safe = zones.trusted(zones.formatted(fixtures.raw(spark), "ts"), "run", "ts")
    return zones.exploitation(safe.clean, "run", "ts").canonical


def rows(df):
    return sorted(str(r.asDict()) for r in df.collect())


def test_states_of_runs_add_up(spark, canonical, tmp_path):
    part = F.pmod(F.xxhash64("source_record_id"), F.lit(2))
    for run in (0, 1, 1):  # the second run is repeated
        own = canonical.where(part == run)
        snapshots.write_run(partials.measurement_states(own), str(tmp_path), "cells", f"r{run}")
        snapshots.write_run(partials.profile_states(own), str(tmp_path), "profile", f"r{run}")
    cells, profile = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("cells", "profile"))
    whole = harmonise.aggregate_measurements(canonical)
    assert rows(partials.merged_measurements(cells).select(*whole.columns)) == rows(whole) and whole.count() > 20
    assert rows(partials.merged_profile(profile, "ts")) == rows(harmonise.dataset_profile(canonical, "ts"))
    assert partials.merged_measurements(cells.where("false")).count() == partials.merged_profile(profile.where("false"), "ts").count() == 0


@pytest.mark.parametrize("skip", [True, False])
def test_a_delta_is_the_difference_of_two_results(spark, skip):
    schema = spark.createDataFrame([(c, r, p, "iri", None) for r, pairs in (
        (V.RDFS_SUBPROPERTY, [("a", "b"), ("b", "c"), ("x", "c")]), (V.RDFS_SUBCLASS, [("K", "L"), ("L", "M")])) for c, p in pairs], triples.TRIPLE_SCHEMA)
    make = lambda found: spark.createDataFrame([(s, p, o, "iri", None) for s, p, o in found], triples.TRIPLE_SCHEMA)
    stored = make([("1", "a", "2"), ("1", "c", "9"), ("3", "x", "4"), ("5", V.RDF_TYPE, "K"), ("6", V.RDF_TYPE, "M"), ("7", "z", "8")])
    new = make([("1", "b", "2"), ("9", "a", "9"), ("1", "x", "9"), ("5", V.RDF_TYPE, "L"), ("6", V.RDF_TYPE, "L"), ("3", "x", "5")])
    before = entailment.inferred_triples(stored, schema, skip)
    after = entailment.inferred_triples(stored.unionByName(new), schema, skip)
    added, removed = entailment.entailed_delta(new, stored, before, schema, skip)
    assert rows(added) == rows(after.exceptAll(before)) and rows(removed) == rows(before.exceptAll(after))
    assert rows(entailment.with_delta(before, added, removed)) == rows(after) and removed.count() and added.count()


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "runs")
    snapshots.write_run(spark.range(3), root, "a", "r1")
    snapshots.write_run(spark.range(4).withColumn("x", F.lit("y")), root, "b", "r1")
    tables.publish_run(spark, root, "zone_p", {"one": "a", "two": "b"}, "r1")
    snapshots.write_run(spark.range(5), root, "a", "r2")
    sizes = lambda: [spark.table(f"zone_p.{n}").count() for n in ("one", "two")]
    with pytest.raises(FileNotFoundError):
        tables.publish_run(spark, root, "zone_p", {"one": "a", "two": "b"}, "r2")  # there is no such run of b
    assert sizes() == [3, 4]
    spark.sql("CREATE TABLE zone_p.solid (id long) USING parquet")
    with pytest.raises(ValueError):
        tables.publish_run(spark, root, "zone_p", {"one": "a", "fresh": "a", "solid": "a"}, "r2")  # fails after two have moved
    assert sizes() == [3, 4] and not spark.catalog.tableExists("zone_p.fresh")
    snapshots.write_run(spark.range(6).withColumn("x", F.lit("y")), root, "b", "r2")
    tables.publish_run(spark, root, "zone_p", {"one": "a", "two": "b"}, "r2")
    assert sizes() == [5, 6] and spark.table("zone_p.two").columns == ["id", "x"]
    assert tables.drop_obsolete(spark, "zone_p", ["one"]) == ["solid", "two"]


def test_stars_on_a_bucketed_graph_do_not_shuffle(spark, tmp_path):
    graph = spark.range(400).select(F.explode(F.array(*[
        F.struct(F.concat(F.lit("s"), F.col("id") % 100).alias("s"), F.concat(F.lit("p"), F.lit(k)).alias("p"), F.col("id").cast("string").alias("o"),
                 F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_type")) for k in range(3)])).alias("t")).select("t.*")
    stored = tables.write_by_subject(graph, "graph_by_subject", 4, str(tmp_path / "g"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = stored.groupBy("s").agg(F.collect_set("p").alias("ps"))
        joined = stored.where("p = 'p0'").select("s", F.col("o").alias("a")).join(stored.where("p = 'p1'").select("s", F.col("o").alias("b")), "s")
        for df in (star, joined):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert star.count() == 100 and joined.count() == 1600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE graph_by_subject")


def test_graphs_by_numbers(spark, monkeypatch):
    schema = spark.createDataFrame([(c, V.RDFS_SUBPROPERTY, p, "iri", None) for c, p in [("a", "b"), ("b", "c"), ("x", "c")]], triples.TRIPLE_SCHEMA)
    rows_ = [("1", "a", "2", "iri", None), ("1", "c", "2", "iri", None), ("3", "x", "2", "literal", None), ("3", "c", "2", "literal", "t"), ("3", "x", "", "literal", "t"), ("4", "z", "a", "iri", None)]
    graph = spark.createDataFrame(rows_, triples.TRIPLE_SCHEMA)
    encoded = dictionary.encode(graph)
    assert rows(dictionary.decode(encoded.ids, encoded.terms)) == rows(graph)
    found = dictionary.decode(dictionary.inferred_ids(encoded, schema), encoded.terms_with(schema))
    assert rows(found) == rows(entailment.inferred_triples(graph, schema, skip_subclass=True)) and found.count() == 3
    part = encoded.numbered(graph.where("p = 'x'"))
    assert rows(dictionary.decode(dictionary.missing_ids(encoded.ids, part), encoded.terms)) == rows(graph.where("p <> 'x'"))
    number = dictionary._number
    monkeypatch.setattr(dictionary, "_number", lambda text, kind, type_, seed: F.length(text).cast("long") if seed == 1 else number(text, kind, type_, seed))
    assert dictionary.encode(graph, 1).seed == 2  # terms that share a number are encoded anew
