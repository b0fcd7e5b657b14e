import pytest
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators import entailment, harmonise, patterns, triples
from riskgraph.operators.lineage import cut
from riskgraph.plans import zones
from riskgraph.sources import ntriples
from tests import fixtures


@pytest.fixture(scope="module")
def built(spark):
    safe, zone, graphs = zones.run(fixtures.raw(spark), "run", "2026-01-01T00:00:00+00:00")
    return safe, zone, graphs


def test_fixed_vocabulary_sizes(spark):
    assert triples.schema_triples(spark).distinct().count() == 185
    assert triples.vocabulary_triples(spark).distinct().count() == 136


def test_canonical(built):
    _, zone, _ = built
    assert zone.canonical.columns == [c for c, _ in V.CANONICAL_COLUMNS]
    assert {r.source_dataset: r.rows_total for r in zone.profile.collect()} == {V.CARDIO: 4, V.CDC: 6, V.CLEVELAND: 4}
    copies = zone.records.groupBy("source_dataset", "source_record_id").agg(F.max("record_ordinal").alias("n"), F.count("*").alias("c"))
    assert all(r.n == r.c for r in copies.collect())


def test_three_valued_flags(spark):
    rows = [(None, 90.0), (120.0, 70.0), (None, 70.0), (130.0, None)]
    df = spark.createDataFrame(rows, "systolic_bp double, diastolic_bp double")
    flag = df.select(F.expr(harmonise.CARDIO_FIELDS["high_blood_pressure_flag"])).collect()
    assert [r[0] for r in flag] == [True, False, None, True]


def test_graph_identities(built):
    """Triple counts follow from rows, factors, measurements, groups and sources."""
    _, zone, g = built
    n, cells = zone.records.count(), zone.measurements.count()
    groups = zone.records.select("age_group_code", "gender").distinct().count()
    flags = [*V.RISK_COLUMNS, *V.PROTECTIVE_COLUMNS]
    factors = zone.records.select(sum(F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags).alias("f")).agg(F.sum("f")).first()[0]
    small = 185 + 136 + (5 + 3) + 3 * 4
    assert g.full.count() == small + 4 * groups + 8 * cells + 9 * n + factors
    assert g.full_inferred.count() == 3 * n + factors
    used = zone.measurements.select("age_group_code", "gender").distinct().count()
    assert g.analytics.count() == small + 4 * used + 8 * cells
    assert g.analytics_inferred.count() == cells + 2 * (13 + 3 + used) + 2 * (17 + 3)
    assert g.full.distinct().count() == g.full.count()


def test_entailment_is_idempotent(built):
    _, _, g = built
    closed = cut(g.analytics_entailed)
    assert entailment.inferred_triples(closed, g.schema).count() == 0


def test_closure_with_cycle(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "child string, parent string")
    got = {tuple(r) for r in entailment.closure(pairs).collect()}
    assert got == {(i, j) for i in "abc" for j in "abc"} | {("x", "y")}


def test_entailment_rules(spark):
    hr = V.hr
    rows = [
        (hr("r"), hr("p1"), "o", "iri", None), (hr("r"), hr("p2"), "o", "iri", None), (hr("r"), V.RDF_TYPE, hr("C1"), "iri", None),
        (hr("p1"), V.RDFS_SUBPROPERTY, hr("p2"), "iri", None), (hr("p2"), V.RDFS_SUBPROPERTY, hr("p3"), "iri", None),
        (hr("C1"), V.RDFS_SUBCLASS, hr("C2"), "iri", None), (hr("C2"), V.RDFS_SUBCLASS, hr("C3"), "iri", None)]
    g = spark.createDataFrame(rows, triples.TRIPLE_SCHEMA)
    got = {(r.p, r.o) for r in entailment.inferred_triples(g).collect()}
    # (r p2 o) was asserted already, so it is not new.
    assert got == {(hr("p3"), "o"), (V.RDF_TYPE, hr("C2")), (V.RDF_TYPE, hr("C3"))}
    assert {r.p for r in entailment.inferred_triples(g, skip_subclass=True).collect()} == {hr("p3")}


def test_patterns_agree_with_tables(built):
    _, zone, g = built
    full, small = cut(g.full_entailed, "p"), cut(g.analytics_entailed)
    rows = zone.records.where("target").collect()
    expected = {}
    for r in rows:
        on = sorted(i for c, i in V.RISK_COLUMNS.items() if r[c])
        for a in range(len(on)):
            for b in range(a + 1, len(on)):
                key = (V.BY_ID[on[a]].label, V.BY_ID[on[b]].label)
                expected[key] = expected.get(key, 0) + 1
    got = {(r[0], r[1]): r[2] for r in patterns.cooccurring_risk_factors(full).collect()}
    assert got == expected
    factors = {r.factorLabel: r.recordCount for r in patterns.inferred_factors(full).collect()}
    assert factors["High cholesterol flag"] == sum(bool(r.high_cholesterol_flag) for r in rows)
    assert all(r.datasetCount > 1 for r in patterns.multi_source_groups(full).collect())
    assert patterns.rank_groups(small, min_observations=1).count() == zone.measurements.where("indicator_id = 'heart-disease-outcome'").count()
    assert patterns.rank_groups(small).count() == 0
    structure = {r["class"]: r.instances for r in patterns.structure_summary(small).collect()}
    assert structure["indicators"] == 17 and structure["datasets"] == 3 and structure["genders"] == 3
    for operator, graph in patterns.CATALOGUE.values():
        assert operator(full if graph == "full" else small).columns


def test_functional_star_equals_pattern_join(built):
    _, _, g = built
    hr = V.hr
    star = patterns.star(g.analytics, "AggregateMeasurement", "m", {"i": hr("measuresIndicator"), "d": hr("fromDataset")})
    joined = patterns.join_patterns(
        patterns.match(g.analytics, V.RDF_TYPE, s="m", object_is=hr("AggregateMeasurement")),
        patterns.match(g.analytics, hr("measuresIndicator"), s="m", o="i"),
        patterns.match(g.analytics, hr("fromDataset"), s="m", o="d"))
    key = lambda df: sorted(tuple(r) for r in df.select("m", "i", "d").collect())
    assert key(star) == key(joined)


def test_report_cap(spark):
    report = patterns.report_rows(spark.range(5), row_cap=3).first()
    assert (report.rows_returned, len(report.rows), report.row_cap_applied) == (5, 3, True)


def test_ntriples_round_trip(spark, tmp_path):
    texts = ['plain', 'quote " and \\ backslash', 'tab\tnew\nline\r', 'é ü 漢字', '', 'ends with \\', '\\n is not a newline', '"^^<x>',
             'a" .', '<not> <a> <triple> .', "long " + "x\\\"\n" * 20000]
    rows = [(V.hr(f"d/{i}"), V.RDFS_COMMENT, t, "literal", None if i % 2 else V.XSD + "string") for i, t in enumerate(texts)]
    rows.append((V.hr("d/x"), V.RDF_TYPE, V.hr("Dataset"), "iri", None))
    g = spark.createDataFrame(rows, triples.TRIPLE_SCHEMA)
    ntriples.write_ntriples(g, str(tmp_path / "g"))
    back = ntriples.read_ntriples(spark, str(tmp_path / "g"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in g.collect()}
    extra = spark.createDataFrame([("# comment",), ("",), ('<a> <b> "hi"@en .',)], "value string")
    assert [tuple(r) for r in ntriples.from_lines(extra).collect()] == [("a", "b", "hi", "literal", "@en")]
    with pytest.raises(FileNotFoundError):
        ntriples.read_ntriples(spark, str(tmp_path / "none"))


def test_triple_table_prunes_predicates(built, spark, tmp_path):
    _, _, g = built
    path = str(tmp_path / "t")
    ntriples.write_triple_table(g.analytics, path)
    table = ntriples.read_triple_table(spark, path)
    assert table.count() == g.analytics.count()
    plan = table.where(F.col("p") == V.RDF_TYPE)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
