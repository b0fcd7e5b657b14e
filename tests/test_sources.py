import json
import os

import pytest
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators import catalogue as cat, triples
from riskgraph.plans import zones
from riskgraph.sources import ntriples, reports, snapshots, tables
from riskgraph.streaming.ingest import ingest_new_files, read_ingested
from tests import fixtures


def test_csv_scan_and_snapshots(spark, tmp_path):
    os.makedirs(tmp_path / "in" / "deep")
    (tmp_path / "in" / "a.csv").write_text("x,y\n1,\n2,b\n")
    (tmp_path / "in" / "deep" / "b.csv").write_text("x,y\n3,c\n")
    df = snapshots.read_raw_csv(spark, str(tmp_path / "in"))
    assert sorted(map(tuple, df.collect())) == [(1, None), (2, "b"), (3, "c")]
    typed = snapshots.read_raw_csv(spark, str(tmp_path / "in"), "x int, y string")
    assert "_corrupt_record" in typed.columns and typed.count() == 3
    os.makedirs(tmp_path / "empty")
    with pytest.raises(FileNotFoundError):
        snapshots.read_raw_csv(spark, str(tmp_path / "empty"))
    root = str(tmp_path / "landing")
    snapshots.write_snapshot(df.where("x = 1"), root, "d", "20260101_000000")
    snapshots.write_snapshot(df, root, "d", "20260102_000000")
    assert "20260102" in snapshots.latest_snapshot(spark, root, "d")
    assert snapshots.read_latest(spark, root, "d").count() == 3
    with pytest.raises(FileNotFoundError):
        snapshots.latest_snapshot(spark, root, "other")


def test_ingest_reports_failures(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.csv").write_text("x\n1\n")
    status = snapshots.ingest_all(spark, {"good": str(tmp_path / "in"), "bad": str(tmp_path / "no")}, str(tmp_path / "l"), "s")
    assert {r.dataset: r.status for r in status.collect()} == {"good": "ok", "bad": "failed"}
    with pytest.raises(RuntimeError):
        snapshots.require_all_ok(status)


def test_runs_and_tables(spark, tmp_path):
    root = str(tmp_path / "trusted")
    snapshots.write_run(spark.range(3), root, "t", "r1")
    snapshots.write_run(spark.range(5), root, "t", "r2")
    snapshots.write_run(spark.range(4), root, "t", "r2")
    assert snapshots.read_run(spark, root, "t", "r1").count() == 3 and snapshots.read_run(spark, root, "t", "r2").count() == 4
    tables.publish_run(spark, root, "zone_a", {"kept": "t", "old": "t"}, "r2")
    assert [r.table_name for r in tables.list_tables(spark, "zone_a").collect()] == ["kept", "old"]
    assert tables.drop_obsolete(spark, "zone_a", ["kept"]) == ["old"]
    assert tables.read_tables(spark, "zone_a", ["kept"])["kept"].count() == 4
    assert tables.manifest_table(spark, None).count() == 0


def test_manifest(spark, tmp_path):
    safe, zone, g = zones.run(fixtures.raw(spark), "run", "ts")
    counts = triples.manifest_counts(zone.records, zone.measurements, g.full_entailed)
    manifest = reports.graph_manifest(
        counts, triples.validation_counts(g.full), g.full_inferred, g.analytics_inferred, "run", "ts", "full", "small", "schema", ["01"])
    row = manifest.first()
    assert row.counts.trusted_rows_processed == 14 and row.counts.health_record_resources == 14 and row.counts.datasets == 3
    assert row.counts.triples == g.full.count() + row.rdfs_reasoning.full_graph_inferred_triples
    reports.write_json(manifest, str(tmp_path / "m"))
    back = reports.read_json(spark, str(tmp_path / "m"))
    assert tables.manifest_table(spark, back).first().triples == row.counts.triples
    assert safe.quarantine.count() == 8 + 3 + 2


def test_embedding_tables(spark, tmp_path):
    vectors = spark.createDataFrame([("b", [1.0, 2.0]), ("a", [0.5, -1.0])], "node string, vec array<double>")
    for as_csv in (True, False):
        path = str(tmp_path / str(as_csv))
        reports.write_embeddings(vectors, path, 2, as_csv)
        assert {r.node: r.vec for r in reports.read_embeddings(spark, path, as_csv).collect()} == {"b": [1.0, 2.0], "a": [0.5, -1.0]}


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(fixtures.CARDIO_ROWS, fixtures.CARDIO_COLUMNS)
    source = str(tmp_path / "in")
    df.where("id = 1").coalesce(1).write.parquet(source)
    def run():
        ingest_new_files(spark, source, "parquet", df.schema, cat.standardise_cardio, cat.CARDIO_CONTRACT, str(tmp_path / "out"),
                         str(tmp_path / "state"), "run", "ts").awaitTermination()
    run()
    df.where("id IS NULL OR id <> 1").coalesce(1).write.mode("append").parquet(source)
    run()
    run()  # nothing new: nothing happens
    clean = read_ingested(spark, str(tmp_path / "out"), cat.CARDIO_CONTRACT).clean()
    assert sorted(r.patient_id for r in clean.collect()) == ["1", "2", "3", "7"]
    bad = read_ingested(spark, str(tmp_path / "out"), cat.CARDIO_CONTRACT).quarantine()
    assert bad.count() == 8 and bad.select("batch_id").distinct().count() == 1
    totals = spark.read.parquet(str(tmp_path / "out" / "metrics")).where(F.col("rule_name") == "patient_id_present").agg(F.sum("total_rows")).first()[0]
    assert totals == 12


def test_registry_is_consistent():
    import __spark_entry__ as entry

    from riskgraph.plans.oracles import SQL
    from riskgraph.plans.queries import QUERIES

    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
    without = set(QUERIES) - set(SQL)
    assert without == {"emb_svd", "emb_train", "ml_candidates", "ml_graph_model", "ml_hybrid_model", "ml_importance"}
    assert json.dumps(sorted(entry.queries())) and V.INDICATORS


def test_ntriples_of_other_writers(spark):
    lines = ["_:a1 <p> _:b.2 .", "<s><p><o>.", '<s>\t<p> "caf\\u00e9 \\U0001F600 \\\\u0041"@en-GB . # said', '<s> <p> "x . # y"^^<t>.', "# comment", "  ", "<s> <p> .", "<s> <p> <o>", "junk"]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [tuple(r) for r in ntriples.from_lines(frame).collect()]
    assert got == [("_:a1", "p", "_:b.2", "iri", None), ("s", "p", "o", "iri", None), ("s", "p", "café 😀 \\u0041", "literal", "@en-GB"), ("s", "p", "x . # y", "literal", "t")]
    assert [r.value for r in ntriples.malformed(frame).collect()] == lines[6:]
    again = ntriples.from_lines(ntriples.to_lines(spark.createDataFrame(got, ntriples.TRIPLE_SCHEMA)))
    assert [tuple(r) for r in again.collect()] == got


def test_ingest_uniqueness_over_batches(spark, tmp_path):
    df = spark.createDataFrame(fixtures.CARDIO_ROWS, fixtures.CARDIO_COLUMNS)
    for i in range(3):  # three files with the same rows
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []
    for n in (1, None):
        out = tmp_path / f"out{n}"
        ingest_new_files(spark, str(tmp_path / "in"), "parquet", df.schema, cat.standardise_cardio, cat.CARDIO_CONTRACT, str(out),
                         str(tmp_path / f"state{n}"), "run", "ts", max_files=n).awaitTermination()
        rule = cat.CARDIO_CONTRACT.unique[0]
        bad = spark.read.parquet(f"{out}/metrics").where(F.col("rule_name") == rule).agg(F.sum("violations")).first()[0]
        seen.append((bad, sorted(r.patient_id for r in read_ingested(spark, str(out), cat.CARDIO_CONTRACT).clean().collect())))
    assert seen[0] == seen[1]


def test_ingest_reads_no_earlier_batch(spark, tmp_path):
    """The rows of earlier batches may be gone: which keys have been seen is the state of the stream, also after a restart."""
    df = spark.createDataFrame(fixtures.CARDIO_ROWS, fixtures.CARDIO_COLUMNS)
    rule = cat.CARDIO_CONTRACT.unique[0]

    def run(out):
        ingest_new_files(spark, str(tmp_path / "in"), "parquet", df.schema, cat.standardise_cardio, cat.CARDIO_CONTRACT, str(tmp_path / out),
                         str(tmp_path / "state"), "run", "ts").awaitTermination()
        return spark.read.parquet(str(tmp_path / out / "metrics")).where(F.col("rule_name") == rule).agg(F.sum("total_rows"), F.sum("violations")).first()

    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    first = run("a")
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    second = run("b")  # nothing of the first batch is here
    assert tuple(second) == (first[0], first[0]) and first[1] < first[0]
