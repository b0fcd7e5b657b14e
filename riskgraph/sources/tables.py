"""Managed zone tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.sources.snapshots import read_run


def replace_table(df: DataFrame, database: str, table: str) -> None:
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    df.write.mode("overwrite").saveAsTable(f"`{database}`.`{table}`")


def drop_obsolete(spark: SparkSession, database: str, allowed: Iterable[str]) -> list[str]:
    """Drop the tables and pointers of a database that are not in the allow-list."""
    keep = set(allowed)
    obsolete = [t for t in spark.catalog.listTables(database) if not t.isTemporary and t.name not in keep]
    for t in obsolete:
        spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS `{database}`.`{t.name}`")
    return sorted(t.name for t in obsolete)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    shown = spark.sql(f"SHOW TABLES IN `{database}`").where(~F.col("isTemporary"))
    return shown.select(F.col("namespace").alias("schema_name"), F.col("tableName").alias("table_name")).orderBy("table_name")


def read_tables(spark: SparkSession, database: str, tables: Iterable[str]) -> dict[str, DataFrame]:
    return {t: spark.table(f"`{database}`.`{t}`") for t in tables}


def publish_run(spark: SparkSession, root: str, database: str, tables: Mapping[str, str], run_id: str) -> None:
    """Point published tables (name -> snapshot table) at the snapshots of one run: all of them or none.

    A published table is a view on the run's files, so no row is copied. All runs are resolved before the first
    pointer moves, so one that is missing or has no files leaves everything as it was; a pointer that cannot move
    takes back those that have.
    """
    queries = {}
    for table, snapshot in tables.items():
        run = read_run(spark, root, snapshot, run_id)
        if not run.columns or run.isEmpty() and not _has_run(spark, root, snapshot, run_id):
            raise FileNotFoundError(f"no run {run_id} of {snapshot} under {root}")
        columns = ", ".join(f"`{c}`" for c in run.columns)
        queries[table] = f"SELECT {columns} FROM parquet.`{root}/{snapshot}` WHERE run_partition = '{run_id}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    moved: list[tuple[str, str | None]] = []
    try:
        for table, query in queries.items():
            before = _pointer(spark, database, table)
            moved.append((table, before))
            _point(spark, database, table, query)
    except Exception:
        for table, before in reversed(moved):
            if before is None:
                spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{table}`")
            else:
                _point(spark, database, table, before)
        raise


def _point(spark: SparkSession, database: str, table: str, query: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS {query}")


def _has_run(spark: SparkSession, root: str, snapshot: str, run_id: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{snapshot}/run_partition={run_id}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _pointer(spark: SparkSession, database: str, table: str) -> str | None:
    """The query behind a published table, if there is one."""
    if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
        return None
    text = [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED `{database}`.`{table}`").collect() if r.col_name == "View Text"]
    if not text:
        raise ValueError(f"{database}.{table} is a table, not a published pointer")
    return text[0]


def write_by_subject(graph: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """A triple table bucketed and sorted by subject: stars and joins on a subject read it without a shuffle."""
    writer = graph.repartition(buckets, "s").write.mode("overwrite").bucketBy(buckets, "s").sortBy("s")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return graph.sparkSession.table(name)


MANIFEST_SCHEMA = (
    "run_id string, created_at_utc string, language string, generator string, graph_file string, "
    "analytics_graph_file string, schema_file string, sparql_query_dir string, trusted_rows_processed long, "
    "health_record_resources long, aggregate_measurements long, triples long, datasets long"
)


def manifest_table(spark: SparkSession, manifest: DataFrame | None) -> DataFrame:
    """One manifest row in table form, or the empty typed table when there is no manifest."""
    if manifest is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return manifest.select(
        "run_id", "created_at_utc", "language", "generator", "storage.graph_file", "storage.analytics_graph_file",
        "storage.schema_file", "storage.sparql_query_dir", "counts.trusted_rows_processed",
        "counts.health_record_resources", "counts.aggregate_measurements", "counts.triples", "counts.datasets",
    )
