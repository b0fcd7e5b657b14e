"""Raw snapshots and run-versioned Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT_PREFIX = "ingested_"
MAX_FILE_ROWS = 20_000_000


def read_raw_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Many CSV files as one frame: header, empty text as NULL, permissive. Folders are searched recursively.

    A schema avoids the extra pass of inference and keeps broken lines in ``_corrupt_record``.
    """
    reader = spark.read.options(
        header=True, nullValue="", mode="PERMISSIVE", recursiveFileLookup=True, pathGlobFilter="*.csv")
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        if "_corrupt_record" not in fields.names:
            fields = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
        reader = reader.schema(fields)
    try:
        df = reader.csv([paths] if isinstance(paths, str) else list(paths))
    except AnalysisException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no CSV files under {paths}") from failure
    if not _has_files(spark, df, paths):
        raise FileNotFoundError(f"no CSV files under {paths}")
    return df


def _has_files(spark: SparkSession, df: DataFrame, paths: str | Sequence[str]) -> bool:
    """Whether the scan found a file: the first file answers, the rest of the listing is not read."""
    names = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.csv").load(
        [paths] if isinstance(paths, str) else list(paths)).select("path").limit(1)
    return bool(df.columns) and not names.isEmpty()


def write_snapshot(df: DataFrame, root: str, dataset: str, run_stamp: str) -> str:
    """Write one raw snapshot under its UTC stamp; file sizes are bounded, the writer count is not reduced to one."""
    path = f"{root}/{dataset}/{SNAPSHOT_PREFIX}{run_stamp}/{dataset}.parquet"
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)
    return path


def latest_snapshot(spark: SparkSession, root: str, dataset: str) -> str:
    """Path of the lexically greatest snapshot: a listing on the file system, no scan."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{dataset}/{SNAPSHOT_PREFIX}*")
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    names = sorted(status.getPath().getName() for status in (found or []))
    if not names:
        raise FileNotFoundError(f"no snapshot of {dataset} under {root}")
    return f"{root}/{dataset}/{names[-1]}/{dataset}.parquet"


def read_latest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(latest_snapshot(spark, root, dataset))


def ingest_all(
    spark: SparkSession, sources: Mapping[str, str], root: str, run_stamp: str,
    read: Callable[[SparkSession, str], DataFrame] = read_raw_csv,
) -> DataFrame:
    """Ingest every dataset; a failing one is reported and the others go on. Returns the status per dataset."""
    rows = []
    for dataset, path in sources.items():
        try:
            target = write_snapshot(read(spark, path), root, dataset, run_stamp)
            rows.append((dataset, "ok", spark.read.parquet(target).count(), None))
        except Exception as failure:  # noqa: BLE001 - the status row carries the error
            rows.append((dataset, "failed", None, str(failure)))
    return spark.createDataFrame(rows, "dataset string, status string, rows long, error string")


def require_all_ok(status: DataFrame) -> None:
    failed = [r.dataset for r in status.where(F.col("status") != "ok").select("dataset").collect()]
    if failed:
        raise RuntimeError(f"ingest failed for {failed}")


def write_run(df: DataFrame, root: str, table: str, run_id: str) -> str:
    """Overwrite one run of a versioned table; other runs stay as they are."""
    path = f"{root}/{table}"
    df.withColumn("run_partition", F.lit(run_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_FILE_ROWS).partitionBy(
        "run_partition").parquet(path)
    return path


def read_run(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """One run of a versioned table; partition pruning leaves only its files."""
    df = spark.read.parquet(f"{root}/{table}")
    return df.where(F.col("run_partition") == run_id).drop("run_partition")
