"""Incremental ingest: new files since the last run, through the same contracts as the batch job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from riskgraph.operators.contracts import Contract, Split, evaluate
from riskgraph.operators.lineage import cut, scope

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # fixed value
PROVIDER = "spark.sql.streaming.stateStore.providerClass"  # fixed value


def _first_seen(rows: DataFrame, key: str) -> DataFrame:
    """Keys that come for the first time. The stream's state holds every key once; a batch looks up its own ones.

    A block of rows gives each key once, so a key with many rows is no hot task of the state.
    """
    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).unique()], [key])

    keys = rows.select(key)
    return keys.mapInArrow(once, keys.schema).dropDuplicates([key])


def _write_batch(batch: DataFrame, batch_id: int, contract: Contract, columns: list[str], out: str, run_id: str, run_ts: str) -> None:
    """Rows and metrics of one micro-batch, by one write keyed by batch id, so that a replay overwrites itself.

    With a uniqueness rule the batch also holds the keys that its rows bring for the first time. It is written
    once, in folders of rows and keys, because a stateful batch is read by several steps.
    """
    spark = batch.sparkSession
    with scope(spark):
        rows, fresh = batch, None
        if contract.unique:
            staged = cut(batch, partition_by="_is_key")
            rows = staged.where("not _is_key").select("_row.*").select(*columns)
            fresh = staged.where("_is_key").select(F.col("_key").alias(contract.key))
        split = evaluate(rows, contract, run_id, run_ts, fresh).split(f"{out}/rows", batch_id)
        split.metrics().withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/metrics")


def read_ingested(spark: SparkSession, out: str, contract: Contract) -> Split:
    """All batches of an ``out``: clean rows, quarantine and metrics."""
    found = spark.read.parquet(f"{out}/rows").schema
    schema = T.StructType([T.StructField("_is_clean", T.BooleanType()) if f.name == "_is_clean" else f for f in found.fields])
    return Split(spark.read.schema(schema).parquet(f"{out}/rows"), contract, spark.read.parquet(f"{out}/metrics"))


def ingest_new_files(
    spark: SparkSession, source: str, file_format: str, schema: T.StructType, standardise: Callable[[DataFrame], DataFrame],
    contract: Contract, out: str, checkpoint: str, run_id: str, run_ts: str, max_files: int | None = None,
) -> StreamingQuery:
    """Process every file that arrived since the last run and stop (``availableNow``).

    The checkpoint remembers the files, so a scheduled call never reads one twice. ``max_files`` only sizes the
    micro-batches; without it one batch takes all that is new.

    A uniqueness rule holds over all batches and runs of one checkpoint: the first row of the batch in which a key first
    came is unique, every later row repeats it, however the files fall into batches. The keys seen are the state of
    the stream, in RocksDB on the executors and in the checkpoint; a batch reads no earlier one.
    """
    stream = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        stream = stream.option("maxFilesPerTrigger", max_files)
    if file_format == "csv":
        stream = stream.options(header=True, nullValue="", mode="PERMISSIVE")
    rows = standardise(stream.load(source))
    columns = rows.columns
    if contract.unique:
        key = rows.schema[contract.key].dataType
        carried = rows.select(F.lit(False).alias("_is_key"), F.struct(*columns).alias("_row"), F.lit(None).cast(key).alias("_key"))
        seen = _first_seen(rows, contract.key)
        carried = carried.unionByName(seen.select(F.lit(True).alias("_is_key"), F.lit(None).cast(carried.schema["_row"].dataType).alias("_row"), F.col(contract.key).alias("_key")))
    else:
        carried = rows
    sink = partial(_write_batch, contract=contract, columns=columns, out=out, run_id=run_id, run_ts=run_ts)
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return carried.writeStream.foreachBatch(lambda df, n: sink(df, n)).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)
