"""Contiguous shards of nearly equal bytes, from global prefix sums.

Rows are range-partitioned by (id, checksum, size, row number), each partition is summed, and the running sum of the
partition totals (one row per partition) gives every partition its offset. A row's shard follows from the middle of
its byte range: ``floor((2 * before + size) * shards / (2 * total))``, so shards are contiguous in the order and each
cut is at most half a row off its target. Law: ``bytes``.

NULL texts count one byte; NULL ids come first; rows alike in id, checksum and size take neighbouring slots in any
order. The row number keeps even a repeated id from filling one partition. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgraph.llm.common import text_of
from riskgraph.operators.lineage import cut

ORDER = ["doc_id", "text_crc32", "size", "rid"]


def byte_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (NULL under this law), first_byte."""
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("rid"))
    placed = cut(rows.repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()))

    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")],
                            F.sum("bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy(*ORDER)
    local = placed.select("*", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias("local"),
                          F.row_number().over(inside).alias("number"))
    ranked = local.join(F.broadcast(offsets), "part").select(  # one row for each range partition
        "doc_id", "size", "text_crc32", "total", (F.coalesce("local", F.lit(0)) + F.col("bytes_before")).alias("first_byte"),
        (F.col("number") - 1 + F.col("rows_before")).alias("rank"))
    sharded = cut(ranked.withColumn("shard", F.expr(f"least((2 * first_byte + size) * {shards} div (2 * total), {shards - 1})").cast("int")).drop("total"))
    starts = sharded.groupBy("shard").agg(F.min("rank").alias("start"))
    return sharded.join(F.broadcast(starts), "shard").select(  # one row for each shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "first_byte")
