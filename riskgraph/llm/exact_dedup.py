"""Exact duplicates by a heavy-hitter split.

A Misra-Gries pass (Spark's ``freqItems``) names every digest that can hold more than ``support`` of all rows, at
most ``1 / support`` of them. Their rows are counted exactly, map side; the verified ones and their winners are few
by construction, are broadcast, and their rows never move. All other digests go through an ordinary shuffle, where
no group exceeds ``support`` of the rows; groups are pre-aggregated and joined back, so none is held in memory.

Two texts are equal when they are after all characters of ``[\\x20\\x09-\\x0D]`` are deleted; NULL is the empty text.
The row with the most code points stays, then the smallest id (NULL last), then the row read first. Repeated rows,
also of one id, are separate rows of which one stays. An empty table gives an empty result. Other columns, whatever
their names, are carried by ``keep_first`` and ignored by ``digest_groups``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import numbered, text_of, without
from riskgraph.operators.lineage import cut

BLANKS = " \t\n\x0b\x0c\r"
SUPPORT = 0.001


def _classify(rows: DataFrame, support: float) -> DataFrame:
    """``rows``: rid, doc_id, n_points, digest, written once. Adds the group's size and its winner's id and number."""
    names = rows.select(F.hex("digest").alias("digest")).stat.freqItems(["digest"], support)
    frequent = cut(names.select(F.explode("digest_freqItems").alias("name")).select(F.unhex("name").alias("digest")))
    order = F.struct((-F.col("n_points")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    group = [F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first")]
    counted = rows.join(F.broadcast(frequent), "digest").groupBy("digest").agg(*group)
    winners = cut(counted.where(F.col("group_size") >= support * rows.count()))
    heavy = rows.join(F.broadcast(winners), "digest")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    return heavy.unionByName(light.join(light.groupBy("digest").agg(*group), "digest"))


def _digest(text_col: str) -> list:
    text = text_of(text_col)
    return [F.length(text).alias("n_points"), F.unhex(F.sha2(F.translate(text, BLANKS, ""), 256)).alias("digest")]


def digest_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Texts are read once, then only digests."""
    rows = cut(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), *_digest(text_col)))
    return _classify(rows, support).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("first.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The documents, one of each group of equal texts, with all their columns."""
    whole = numbered(docs)
    rows = cut(whole.select("rid", F.col(f"row.{id_col}").alias("doc_id"), *_digest(f"row.{text_col}")))
    return without(whole, _classify(rows, support).where(F.col("rid") != F.col("first.rid")))
