"""Near copies: one text of each component of texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

The sets hold all runs of ``WORDS`` words, A-Z lower-cased; a shorter text is one shingle, a NULL or blank one the
empty shingle, so that blank texts are copies of each other. The join is that of ``ngram_join``: it loses no pair, and
removes its tables when it ends. ``keep_one_by_both`` takes the components over the links of both methods: SimHash
fingerprints of ``simhash``, found by its tries, and the similar sets, many of which lie beyond its bits.

Repeated rows and ids are separate rows; ids may be of any type that can be ordered. Of a component the row with the
smallest id (NULL last), then the first read, stays. An empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm import ngram_join, simhash
from riskgraph.llm.common import numbered, text_of, without
from riskgraph.operators.lineage import cut, scope

WORDS, PERCENT = 5, 80


def _rows(whole: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return whole.select("rid", F.col(f"row.`{id_col}`").alias("doc_id"), text_of(F.col(f"row.`{text_col}`")).alias("text"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, one of each component of similar ones, with all their columns."""
    with scope(docs.sparkSession):
        whole = numbered(docs)
        rows = _rows(whole, id_col, text_col)
        found = ngram_join.first_of(rows, ngram_join.classes(rows, words, percent, blank=True))
        return without(whole, found.where("rid <> first.rid"))


def keep_one_by_both(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, one of each component over links of fingerprints (those of ``simhash``) and of similar sets, with all their columns."""
    spark = docs.sparkSession
    with scope(spark):
        whole = numbered(docs)
        rows = _rows(whole, id_col, text_col)
        with scope(spark):  # the tables of the tries go before the sets are joined
            prints = simhash.labelled(cut(simhash.fingerprints(rows)))
            alike = cut(prints.where("rid <> first.rid").select(F.col("rid").alias("left"), F.col("first.rid").alias("right")), lasting=True)
        sets = ngram_join.classes(rows, words, percent, blank=True)
        links = alike.unionByName(sets.where("rid <> root").select(F.col("rid").alias("left"), F.col("root").alias("right")))
        roots = cut(simhash.components(links).select(F.col("node").alias("rid"), "root"))
        found = sets.select("rid", "n").join(roots, "rid", "left").select("rid", "n", F.coalesce("root", "rid").alias("root"))
        return without(whole, ngram_join.first_of(rows, found).where("rid <> first.rid"))
