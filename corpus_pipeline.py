"""The corpus pipeline: language, exact copies, near copies, benchmark passages, pieces.

Every stage takes any columns beside ``doc_id``, ``text`` and ``lang`` and gives back those of ``documents``, but for the
last one. Tables that a stage has cut and its result reads are removed when a later stage begins whose input does not
read them: a stage's result is written before the next stage is called.

From the first stage on, the session sends Python at most ``TEXT_ROWS`` rows at a time: a batch of Spark's 10,000 whole
texts is a task's whole part of the table, which executor and worker would both hold. A smaller limit stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from riskgraph.llm import decontaminate, exact_dedup, language, near_copies, pieces
from riskgraph.llm.queries import PIECE_MODEL
from riskgraph.operators.lineage import cut, discard, scope

Stage = Callable[..., DataFrame]
TEXT_ROWS, BATCH_ROWS = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
_left: list[str] = []


def tidy(stage: Stage) -> Stage:
    """The stage, first removing what earlier ones have left for their written results; its texts move in small batches."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, **options) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_ROWS)) <= TEXT_ROWS:  # 0 and below: no limit
            spark.conf.set(BATCH_ROWS, TEXT_ROWS)
        discard(spark, _left, unless_read_by=docs)
        _left.clear()
        with scope(spark, around=True) as lasting:
            out = stage(spark, docs, sf_dir, **options)
        _left.extend(lasting)
        return out

    return run_stage


@tidy
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model tells; NULL texts and texts without a letter go. Repeated rows stay."""
    return language.keep_known(docs, language.train(docs))


@tidy
def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts equal without blanks: the longest, then the smallest id (NULL last), then the row read first. NULL is empty."""
    return exact_dedup.keep_first(docs)


@tidy
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of texts whose SimHash fingerprints differ in three bits at most or whose five-word Jaccard
    similarity is 0.8 or more: the smallest id (NULL last), then the row read first. NULL is empty."""
    return near_copies.keep_one_by_both(docs)


@tidy
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage was found; NULL and empty texts stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), stride=decontaminate.STRIDE)


@tidy
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    """doc_id, pieces, n_pieces, lossless of every row; NULL and empty texts have no pieces."""
    return pieces.encode(docs, pieces.load(model))


STAGES = [("language", known_language), ("exact_dedup", unique_texts), ("near_dedup", one_of_near_copies), ("decontaminate", without_benchmark),
          ("sentencepiece", encoded)]

#: The stages train models, hash shingles and call a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
