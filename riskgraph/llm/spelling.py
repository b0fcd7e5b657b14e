"""Grouping of spelling variants: words one edit apart, found through PartEnum signatures of their letter multisets.

*Words* are the runs of Latin letters of whole texts, A-Z lower-cased, of ``SHORTEST`` code points or more that occur
``LEAST`` times or more in all. A keyed hash of document and run takes one letter out of every ``EVERY``-th run, so that
unchanged corpora hold known misspellings; 0 leaves all runs as they are. Each task counts its words in a table of bounded
size before they are shuffled.

*Signatures.* One inserted, deleted or replaced letter changes the multiset of a word's letters, as a binary vector of
(letter, number of its occurrence), in at most ``BITS`` = 2 places. The letters are dealt into ``n1 * n2`` parts, balanced by
their counts. By the pigeonhole principle one of the ``n1`` groups of parts differs in at most ``BITS // n1`` places, and so at
least ``n2 - BITS // n1`` of its parts not at all: every choice of that many parts of a group, with what they hold, is a
signature, and two words one edit apart share one. An edit cannot touch both the first and the last ``AFFIX`` letters of a
word this long, so each signature is joined once with the first letters and once with the last. That key is equal for near
words still, and frequent multisets are split by it. What a part holds enters as a sum of 64-bit hashes; a collision
costs one more verification and changes no result.

Keys are joined by equality; in the join itself the bounded edit distance decides. No candidate is written, only links.

A word's *form* is its near word of the largest count (ties: the first in code-point order), if that count is ``TIMES`` times
its own or more; *root* follows forms to the last one, by doubling. Counts grow along a chain, so there are no cycles.

NULL and empty texts have no words. A NULL id counts as an empty text in the hash; repeated rows count as often as they
occur. Words have no upper length. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import runs, text_of
from riskgraph.operators.lineage import cut, scope

SHORTEST, LEAST, EVERY, TIMES = 7, 2, 31, 10
BITS, N1, N2, AFFIX = 2, 1, 4, 3
TABLE = 1 << 18  # words that a task holds before it hands its counts on
LETTERS = "a-zÀ-ÿ"
MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def changed(run: str, prefix: int, every: int) -> str:
    """The run, or what is left of it where the hash of document and run asks for it; ``prefix``: the crc32 of the document's part."""
    h = zlib.crc32(run.encode("utf-8"), prefix)
    if not every or h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY) -> DataFrame:
    """word, n of all words."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_of(text_col).alias("text"))
    pattern = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in runs(batches):
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(pattern.findall(text.encode("utf-8").lower().decode("utf-8"))).items():
                    word = changed(run, prefix, every)
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) > TABLE:
                    yield table(counts)
                    counts = Counter()
        yield table(counts)

    return rows.mapInArrow(each, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ---- signatures ----------------------------------------------------------------------------------------------
def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
        return x ^ (x >> np.uint64(31))


def letter_parts(vocabulary: DataFrame, parts: int) -> dict[str, int]:
    """The part of each letter, dealt in the order of counts; an alphabet's rows reach the driver."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count()
    ordered = sorted(letters.collect(), key=lambda r: (-r["count"], r["letter"]))
    return {r["letter"]: i % parts if i // parts % 2 == 0 else parts - 1 - i % parts for i, r in enumerate(ordered)}


def signatures(words: list[str], part: dict[str, int], n1: int, n2: int, affix: int) -> np.ndarray:
    """A row of keys for each word."""
    sizes = np.array([len(w) for w in words])
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    starts = np.cumsum(sizes) - sizes
    alphabet, letter = np.unique(code, return_inverse=True)
    of = np.array([part.get(chr(c), 0) for c in alphabet])[letter]
    value = _mixed((alphabet.astype(np.uint64) + np.uint64(1)) * MIX[0])[letter]
    with np.errstate(over="ignore"):
        held = [np.add.reduceat(np.where(of == p, value, np.uint64(0)), starts) for p in range(n1 * n2)]
        ends = []
        for side, first in enumerate((starts, starts + sizes - affix)):
            h = np.full(len(words), side + 1, dtype=np.uint64)
            for i in range(affix):
                h = _mixed(h * MIX[0] + code[first + i])
            ends.append(h)
        found = []
        for group in range(n1):
            for kept in combinations(range(n2), n2 - BITS // n1):
                h = np.full(len(words), (group << 16) + sum(1 << p for p in kept), dtype=np.uint64)
                for p in kept:
                    h = _mixed(h * MIX[0] + held[group * n2 + p])
                found.extend(_mixed(h + end) for end in ends)
    return np.stack(found, axis=1).view(np.int64)


def near_words(vocabulary: DataFrame, n1: int = N1, n2: int = N2, affix: int = AFFIX, shortest: int = SHORTEST) -> DataFrame:
    """``vocabulary``: word, written once. Pairs (left, right) of words exactly one edit apart, left before right."""
    if not 0 < n1 <= BITS + 1 or n2 <= BITS // n1 or 2 * affix >= shortest:
        raise ValueError("signatures need parts that stay equal, and affixes that an edit cannot both touch")
    part = letter_parts(vocabulary, n1 * n2)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "word", 1 << 18):
            keys = signatures(batch.column("word").to_pylist(), part, n1, n2, affix)
            word = batch.column("word").take(pa.array(np.repeat(np.arange(len(keys)), keys.shape[1])))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), word], ["key", "word"])

    keyed = vocabulary.select("word").mapInArrow(each, "key long, word string")
    one, other = keyed.withColumnRenamed("word", "left"), keyed.withColumnRenamed("word", "right")
    near = (F.col("left") < F.col("right")) & (F.abs(F.length("left") - F.length("right")) <= 1) & (F.levenshtein("left", "right", 1) == 1)
    return one.join(other, "key").where(near).select("left", "right").distinct()


# ---- forms and roots -----------------------------------------------------------------------------------------
def last_forms(forms: DataFrame) -> DataFrame:
    """``forms``: word, form. Adds ``root``, the last of the chain, by doubling its length until nothing moves."""
    led = cut(forms.select("word", "form", F.col("form").alias("root")))
    while True:
        further = cut(led.join(led.select(F.col("word").alias("root"), F.col("root").alias("next")), "root").select("word", "next"))
        if further.isEmpty():
            return led
        led = cut(led.join(further, "word", "left").select("word", "form", F.coalesce("next", "root").alias("root")))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    with scope(docs.sparkSession):
        vocabulary = cut(words(docs, id_col, text_col, every=every), lasting=True)
        links = cut(near_words(vocabulary))
        both = links.unionByName(links.select(F.col("right").alias("left"), F.col("left").alias("right")))
        counted = both.join(vocabulary.select(F.col("word").alias("right"), F.col("n").alias("m")), "right")
        best = F.min(F.struct((-F.col("m")).alias("less"), F.col("right").alias("form")))
        near = counted.groupBy(F.col("left").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        kept = F.col("form_n") >= times * F.col("n")
        formed = cut(vocabulary.join(near, "word", "left").withColumn("form_n", -F.col("best.less")).select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(kept, F.col("best.form")).alias("form"),
            F.when(kept, F.col("form_n")).alias("form_n")), lasting=True)
        roots = cut(last_forms(formed.where("form is not null").select("word", "form")).select("word", "root"), lasting=True)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
