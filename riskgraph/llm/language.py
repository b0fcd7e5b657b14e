"""Language identification by string kernels, Nystrom landmarks and kernel ridge regression.

The kernel of two texts is the share of distinct character n-grams (orders 1 to ``ORDER``, blended, presence only,
of those the training texts hold) that they have in common: ``|A & B| / sqrt(|A| |B|)`` over letters, with runs of anything else as one blank.
``LANDMARKS`` training texts stand for the training set (Nystrom); one-versus-rest ridge regression is solved in
their feature space. A batch of texts is scored as one product of its presence matrix with the landmarks' matrix and
one with the weights. The score is the softmax of the margins.

The model is fitted on about ``PER_CLASS`` distinct training texts of each language, those of the lowest hashes and one
at least, so copies of a text do not count; there are as many landmarks as languages, if these are more than
``LANDMARKS``. All texts are scored, whole. Training rows have a text with a letter, a language, and an id
that ``held_out`` does not keep back; a NULL id may train. A text that is NULL or has no letter is ``und`` with score
0. If nothing can be learned every text is ``und``. Repeated rows and ids are scored row by row. An empty table gives
an empty result; other columns are carried by ``keep_known`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgraph.llm.common import held_out, runs, text_of
from riskgraph.operators.lineage import cut

ORDER, PER_CLASS, LANDMARKS, RIDGE = 3, 300, 192, 1e-3
SHARPNESS = 8.0
BITS = 22
BATCH = 1 << 19
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Lower-case letter of each of the first 65,536 characters; 0 for what is no letter."""
    table = np.zeros(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _grams(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order, (text number, hashed n-gram) of every place in the texts; and which texts have a letter."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    chars = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = _letters()[np.minimum(chars, (1 << 16) - 1)]
    high = np.flatnonzero(chars >= 1 << 16)
    if len(high):
        letters[high] = [c if chr(c).isalpha() else 0 for c in chars[high].tolist()]
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keep = letters > 0
    has = np.bincount(text[keep], minlength=len(texts)) > 0
    keep[1:] |= keep[:-1]  # the first other character after a letter stays as a blank
    keep[np.cumsum(sizes) - 1] = True
    letters, text = letters[keep] * np.uint32(0x9E3779B1), text[keep]
    orders, code = [], np.zeros(len(letters), dtype=np.uint32)
    for n in range(1, ORDER + 1):
        code = (code[:-1] if n > 1 else code) * np.uint32(0x01000193) + letters[n - 1 :] + np.uint32(n)
        mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        same = text[: len(text) - n + 1] == text[n - 1 :]  # no n-gram reaches over two texts
        orders.append((text[n - 1 :][same], (mixed >> np.uint32(32 - BITS))[same]))
    return orders, has


class Model:
    """Landmarks, their grams as columns, and the ridge weights."""

    def __init__(self, texts: list[str], labels: list[str]) -> None:
        self.classes = sorted(set(labels))
        orders, _ = _grams(texts)
        used = np.unique(np.concatenate([gram for _, gram in orders]))
        self.column = np.full(1 << BITS, -1, dtype=np.int32)
        self.column[used] = np.arange(len(used))
        turns = {x: 0 for x in self.classes}
        turn = []
        for x in labels:
            turn.append(turns[x])
            turns[x] += 1
        marks = np.sort(np.lexsort((np.arange(len(texts)), turn))[: max(LANDMARKS, len(self.classes))])  # the classes by turns
        self.landmarks = np.zeros((len(used), len(marks)), dtype=np.float32)
        self.landmarks[:] = np.concatenate([x for x in self._presence(*_grams([texts[i] for i in marks]))]).T
        self.landmarks /= np.sqrt(self.landmarks.sum(axis=0))
        kernel = self._kernel(*_grams(texts)).astype(float)
        values, vectors = np.linalg.eigh(kernel[marks])
        good = values > 1e-6 * values[-1]
        project = vectors[:, good] / np.sqrt(values[good])
        features = kernel @ project
        target = np.where(np.array(labels)[:, None] == np.array(self.classes)[None, :], 1.0, -1.0)
        weight = 1.0 / np.array([turns[x] for x in labels], dtype=float)  # each language weighs the same
        ridge = (features * weight[:, None]).T @ features + RIDGE * np.eye(features.shape[1])
        self.weights = (project @ np.linalg.solve(ridge, (features * weight[:, None]).T @ target)).astype(np.float32)

    def _presence(self, orders: list[tuple[np.ndarray, np.ndarray]], has: np.ndarray) -> Iterator[np.ndarray]:
        """Blocks of the texts' rows over the n-grams of the training texts: 1 where the n-gram occurs."""
        columns = [(text, self.column[gram]) for text, gram in orders]
        for lo in range(0, len(has), 256):
            block = np.zeros((min(256, len(has) - lo), len(self.landmarks)), dtype=np.float32)
            for text, column in columns:
                a, b = np.searchsorted(text, [lo, lo + 256])
                known = column[a:b] >= 0
                block[text[a:b][known] - lo, column[a:b][known]] = 1.0
            yield block

    def _kernel(self, orders: list[tuple[np.ndarray, np.ndarray]], has: np.ndarray) -> np.ndarray:
        parts = [(x @ self.landmarks) / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] for x in self._presence(orders, has)]
        return np.concatenate(parts)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        orders, has = _grams(texts)
        margin = SHARPNESS * (self._kernel(orders, has) @ self.weights)
        share = np.exp(margin - margin.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names = [self.classes[i] if h else UNKNOWN for i, h in zip(best.tolist(), has.tolist(), strict=True)]
        return names, np.where(has, share[np.arange(len(best)), best], 0.0).astype(float)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = PER_CLASS) -> Model | None:
    """Fit on training texts chosen by a hash of the text: about ``per_class`` of each language reach the driver."""
    texts = text_of(text_col)
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & texts.rlike(r"\p{L}")).select(
        texts.alias("text"), F.col(lang_col).cast("string").alias("lang"))
    hashed = cut(rows.select("lang", F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 30)).alias("hash")).distinct())
    counts = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("least"))
    share = F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("n")) * F.lit(float(1 << 30))
    limits = cut(counts.select("lang", F.greatest(share.cast("long"), F.col("least") + 1).alias("limit")))
    some = rows.withColumn("hash", F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 30))).join(F.broadcast(limits), "lang")
    picked = sorted((r.lang, r.text) for r in some.where("hash < limit").select("lang", "text").distinct().collect())
    if not picked:
        return None
    return Model([t for _, t in picked], [x for x, _ in picked])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    return _scored(rows, model).drop("text")


def keep_known(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents whose language the model knows, with all their columns; ``und`` ones go."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of(text_col).alias("text"))
    return _scored(rows, model).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def _scored(rows: DataFrame, model: Model | None) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([*(f for f in rows.schema if f.name != "text"), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, limit=BATCH):
            texts = batch.column("text").to_pylist()
            names, scores = shared.value.predict(texts) if shared.value else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(names), pa.array(scores)], [*others, "lang_pred", "score"])

    return rows.mapInArrow(score, schema)
