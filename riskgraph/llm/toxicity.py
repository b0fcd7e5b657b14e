"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Each class has discounted counts of letter n-grams of the highest order, within words and with their edges; all lower
orders are one Kneser-Ney chain of continuation counts that both classes share, so a rare expression is judged by
what the classes have in common. Where neither class has seen an n-gram the shared chain cancels out of the ratio and
only the two backoff weights remain; so the model is one table of log-likelihood ratios for seen n-grams and one for
contexts.

A word's ratio is the sum over its letters. A text's features are the length-normalised ratio (over all its letters),
and how many words, at what strength, stand out; logistic regression on the half of the labelled texts that built no
counts turns them into a score. All labelled training documents are read, by tasks that count n-grams and sum Newton
steps; the driver holds the distinct n-grams, whose number the letters of words bound. Every text is scored whole.

NULL texts and texts without letters get the score of an empty text. Without labels of both classes every score is
the share of toxic labels (0 if there are none). Repeated rows and ids are scored row by row. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import all_labelled_texts, fit_logistic_rows, logistic, runs, score_texts
from riskgraph.llm.quality import Constant
from riskgraph.operators.lineage import cut

ORDER, DISCOUNT, THRESHOLD = 6, 0.75, 0.3
WORDS = 1 << 18  # distinct words that a task holds before it gives their n-grams on
WORD = re.compile(r"[^\W\d_]+")
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
EDGE = 1
STRONG = 2.5


def _spread(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters with ORDER - 1 edges before and one after each word, and the word of each letter."""
    pad = chr(EDGE) * (ORDER - 1)
    chars = np.frombuffer("".join([f"{pad}{w}{chr(EDGE)}" for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(w) for w in words], dtype=np.int64) + ORDER
    return chars, np.repeat(np.arange(len(words)), sizes)


def _hashes(chars: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each place, from the place where n fit; order n hashes differ by n."""
    out = np.full(len(chars) - n + 1, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out + chars[i : len(chars) - n + 1 + i].astype(np.uint64)) * STEP
            out ^= out >> np.uint64(31)
    return out


class KneserNey:
    def __init__(self, toxic: Counter, ordinary: Counter) -> None:
        self._build([self._count(c) for c in (toxic, ordinary)])

    @classmethod
    def of_grams(cls, grams: pa.Table) -> KneserNey:
        """From the counts of both classes (gram, toxic, ordinary)."""
        rows = np.frombuffer("".join(grams["gram"].to_pylist()).encode("utf-32-le"), dtype=np.uint32).reshape(-1, ORDER)
        model = cls.__new__(cls)
        model._build([(rows[n > 0], n[n > 0]) for n in (grams[c].to_numpy().astype(float) for c in ("toxic", "ordinary"))])
        return model

    def _build(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        whole, first = np.unique(np.concatenate([c[0] for c in counts]), axis=0, return_index=True)
        shared = self._shared(whole)
        gram = _rows_hash(whole)
        context = _rows_hash(whole[:, :-1])
        self.context, inverse = np.unique(context, return_inverse=True)
        logs, backs = [], []
        for rows, n in counts:
            mine = np.zeros(len(whole))
            order = np.argsort(gram)
            mine[order[np.searchsorted(gram[order], _rows_hash(rows))]] = n
            total = np.bincount(inverse, mine, minlength=len(self.context))
            kinds = np.bincount(inverse, mine > 0, minlength=len(self.context))
            back = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            logs.append(np.log(np.maximum(mine - DISCOUNT, 0) / np.maximum(total, 1)[inverse] + back[inverse] * shared))
            backs.append(np.log(back))
        order = np.argsort(gram)
        self.gram, self.ratio = gram[order], (logs[0] - logs[1])[order].astype(np.float32)
        self.back = (backs[0] - backs[1]).astype(np.float32)
        self.weights = np.zeros(0)

    @staticmethod
    def _count(words: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the highest order as rows of letters, and their counts."""
        chars, word = _spread(list(words))
        rows = np.lib.stride_tricks.sliding_window_view(chars, ORDER)
        inside = word[: len(rows)] == word[ORDER - 1 :]
        rows, weight = rows[inside], np.array(list(words.values()))[word[: len(rows)][inside]]
        key = _rows_hash(rows)
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        return rows[first], np.bincount(inverse, weight)

    @staticmethod
    def _shared(whole: np.ndarray) -> np.ndarray:
        """Probability of each row's last letter after the letters before it, less the first, by continuation counts."""
        alphabet = len(np.unique(whole[:, -1]))
        chain = np.full(len(whole), 1.0 / (alphabet + 1))
        for n in range(1, ORDER):
            longer = np.unique(_rows_hash(whole[:, ORDER - 1 - n :]), return_index=True)[1]  # distinct rows of n + 1
            tail, head = _rows_hash(whole[:, ORDER - n :]), _rows_hash(whole[:, ORDER - n : -1]) if n > 1 else np.zeros(len(whole), np.uint64)
            tails, tail_of = np.unique(tail, return_inverse=True)
            heads, head_of = np.unique(head, return_inverse=True)
            count = np.bincount(tail_of[longer], minlength=len(tails))  # what precedes the n letters
            total = np.bincount(head_of[longer], minlength=len(heads))
            one = np.unique(tail_of, return_index=True)[1]
            kinds = np.bincount(head_of[one], minlength=len(heads))
            chain = np.maximum(count[tail_of] - DISCOUNT, 0) / total[head_of] + DISCOUNT * kinds[head_of] / total[head_of] * chain
        return chain

    def word_ratios(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        chars, word = _spread(words)
        gram, context = _hashes(chars, ORDER), _hashes(chars, ORDER - 1)[:-1]
        inside = word[: len(gram)] == word[ORDER - 1 :]
        gram, context, word = gram[inside], context[inside], word[: len(gram)][inside]
        place = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        value = self.ratio[place]
        unseen = np.flatnonzero(self.gram[place] != gram)
        place = np.minimum(np.searchsorted(self.context, context[unseen]), len(self.context) - 1)
        value[unseen] = np.where(self.context[place] == context[unseen], self.back[place], 0)
        return np.bincount(word, value, minlength=len(words))

    def features(self, texts: list[str]) -> np.ndarray:
        found = [WORD.findall(t.lower()) for t in texts]
        words = pa.array([w for ws in found for w in ws], pa.string()).dictionary_encode()
        names = words.dictionary.to_pylist()
        ratios = self.word_ratios(names)
        at = words.indices.to_numpy()
        text = np.repeat(np.arange(len(texts)), [len(ws) for ws in found])
        each, size = ratios[at], np.array([len(n) + 1 for n in names], dtype=float)[at] if len(at) else np.zeros(0)
        per = lambda v: np.bincount(text, v, minlength=len(texts))
        letters, many = np.maximum(per(size), 1), np.maximum(np.bincount(text, minlength=len(texts)), 1)
        strong = np.maximum(each - STRONG, 0)
        best = np.zeros(len(texts))
        np.maximum.at(best, text, each)
        return np.column_stack([10 * per(each) / letters, np.log1p(per(strong)), 10 * np.sqrt(per(strong) / many), best / 5])

    def __call__(self, texts: list[str]) -> np.ndarray:
        return logistic(self.features(texts), self.weights)


def _rows_hash(rows: np.ndarray) -> np.ndarray:
    """The same hash as ``_hashes`` gives, for rows of letters."""
    out = np.full(len(rows), rows.shape[1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows.shape[1]):
            out = (out + rows[:, i].astype(np.uint64)) * STEP
            out ^= out >> np.uint64(31)
    return out


def _grams_of(words: Counter) -> tuple[list[str], np.ndarray]:
    rows, counts = KneserNey._count(words)
    text = rows.astype(np.uint32).tobytes().decode("utf-32-le")
    return [text[i : i + ORDER] for i in range(0, len(text), ORDER)], counts


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): how often each n-gram stands in the words of (text, label) of either class."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Counter(), Counter()]

        def found() -> Iterator[pa.RecordBatch]:
            for label, counter in enumerate(words):
                if counter:
                    grams, n = _grams_of(counter)
                    n = n.astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"gram": pa.array(grams, pa.string()), "toxic": n * label, "ordinary": n * (1 - label)})
                counter.clear()

        for batch in runs(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                words[label].update(WORD.findall(text.lower()))
            if sum(map(len, words)) > WORDS:
                yield from found()
        yield from found()

    return texts.select("text", "label").mapInArrow(count, "gram string, toxic long, ordinary long").groupBy("gram").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _features(texts: DataFrame, model: KneserNey) -> DataFrame:
    """(features, label) of each text, written."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            found = shared.value.features(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.list_(pa.float64())), batch.column("label")], ["features", "label"])

    return cut(texts.select("text", "label").mapInArrow(features, "features array<double>, label int"))


def fit(texts: DataFrame, odds: float | None = None) -> Constant | KneserNey:
    """The scorer of (text, label, half) rows: every second text of each class calibrates."""
    sizes = {(r.label, r.half): r["count"] for r in texts.groupBy("label", "half").count().collect()}
    total = [sum(n for (label, _), n in sizes.items() if label == c) for c in (0, 1)]
    if not all(total):
        return Constant(total[1] / sum(total) if sum(total) else 0.0)
    counted = texts.where("NOT half")
    grams = cut(gram_counts(counted)).toArrow().combine_chunks()
    if not all(grams.num_rows and grams[c].to_numpy().sum() for c in ("toxic", "ordinary")):
        return Constant(total[1] / sum(total))
    model = KneserNey.of_grams(grams)
    use = texts.where("half") if all((c, True) in sizes for c in (0, 1)) else counted
    model.weights = fit_logistic_rows(_features(use, model), 4, odds)
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (of being toxic), predicted for every row."""
    return score_texts(docs, fit(*all_labelled_texts(docs, labels, "toxic", id_col, text_col)), THRESHOLD, id_col, text_col)
