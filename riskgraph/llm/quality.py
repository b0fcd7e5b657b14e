"""Quality by compression: zstandard dictionaries of good and of bad text, compared by compressed size.

Half of the labelled sample builds one dictionary for each class, the other half calibrates: a text is compressed
whole with either dictionary, and the difference of the two sizes over their sum, with the better ratio and the
length beside it, becomes a score through logistic regression. The sample is bounded by ``PER_CLASS`` documents of
each class; every text is scored.

NULL and empty texts get the score of an empty text. Without labels of both classes every score is the share of good
labels (0.5 if there are none). Repeated rows and ids are scored row by row. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from riskgraph.llm.common import fit_logistic, labelled_texts, logistic, score_texts

PER_CLASS, DICTIONARY, LEVEL, THRESHOLD = 1500, 64 << 10, 3, 0.7


class Constant:
    """A score for when nothing can be learned."""

    def __init__(self, value: float) -> None:
        self.value = value

    def __call__(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.value)


class Compressors:
    """Scores texts by the sizes that the two dictionaries compress them to."""

    def __init__(self, good: list[bytes], bad: list[bytes]) -> None:
        self.dictionaries = [_dictionary(x) for x in (good, bad)]
        self.weights = np.zeros(0)

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "weights": self.weights}

    @cached_property
    def _tools(self) -> list[zstandard.ZstdCompressor]:
        return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
                for d in self.dictionaries]

    def features(self, texts: list[str]) -> np.ndarray:
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        good, bad = (np.array([len(tool.compress(x)) for x in raw], dtype=float) for tool in self._tools)
        size = np.array([len(x) for x in raw], dtype=float) + 1
        gap, ratio, length = (bad - good) / (bad + good), np.log(np.minimum(good, bad) / size), np.log(size)
        return np.column_stack([10 * gap, ratio, ratio * ratio, length / 5, gap * length, ratio * length / 5])

    def __call__(self, texts: list[str]) -> np.ndarray:
        return logistic(self.features(texts), self.weights)


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples for that, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def fit(sample: list[tuple[str, int]], odds: float | None = None) -> Constant | Compressors:
    labels = np.array([y for _, y in sample])
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels.mean()) if len(labels) else 0.5)
    half = np.zeros(len(sample), dtype=bool)  # every second text of each class calibrates
    for c in (0, 1):
        half[np.flatnonzero(labels == c)[1::2]] = True
    build = lambda c: [t.encode("utf-8", "surrogatepass") for (t, y), held in zip(sample, half.tolist(), strict=True) if y == c and not held]
    model = Compressors(build(1), build(0))
    use = half if len(set(labels[half].tolist())) == 2 else ~half
    model.weights = fit_logistic(model.features([t for (t, _), u in zip(sample, use.tolist(), strict=True) if u]), labels[use], odds)
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score (of good quality), predicted for every row."""
    return score_texts(docs, fit(*labelled_texts(docs, labels, "quality", per_class, id_col, text_col)), THRESHOLD, id_col, text_col)
