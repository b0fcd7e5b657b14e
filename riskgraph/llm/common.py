"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.lineage import cut

BATCH_CHARS = 1 << 20


def text_of(column: str | Column) -> Column:
    """The text, an empty one for NULL."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def held_out(doc_id: str | Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 2 when divided by 4. A NULL id: false."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % 4 == 2, F.lit(False))


def numbered(docs: DataFrame) -> DataFrame:
    """``row`` (all columns as one struct, so that no name can clash) and ``rid``, unique and fixed by writing them once."""
    return cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("rid")), lasting=True)


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents of ``numbered`` rows whose ``rid`` is not in ``dropped``.

    The dropped numbers are written first, so that the planner knows their bytes and moves the texts only if they
    are too many to be sent to every task.
    """
    return rows.join(cut(dropped.select("rid"), lasting=True), "rid", "left_anti").select("row.*")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, share: float = 0.001) -> DataFrame:
    """``rows`` joined with their row of ``groups`` (written once) by ``key``; ``size``: the column with a group's number of rows.

    Groups that hold a ``share`` of all rows or more, at most ``1 / share``, are sent to the rows, which stay where they
    are; only rows of the smaller groups are shuffled. So no group is a task of its own.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = cut(groups.where(F.col(size) >= share * total), lasting=True)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups, key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def slices(sizes: np.ndarray, limit: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Cut rows into runs of about ``limit`` characters; a longer row is a run of its own."""
    lo, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def runs(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        column = batch.column(text)
        sizes = np.nan_to_num(np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=float))
        for lo, hi in slices(sizes.astype(np.int64), limit):
            yield batch.slice(lo, hi - lo)
            pa.default_memory_pool().release_unused()  # workers live on; what a run needed goes back before the next


def known_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(_id, _label) of the labelled training documents.

    Rows kept from training, NULL ids and labels other than 0 and 1 are left out; of several labels of one document
    the largest counts.
    """
    return labels.where(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(label).cast("int").alias("_label"))


def log_odds(counts: dict[int, int]) -> float:
    return float(np.log(counts.get(1, 0) + 0.5) - np.log(counts.get(0, 0) + 0.5))


def all_labelled_texts(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float]:
    """(text, label, half) of every labelled training document, each pair once; log odds of 1 among these documents.

    ``half`` is true for every second text of its class, in their order. Ids and labels, two numbers a document, are sent
    to the documents; of those only the labelled ones move, once, into ranges in which tasks drop copies and count.
    """
    known = cut(known_labels(labels, label, id_col))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text"))
    rows = texts.join(F.broadcast(known), "_id").select("text", F.col("_label").alias("label"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, places = TaskContext.get().partitionId(), None, [0, 0]
        for batch in runs(batches):
            kept, place = [], []
            for i, pair in enumerate(zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if pair != last:
                    kept.append(i)
                    place.append(places[pair[0]])
                    places[pair[0]] += 1
                last = pair
            once = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text").take(once), batch.column("label").take(once), pa.array([part] * len(kept), pa.int32()), pa.array(place, pa.int64())],
                ["text", "label", "part", "place"])

    ordered = rows.repartitionByRange("label", "text").sortWithinPartitions("label", "text")
    numbered = cut(ordered.mapInArrow(number, "text string, label int, part int, place long"))
    before, total = [], {0: 0, 1: 0}
    for r in numbered.groupBy("part", "label").count().orderBy("part").collect():
        before.append((r["part"], r["label"], total[r["label"]]))
        total[r["label"]] += r["count"]
    offsets = docs.sparkSession.createDataFrame(before, "part int, label int, before long")
    half = ((F.col("before") + F.col("place")) % 2 == 1).alias("half")
    return numbered.join(F.broadcast(offsets), ["part", "label"]).select("text", "label", half), log_odds(counts)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[list[tuple[str, int]], float]:
    """(text, 0 or 1) of about ``per_class`` training documents of each class, chosen by a hash of the id; log odds of 1
    among all labelled training documents.

    Rows kept from training, NULL ids and labels other than 0 and 1 are left out; of several labels of one document
    the largest counts. The sample is bounded, so it is sent to the documents, which do not move.
    """
    known = known_labels(labels, label, id_col)
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    shares = [int(min(1.0, per_class / max(1, counts.get(c, 0))) * (1 << 30)) for c in (0, 1)]
    part = F.pmod(F.xxhash64("_id", F.lit(label)), F.lit(1 << 30))
    some = cut(known.where(part < F.when(F.col("_label") == 1, F.lit(shares[1])).otherwise(F.lit(shares[0]))))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    sample = {(r["_text"], r["_label"]) for r in texts.join(F.broadcast(some), "_id").select("_text", "_label").collect()}
    return sorted(sample), log_odds(counts)


def _gradient(x: np.ndarray, labels: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Curvature and slope of the log likelihood; ``x`` ends in a column of ones."""
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return (x * (p * (1 - p))[:, None]).T @ x, x.T @ (labels - p)


def _newton(gradient, width: int, penalty: float, rounds: int) -> np.ndarray:
    ridge = penalty * np.eye(width)
    ridge[-1, -1] = 1e-6
    w = np.zeros(width)
    for _ in range(rounds):
        curvature, slope = gradient(w)
        step = np.linalg.solve(curvature + ridge, slope - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_logistic(features: np.ndarray, labels: np.ndarray, odds: float | None = None, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the last one a constant) of a ridge logistic regression, by Newton steps; for a sample balanced by
    class, ``odds`` moves the constant to the log odds among all rows.
    """
    x = np.column_stack([features, np.ones(len(features))])
    w = _newton(lambda w: _gradient(x, labels, w), x.shape[1], penalty, rounds)
    if odds is not None:
        w[-1] += odds - np.log(labels.sum() / (1 - labels).sum())
    return w


def fit_logistic_rows(rows: DataFrame, width: int, odds: float | None = None, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """``fit_logistic`` over written rows (features array<double> of ``width`` numbers, label int of both classes): each
    Newton step sums small matrices over the tasks."""
    size = width + 1

    def gradient(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = np.column_stack([batch.column("features").flatten().to_numpy().reshape(batch.num_rows, width), np.ones(batch.num_rows)])
                    curvature, slope = _gradient(x, batch.column("label").to_numpy(), w)
                    sums = np.concatenate([curvature.ravel(), slope])
                    yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(len(sums)), pa.int32()), "x": sums})

        sums = {r.pos: r.x for r in rows.select("features", "label").mapInArrow(partial, "pos int, x double").groupBy("pos").agg(F.sum("x").alias("x")).collect()}
        flat = np.array([sums[k] for k in range(size * size + size)])
        return flat[: size * size].reshape(size, size), flat[size * size :]

    w = _newton(gradient, size, penalty, rounds)
    if odds is not None:
        counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        w[-1] += odds - np.log(counts[1] / counts[0])
    return w


def logistic(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30)))


def score_texts(docs: DataFrame, scorer, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``scorer`` (sent to all tasks) maps texts to scores."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            scores = np.asarray(shared.value(batch.column("text").to_pylist()), dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
