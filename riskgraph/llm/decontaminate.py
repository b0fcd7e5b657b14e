"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

Both sides are folded: white space runs become one space, letters become lower case one by one. Each benchmark item
is cut into windows of ``WINDOW`` characters every ``stride`` characters (a shorter item is one window, the last window
ends with the item): at ``STRIDE`` any quote of ``WINDOW`` characters lies within half a stride of a window, which its
edits cover, wherever it starts. A window of n characters may differ from a document's region by ``n // PER_EDIT`` edits. A region
within k edits shares at least ``n + 1 - q * (k + 1)`` q-grams with the window, where q is ``Q``, or less in short items
so that the bound stays at 1, all on k + 1 neighbouring diagonals
of each side; diagonal bands of width 2k + 1 that overlap by 2k hold all of them together. Bands whose shared q-grams
meet the bound are verified by banded alignment, free at both ends of the document side.

Runs of one q-gram count by their range of diagonals, shared q-grams and alignments are worked off in slices, and equal
alignments are done once, so a text of one letter repeated needs no more memory than another.

Documents are never shuffled: the folded benchmark is read in blocks of at most ``BLOCK`` characters, each block's
q-gram index is sent to all tasks, and each task streams its texts through it. Every document meets every block.

NULL and empty texts, items or ids: a NULL item text is skipped, a NULL text has no hits, NULL ids are carried. Items
that fold to fewer than ``Q`` characters cannot be evidence and are skipped. Repeated rows and items are answered row
by row; document ids may be of any type. Empty tables give an empty result or all documents; other columns are carried by ``clean`` only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import numbered, runs, text_of, without
from riskgraph.operators.lineage import cut

Q, WINDOW, PER_EDIT, BLOCK = 12, 96, 16, 1 << 22
STRIDE = 8
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BITS = 22
RUN, SLICE, ROWS = 1 << 8, 1 << 19, 1 << 12  # of equal q-grams; of shared ones held at once; of alignments held at once
HITS = "rid long, doc_id {}, item_id long, start long, end long, edits int, windows int"


@cache
def _folds() -> np.ndarray:
    """The single lower-case character of each of the first 65,536 characters, and a blank for white space."""
    lower = [ord(x) if len(x := chr(c).lower()) == 1 and not 0xD800 <= c < 0xE000 else c for c in range(1 << 16)]
    table = np.array(lower, dtype=np.uint32)
    table[[c for c in range(1 << 16) if chr(c).isspace()]] = 32
    return table


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts, each followed by a 0; their places in the joined originals; text offsets."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    chars = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    low = chars < (1 << 16)
    chars[low] = _folds()[chars[low]]
    chars[starts[1:] - 1] = 0
    blank = chars == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    keep[0] = True
    places = np.flatnonzero(keep)
    return chars[places], places, starts


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q-gram at every position where one fits, by doubling."""
    done, hashes, width = 0, np.zeros(max(0, len(chars) - q + 1), dtype=np.uint64), 1
    power = chars.astype(np.uint64) + np.uint64(1)
    scale = BASE
    with np.errstate(over="ignore"):
        while width <= q:
            if q & width:
                hashes = hashes * scale + power[done : done + len(hashes)]
                done += width
            if width * 2 > q:
                break
            power = power[:-width] * scale + power[width:]
            scale, width = scale * scale, width * 2
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes


class Index:
    """The q-grams of a block of items, for each q: sorted hashes with their window and offset, and a bit table before them."""

    def __init__(self, items: list[tuple[int, str]], stride: int = WINDOW // 2) -> None:
        self.item, self.chars = [], []
        for item_id, text in items:
            chars = fold([text])[0][:-1]
            chars = chars[(1 if len(chars) and chars[0] == 32 else 0) : len(chars) - (1 if len(chars) > 1 and chars[-1] == 32 else 0)]
            if len(chars) < Q:
                continue
            last = max(0, len(chars) - WINDOW)
            for at in sorted({*range(0, last, stride), last}):
                self.item.append(item_id)
                self.chars.append(chars[at : at + WINDOW])
        sizes = np.array([len(c) for c in self.chars], dtype=np.int64)
        self.size, self.edits = sizes, sizes // PER_EDIT
        self.q = np.minimum(Q, sizes // (self.edits + 1))
        self.need = sizes + 1 - self.q * (self.edits + 1)
        self.tables = {q: self._table(q, np.flatnonzero(self.q == q)) for q in np.unique(self.q).tolist()}

    def _table(self, q: int, windows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the windows with this q: window and offset of the sorted q-grams; hashes, their first place and count; bits."""
        hashes = [grams(self.chars[w], q) for w in windows.tolist()]
        every = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        window = np.repeat(windows, [len(h) for h in hashes])
        offset = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        found, first, count = np.unique(every[order], return_index=True, return_counts=True)
        bits = np.zeros(1 << BITS, dtype=bool)
        bits[(found >> np.uint64(64 - BITS)).astype(np.int64)] = True
        return window[order].astype(np.int64), offset[order].astype(np.int64), found, first, count, bits

    def _shared(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, first diagonal, number of diagonals) of q-grams shared with the folded characters, in bounded slices.

        A run of one q-gram in the text, as rulers and rows of zeros make it, is one row for each place in a window.
        """
        for q, (window, offset, hashes, first, count, bits) in self.tables.items():
            found = grams(chars, q)
            if not len(found):
                continue
            start = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (np.arange(1, len(found)) % RUN == 0)]))
            length = np.diff(np.append(start, len(found)))
            maybe = np.flatnonzero(bits[(found[start] >> np.uint64(64 - BITS)).astype(np.int64)])
            place = np.minimum(np.searchsorted(hashes, found[start[maybe]]), len(hashes) - 1)
            same = hashes[place] == found[start[maybe]]
            maybe, place = maybe[same], place[same]
            for rows in (length[maybe] == 1, length[maybe] > 1):
                at, long, here = start[maybe[rows]], length[maybe[rows]], place[rows]
                ends = np.cumsum(count[here])
                step = SLICE if not len(long) or long.max() == 1 else SLICE // RUN
                for lo in range(0, int(ends[-1]) if len(ends) else 0, step):
                    pair = np.arange(lo, min(lo + step, int(ends[-1])))
                    run = np.searchsorted(ends, pair, side="right")
                    posting = pair - (ends[run] - count[here[run]]) + first[here[run]]
                    yield window[posting], at[run] - offset[posting], long[run]

    def bands(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first diagonal) of the bands that hold enough shared q-grams; a band is 4k + 1 diagonals wide."""
        keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def summed() -> None:
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, np.concatenate(counts), minlength=len(key)).astype(np.int64)
            keys[:], counts[:] = [key], [total]

        for window, diagonal, long in self._shared(chars):
            diagonal = diagonal + WINDOW  # none below zero
            slack = 2 * self.edits[window]
            step = slack + 1
            lowest, highest = np.maximum((diagonal - slack) // step, 0), (diagonal + long - 1) // step
            many = highest - lowest + 1
            row = np.repeat(np.arange(len(many)), many)
            band = lowest[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            edge = band * step[row]
            inside = np.minimum((diagonal + long)[row], edge + step[row] + slack[row]) - np.maximum(diagonal[row], edge)
            key, inverse = np.unique(window[row] * (1 << 40) + band, return_inverse=True)
            keys.append(key)
            counts.append(np.bincount(inverse, inside, minlength=len(key)).astype(np.int64))
            held += len(key)
            if held > 4 * SLICE:
                summed()
                held = len(keys[0])
        summed()
        window, band = keys[0] >> 40, keys[0] & ((1 << 40) - 1)
        enough = counts[0] >= self.need[window]
        window, band = window[enough], band[enough]
        return window, band * (2 * self.edits[window] + 1) - WINDOW


def align(patterns: np.ndarray, regions: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits between each whole pattern and a part of its region, and the part's start and end, within a band.

    Rows are pairs; pattern character i meets region characters i to i + width - 1. The part may start at any of the
    first ``width`` characters and end at any of the last.
    """
    cost = np.zeros((len(patterns), width), dtype=np.int64)
    origin = np.tile(np.arange(width), (len(patterns), 1))
    column = np.arange(width)
    far = np.full((len(patterns), 1), 1 << 20, dtype=np.int64)
    for i in range(patterns.shape[1]):
        across = cost + (regions[:, i : i + width] != patterns[:, i : i + 1])
        left_out = np.concatenate([cost[:, 1:] + 1, far], axis=1)  # of the pattern
        origin = np.where(across <= left_out, origin, np.concatenate([origin[:, 1:], origin[:, -1:]], axis=1))
        best = np.minimum(across, left_out)
        source = np.minimum.accumulate((best - column) * width + column, axis=1) % width  # put in after this column
        cost = np.take_along_axis(best, source, 1) + column - source
        origin = np.take_along_axis(origin, source, 1)
    last = np.argmin(cost, axis=1)
    rows = np.arange(len(patterns))
    return cost[rows, last], origin[rows, last], patterns.shape[1] + last


def _aligned(index: Index, chars: np.ndarray, window: np.ndarray, lo: np.ndarray, first: np.ndarray, past: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """``align`` of each window of n characters with its region, equal pairs once."""
    width = 8 * (n // PER_EDIT) + 1
    spots = lo[:, None] + np.arange(n + width)
    inside = (spots >= first[:, None]) & (spots < past[:, None])
    regions = np.where(inside, chars[np.clip(spots, 0, len(chars) - 1)], 0)
    named = np.ascontiguousarray(np.column_stack([window.astype(np.uint32), regions.astype(np.uint32)]))
    _, one, of = np.unique(named.view([("", np.uint32)] * named.shape[1]).ravel(), return_index=True, return_inverse=True)
    patterns = np.stack([index.chars[w] for w in window[one].tolist()])
    return tuple(x[of] for x in align(patterns, regions[one], width))


def find(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
    """(text number, item, start, end, edits, windows) for each item with a window in a text; the best window's span."""
    chars, places, starts = fold(texts)
    bounds = np.searchsorted(places, starts)
    window, diagonal = index.bands(chars)
    middle = np.clip(diagonal + 2 * index.edits[window] + index.size[window] // 2, 0, len(chars) - 1)
    own = np.searchsorted(bounds, middle, side="right") - 1
    rows = [np.zeros((0, 5), np.int64)]  # text, window, edits, start, end
    for n in np.unique(index.size[window]).tolist():
        k = n // PER_EDIT
        width = 8 * k + 1
        for beside in (-1, 0, 1):  # a region near a text's end may lie in the next text
            doc = own + beside
            lo = diagonal - 2 * k
            fits = (index.size[window] == n) & (doc >= 0) & (doc < len(texts))
            every = np.flatnonzero(fits)
            first, past = bounds[doc[every]], bounds[doc[every] + 1] - 1
            room = np.minimum(lo[every] + n + width, past) - np.maximum(lo[every], first) >= n - k
            every, first, past = every[room], first[room], past[room]
            for part in range(0, len(every), ROWS):
                at, left, right = (x[part : part + ROWS] for x in (every, first, past))
                edits, begin, end = _aligned(index, chars, window[at], lo[at], left, right, n)
                ok = edits <= k
                a, b = np.maximum(lo[at] + begin, left)[ok], np.minimum(lo[at] + end, right)[ok]
                d = doc[at][ok]
                near = np.column_stack([d, window[at][ok], edits[ok], places[a] - starts[d], places[b - 1] + 1 - starts[d]])
                near = near[np.lexsort(near.T[::-1])]
                rows.append(near[np.concatenate([[True], (near[1:, :2] != near[:-1, :2]).any(axis=1)])[: len(near)]])  # the best of each text and window
    best: dict[tuple[int, int], dict[int, tuple[int, int, int]]] = {}
    for d, w, *span in np.concatenate(rows).tolist():
        windows = best.setdefault((d, index.item[w]), {})
        windows[w] = min(windows.get(w, tuple(span)), tuple(span))
    out = []
    for (d, item), windows in sorted(best.items()):
        edits, start, end = min(windows.values())
        out.append((d, item, start, end, edits, len(windows)))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, stride: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``BLOCK`` characters (fewer at a smaller stride); one block at a time is on the driver."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total * max(1, WINDOW // 2 // stride) // BLOCK)
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        yield [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]


def leaks(rows: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", stride: int = WINDOW // 2) -> DataFrame:
    """``rows``: rid, doc_id, text. One row for each (row, item) with a match: ``HITS``."""
    spark, found = rows.sparkSession, None
    schema = HITS.format(rows.schema["doc_id"].dataType.simpleString())
    for items in _blocks(benchmark, item_col, text_col, stride):
        index = spark.sparkContext.broadcast(Index(items, stride))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in runs(batches):
                hits = find(index.value, batch.column("text").to_pylist())
                if hits:
                    at, *rest = (pa.array(x, pa.int64()) for x in zip(*hits, strict=True))
                    item, start, end, edits, windows = rest
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("rid").take(at), batch.column("doc_id").take(at), item, start, end, edits.cast(pa.int32()), windows.cast(pa.int32())],
                        ["rid", "doc_id", "item_id", "start", "end", "edits", "windows"])

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", stride: int = WINDOW // 2) -> DataFrame:
    """doc_id, item_id, start, end (code points of the best window's region), edits, windows (that match)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return leaks(rows, benchmark, stride=stride).drop("rid")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", stride: int = WINDOW // 2) -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    whole = numbered(docs)
    rows = whole.select("rid", F.col(f"row.`{id_col}`").alias("doc_id"), text_of(F.col(f"row.`{text_col}`")).alias("text"))
    return without(whole, cut(leaks(rows, benchmark, stride=stride).select("rid")).distinct())
