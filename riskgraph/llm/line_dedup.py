"""Line duplicates by a segment-partition edit join.

Lines are split at newlines. Exact copies of a line are one class from the start. Two classes link if their edit
distance is at most the budget of the shorter one: none below ``SHORT`` characters, one below twice that, else
``MOST``. A line of length l with budget t is cut into t + 1 even segments; of any partner at least one segment
stands unchanged at a place that its length and segment number narrow to a few positions, so every line is entered
under its own segments and probes for shorter or equally long partners with those substrings. Keys are 64-bit hashes
of (length, segment number, substring), computed from prefix sums for all lines of a batch at once.

A candidate must also agree in a signature: 64 parities of character counts, of which an edit turns two at most. Lines
under one key are compared by signature in arrays, in the task that the key goes to, and only pairs that agree leave
it. A key with more than ``UNIT`` lines of its own is cut into blocks of about that many; each block is a unit of its
own that all lines of the key probe, so no task holds an unbounded key and no pair is lost. What remains is verified
by banded bit-parallel edit distance over the lines' texts. Only hashes travel until then, and texts only of lines
that are candidates. Classes are the components of the links.

Of each class the first line stays: smallest document id (NULL last), then line number, then row. NULL texts have no
line, an empty text has one empty line; empty lines and blank ones are lines as others, but ``strip`` never removes
them. Repeated rows and ids are separate rows. An empty table gives an empty result; other columns are carried by
``strip`` only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import join_groups, numbered, runs, text_of
from riskgraph.llm.simhash import components
from riskgraph.operators.lineage import cut, scope

SHORT, MOST = 20, 2
UNIT = 2048
PAIRS = 1 << 22
BITMAP = 20
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
MIX = [np.uint64(k) for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def budget(length):
    """Edits that a line of this length may differ by from a longer or equal one; an int or an array of them."""
    return np.minimum(np.asarray(length) // SHORT, MOST)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX[0]
        x = (x ^ (x >> np.uint64(27))) * MIX[1]
        return x ^ (x >> np.uint64(31))


def _codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    chars = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return chars, sizes, np.cumsum(sizes) - sizes


def keys_of(chars: np.ndarray, sizes: np.ndarray, starts: np.ndarray, edits: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, int | np.ndarray]]:
    """(lines, keys, role, place, size) of substrings; role 3: own segments, entered and probed, 2: only probed.

    ``edits`` gives each line's budget for any partner; without it the partner's length does.
    """
    up, down = _powers(1 << max(10, int(len(chars) + 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[: len(chars)])])
    for less in range(MOST + 1):  # how much shorter the partner is
        length = sizes - less
        allowed = budget(np.maximum(length, 0)) if edits is None else edits
        for t in range(max(1, less), MOST + 1):
            rows = np.flatnonzero((allowed == t) & (length >= 0))
            if not len(rows):
                continue
            n, line = length[rows], starts[rows]
            base, odd = n // (t + 1), n % (t + 1)
            for k in range(t + 1):
                size = base + (k >= t + 1 - odd)
                segment = k * base + np.maximum(0, k - (t + 1 - odd))
                for move in range(max(-k, less - (t - k)), min(k, less + t - k) + 1):
                    place = segment + move
                    fits = (place >= 0) & (place + size <= sizes[rows])
                    a = (line + place)[fits]
                    with np.errstate(over="ignore"):
                        part = (sums[a + size[fits]] - sums[a]) * down[a]
                        key = _mixed(part + _mixed(n[fits].astype(np.uint64) * np.uint64(64) + np.uint64(t * 8 + k)))
                    yield rows[fits], key, 2 + (less == 0 and move == 0), place[fits], size[fits]


def _signs(chars: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 parities of character counts; one edit turns at most two."""
    bits = np.uint64(1) << ((chars * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.uint64)
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = np.bitwise_xor.reduceat(bits, starts[full])
    return out.view(np.int64)


def _names(lines: list[str]) -> tuple[list[bytes], np.ndarray]:
    """128-bit hash of each line; the first 63 bits of it as a short name, whose lowest bit is free."""
    names = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]
    front = np.frombuffer(b"".join(names), dtype=">u8")[::2].astype(np.uint64)
    return names, (front & ~np.uint64(1)).view(np.int64)


LINES = "rid long, doc_id {}, line_no int, line binary, short long, signs long, own array<long>, probes array<long>"


def lines_of(rows: DataFrame) -> DataFrame:
    """``rows``: rid, doc_id, text. One row for each line with its hash, short name and keys."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            split = [[] if t is None else t.split("\n") for t in batch.column("text").to_pylist()]
            count = np.array([len(s) for s in split], dtype=np.int64)
            flat = [x for s in split for x in s]
            chars, sizes, starts = _codes(flat)
            names, short = _names(flat)
            lists = []
            found = list(keys_of(chars, sizes, starts))
            for wanted in (3, 2):
                line = np.concatenate([*(x[0] for x in found if x[2] == wanted), np.zeros(0, np.int64)])
                key = np.concatenate([*(x[1] for x in found if x[2] == wanted), np.zeros(0, np.uint64)])
                order = np.argsort(line, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(flat)))]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(ends, pa.array(key[order].view(np.int64))))
            doc = pa.array(np.repeat(np.arange(len(split)), count))
            number = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid").take(doc), batch.column("doc_id").take(doc), pa.array(number.astype(np.int32)), pa.array(names, pa.binary()), pa.array(short),
                 pa.array(_signs(chars, sizes, starts)), *lists], ["rid", "doc_id", "line_no", "line", "short", "signs", "own", "probes"])

    return rows.mapInArrow(each, LINES.format(rows.schema["doc_id"].dataType.simpleString()))


def texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(short, line, words) of the lines whose short name is in ``wanted``; a bitmap of fixed size spares the others the way."""
    slot = F.pmod(F.xxhash64("short"), F.lit(1 << BITMAP)).cast("int")
    bits = np.zeros(1 << BITMAP, dtype=bool)
    bits[[r.slot for r in wanted.select(slot.alias("slot")).distinct().collect()]] = True  # one number a slot at most
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in runs(batches):
            flat = list(dict.fromkeys(x for t in batch.column("text").to_pylist() if t is not None for x in t.split("\n")))
            names, short = _names(flat)
            slots = np.array([_spark_hash(s) for s in short.view(np.uint64).tolist()], dtype=np.int64) if len(flat) else np.zeros(0, np.int64)
            hit = np.flatnonzero(bits[slots & ((1 << BITMAP) - 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(short[hit]), pa.array([names[i] for i in hit.tolist()], pa.binary()), pa.array([flat[i] for i in hit.tolist()], pa.string())],
                ["short", "line", "words"])

    found = rows.mapInArrow(each, "short long, line binary, words string")
    return found.join(wanted, "short", "left_semi").groupBy("line").agg(F.first("short").alias("short"), F.first("words").alias("words"))


def _spark_hash(value: int) -> int:
    """The low bits of Spark's xxhash64 of a long."""
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), 42) & ((1 << BITMAP) - 1)


def candidates(classes: DataFrame, unit: int) -> DataFrame:
    """(left, right) short names of all lines that share a key and agree in their signs, each pair once for each key.

    ``classes``: short, signs, own, probes. A row's lowest bit of ``who`` tells a line that the key is a segment of.
    """
    tagged = F.array(F.struct(F.col("short").bitwiseOR(F.lit(1)).alias("who"), F.col("own").alias("keys")), F.struct(F.col("short").alias("who"), F.col("probes").alias("keys")))
    keyed = classes.select("signs", F.explode(tagged).alias("x")).select("signs", F.col("x.who").alias("who"), F.explode("x.keys").alias("key"))
    own = F.col("who").bitwiseAND(F.lit(1)) == 1
    counts = keyed.where(own).groupBy("key").count()
    hot = cut(counts.where(F.col("count") > unit).select("key", F.ceil(F.col("count") / unit).cast("int").alias("blocks")))
    known = keyed.join(hot, "key", "left")
    plain = known.where("blocks IS NULL").select("key", F.lit(0).alias("block"), "who", "signs")
    crowd = known.where("blocks IS NOT NULL")
    home = F.pmod(F.xxhash64("who"), F.col("blocks")).cast("int")
    every = crowd.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "who", "signs", home.alias("home"), own.alias("own"))
    name = F.when(F.col("own") & (F.col("block") == F.col("home")), F.col("who")).otherwise(F.col("who").bitwiseAND(F.lit(-2)))
    units = plain.unionByName(every.select("key", "block", name.alias("who"), "signs"))
    first = F.col("who").bitwiseAND(F.lit(1))
    sorted_ = units.repartition("key", "block").sortWithinPartitions("key", "block", first.desc())
    return sorted_.mapInArrow(_pairs, "left long, right long")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a segment's line with any other line under the same (key, block). Rows come sorted, segments first.

    The last unit of a batch goes on into the next one: whole while it is short, and then as its segments only, whose
    partners so far have been met.
    """
    held = [np.zeros(0, np.int64)] * 4
    met = 0  # rows at the head of the held ones that have met each other
    for batch in batches:
        rows = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("key", "block", "who", "signs"), strict=True)]
        n = len(rows[0])
        if not n:
            continue
        new = np.flatnonzero(np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]))
        last = int(new[-1])
        yield from _met([r[:last] for r in rows[2:]], new[:-1], met)
        if last:
            met = 0
        held = [r[last:] for r in rows]
        own = int((held[2] & 1).sum())
        if len(held[0]) - own > PAIRS >> 8:  # all its segments are here, and many partners
            yield from _met(held[2:], np.zeros(1, np.int64), met)
            held, met = [h[:own] for h in held], own
    yield from _met(held[2:], np.zeros(min(1, len(held[0])), np.int64), met)


def _met(rows: list[np.ndarray], starts: np.ndarray, met: int) -> Iterator[pa.RecordBatch]:
    """Pairs within units that begin at ``starts``; the first ``met`` rows of the first unit have met."""
    who, signs = rows
    if not len(starts):
        return
    sizes = np.diff(np.concatenate([starts, [len(who)]]))
    own = np.add.reduceat(who & 1, starts)
    busy = (own > 0) & (sizes > 1)
    starts, sizes, own = starts[busy], sizes[busy], own[busy]
    left = np.repeat(starts, own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)  # each segment's line
    until = np.repeat(starts + sizes, own)
    begin = np.maximum(left + 1, met) if met else left + 1
    many = np.maximum(until - begin, 0)
    bounds = np.cumsum(many)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(bounds, (bounds[lo - 1] if lo else 0) + PAIRS, side="right")))
        m = many[lo:hi]
        a = np.repeat(left[lo:hi], m)
        b = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(begin[lo:hi], m)
        near = np.bitwise_count((signs[a] ^ signs[b]).view(np.uint64)) <= 2 * MOST
        x, y = who[a[near]] & -2, who[b[near]] & -2
        other = x != y
        x, y = x[other], y[other]
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["left", "right"])
        lo = hi


def within(left: list[str], right: list[str], most: np.ndarray) -> np.ndarray:
    """Whether each pair is within its edit budget: bit-parallel over a band of 2 * MOST + 1 diagonals, pairs side by side."""
    out = np.zeros(len(left), dtype=bool)
    size = np.array([len(x) for x in right], dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + max(1, min(len(order) - lo, (1 << 21) // max(1, int(size[order[lo]]))))
        rows = order[lo:hi]
        out[rows] = _band([left[i] for i in rows.tolist()], [right[i] for i in rows.tolist()], most[rows])
        lo = hi
    return out


def _band(left: list[str], right: list[str], most: np.ndarray) -> np.ndarray:
    """Bit o of state d: the first j + o - MOST characters of left match the first j of right with d edits at most."""
    m, n = (np.array([len(x) for x in side], dtype=np.int64) for side in (left, right))
    width, full = 2 * MOST + 1, np.uint8((1 << (2 * MOST + 1)) - 1)
    longest = int(n.max(initial=0))
    pattern = np.zeros((len(left), max(longest, int(m.max(initial=0))) + width), dtype=np.uint32)
    text = np.full((len(left), longest), 0xFFFFFFFF, dtype=np.uint32)
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        pattern[i, MOST : MOST + len(a)] = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) + 1
        text[i, : len(b)] = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) + 1
    states = [np.full(len(left), sum(1 << (MOST + i) for i in range(d + 1)), dtype=np.uint8) for d in range(MOST + 1)]
    last = [s.copy() for s in states]
    for j in range(longest):
        going = n > j
        equal = np.zeros(len(left), dtype=np.uint8)
        for o in range(width):
            equal |= (pattern[:, j + o] == text[:, j]).astype(np.uint8) << np.uint8(o)
        new: list[np.ndarray] = []
        for d in range(MOST + 1):
            s = states[d] & equal
            if d:
                s = s | states[d - 1] | (states[d - 1] >> np.uint8(1)) | (new[d - 1] << np.uint8(1)) | new[d - 1]
            new.append(s & full)
        states = new
        last = [np.where(going, s, x) for s, x in zip(states, last, strict=True)]
    end = m - n + MOST
    inside = (end >= 0) & (end < width)
    bit = np.where(inside, end, 0).astype(np.uint8)
    reached = np.stack([(x >> bit) & 1 for x in last]).astype(bool)
    return inside & reached[np.clip(most, 0, MOST), np.arange(len(left))]


def links(rows: DataFrame, classes: DataFrame, unit: int = UNIT) -> DataFrame:
    """(left, right) hashes of all pairs of lines within their budget."""
    pairs = cut(candidates(classes, unit).distinct())
    ends = pairs.select(F.explode(F.array("left", "right")).alias("short")).distinct()
    texts = cut(texts_of(rows, cut(ends)))
    side = lambda name: texts.select(F.col("short").alias(name), F.col("line").alias(f"{name}_line"), F.col("words").alias(f"{name}_words"))
    both = pairs.join(side("left"), "left").join(side("right"), "right").select("left_line", "right_line", "left_words", "right_words")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "left_words"):
            a, b = batch.column("left_words").to_pylist(), batch.column("right_words").to_pylist()
            most = budget(np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64))
            ok = pa.array(within(a, b, most))
            yield pa.RecordBatch.from_arrays([batch.column("left_line").filter(ok), batch.column("right_line").filter(ok)], ["left", "right"])

    return cut(both.mapInArrow(each, "left binary, right binary")).distinct()


def _resolved(rows: DataFrame, unit: int) -> DataFrame:
    """Every line of ``rows`` (rid, doc_id, text): rid, doc_id, line_no, line, class, n_links, first (of the class)."""
    spark = rows.sparkSession
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no", "rid")
    with scope(spark):
        lines = cut(lines_of(rows))
        with scope(spark):
            classes = lines.groupBy("line").agg(F.first("short").alias("short"), F.first("signs").alias("signs"), F.first("own").alias("own"), F.first("probes").alias("probes"))
            found = cut(links(rows, classes, unit), lasting=True)
        degree = found.select(F.explode(F.array("left", "right")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n_links"))
        roots = cut(components(found).select(F.col("node").alias("line"), F.col("root").alias("class")).join(degree, "line"))
        known = cut(lines.select("rid", "doc_id", "line_no", "line").join(roots, "line", "left").select(
            "rid", "doc_id", "line_no", "line", F.coalesce("class", "line").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")), lasting=True)
        leads = cut(known.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("class_size")), lasting=True)
        return join_groups(known, leads, "class", "class_size")


KEPT = "rid = first.rid AND line_no = first.line_no"


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """One row for each line: doc_id, line_no, line_hash, class_hash, class_size, n_links, first_doc_id, first_line_no, kept."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _resolved(rows, unit).select(
        "doc_id", "line_no", F.lower(F.hex("line")).alias("line_hash"), F.lower(F.hex("class")).alias("class_hash"), "class_size", "n_links",
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"), F.expr(KEPT).alias("kept"))


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """The documents with all their columns and only the lines that stay (and blank ones) in their texts."""
    whole = numbered(docs)
    rows = whole.select("rid", F.col(f"row.`{id_col}`").alias("doc_id"), F.col(f"row.`{text_col}`").cast("string").alias("text"))
    gone = _resolved(rows, unit).where(f"NOT ({KEPT})").groupBy("rid").agg(F.collect_list("line_no").alias("gone"))
    lines = F.split(F.col(f"row.`{text_col}`"), "\n", -1)
    left = F.filter(lines, lambda x, i: (F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) == "") | ~F.array_contains(F.col("gone"), i))
    text = F.when(F.col("gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join(left, "\n"))
    return whole.join(gone, "rid", "left").select(F.col("row").withField(text_col, text).alias("row")).select("row.*")
