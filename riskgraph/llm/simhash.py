"""Near duplicates by SimHash, found by a self-join of binary tries.

A fingerprint links to another at ``MAX_BITS`` or fewer differing bits. Distinct fingerprints stand in two binary
tries, one of the bits as they are and one with its 32-bit halves exchanged: of any two linked fingerprints one half
differs in at most ``MAX_BITS // 2`` bits, so each trie may prune at that budget in its first 32 levels and at
``MAX_BITS`` below, and the two tries together still lose no link.

Node pairs are traversed together from the root. The upper levels are Spark's: a row goes to every node pair at a
depth set by the row count that its prefix can be in within the budget. Pairs of nodes that hold more than ``UNIT``
rows are taken ``STEP`` levels deeper, again and again, so no task gets an unbounded node. The lower levels are
walked inside the tasks, level by level over arrays, adding each level's differing bit and dropping pairs over
budget. A task returns a spanning forest of its links, not all pairs of a dense group. Classes are then the
components of these links, by alternating large and small stars over tables in the shared folder.

NULL and blank texts have fingerprint zero and link like any other. Copies, repeated rows and repeated ids meet in
their fingerprint. A component's id is its smallest document id, of any type; NULL ids are carried but never chosen, unless there
is no other. An empty table gives an empty result; other columns are carried by ``keep_one`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import join_groups, numbered, runs, text_of, without
from riskgraph.operators.lineage import cut

WORDS, MAX_BITS, SEED = 3, 3, 42
UNIT, STEP, HALF = 1 << 14, 6, 32
FRONTIER = 1 << 20


# ---- fingerprints ------------------------------------------------------------------------------------------
def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the XXH64 values of all word shingles, A-Z lower-cased; an int of 64 bits, unsigned."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
    n = len(digests) // 8
    ones = np.zeros(64, dtype=np.int64)
    raw = np.frombuffer(digests, dtype=np.uint8).reshape(n, 8)
    for lo in range(0, n, 8192):
        ones += np.unpackbits(raw[lo : lo + 8192], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """``rows``: rid, doc_id, text. Gives rid, doc_id and ``fp``, the fingerprint's bits as a long."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            bits = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(bits)], ["rid", "doc_id", "fp"])

    return rows.mapInArrow(each, f"rid long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# ---- the trie self-join ------------------------------------------------------------------------------------
def _budget(depth: int, max_bits: int) -> int:
    """Bits in which two prefixes of this depth may differ."""
    return max_bits // 2 if depth <= HALF else max_bits


def _masks(bits: int, most: int) -> list[int]:
    """Every difference of ``most`` or fewer bits; above ``STEP`` bits callers ask for one bit at most."""
    if bits <= STEP:
        return [m for m in range(1 << bits) if m.bit_count() <= most]
    return [0, *(1 << i for i in range(bits) if most)]


def _members(tries: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """Every row under each node pair of this depth it can be in: trie, left, right (prefixes, left <= right), used, fp."""
    if max_bits // 2 > 1:
        depth = min(depth, STEP)
    prefix = F.shiftrightunsigned("bits", 64 - depth) if depth else F.lit(0).cast("long")
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(depth, _budget(depth, max_bits))])
    other = tries.select("*", prefix.alias("p"), F.explode(masks).alias("mask")).withColumn("q", F.col("p").bitwiseXOR(F.col("mask")))
    return other.select("trie", F.lit(depth).alias("depth"), F.least("p", "q").alias("left"), F.greatest("p", "q").alias("right"), "bits")


def _deeper(members: DataFrame, step: int, max_bits: int) -> DataFrame:
    """The same rows under the node pairs ``step`` levels down that stay within the budget."""
    depth = F.col("depth") + step
    prefix = F.expr(f"shiftrightunsigned(bits, 64 - depth - {step})")
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(step, max_bits)])
    here = F.shiftrightunsigned("p", step)  # the row's own node; its partner below lies under the other one
    up = members.select("*", prefix.alias("p"), F.explode(masks).alias("mask"))
    partner = F.when(here == F.col("left"), F.col("right")).otherwise(F.col("left"))
    q = F.shiftleft(partner, step).bitwiseOR(F.col("p").bitwiseXOR(F.col("mask")).bitwiseAND(F.lit((1 << step) - 1)))
    used = F.bit_count(F.col("p").bitwiseXOR(F.col("q")))
    allowed = F.when(depth <= HALF, F.lit(max_bits // 2)).otherwise(F.lit(max_bits))
    return up.withColumn("q", q).where(used <= allowed).select(
        "trie", depth.alias("depth"), F.least("p", "q").alias("left"), F.greatest("p", "q").alias("right"), "bits")


def units(tries: DataFrame, total: int, max_bits: int, unit: int) -> DataFrame:
    """Members of the node pairs that tasks walk; none holds more than ``unit`` rows, unless a single fingerprint does."""
    depth = min(HALF, max(0, (2 * total // unit).bit_length()))
    members, done = cut(_members(tries, depth, max_bits)), None
    while True:
        key = ["trie", "depth", "left", "right"]
        large = cut(members.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > unit) & (F.col("depth") + STEP < 64)).drop("n"))
        small = members.join(large, key, "left_anti")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            return done
        members = cut(_deeper(members.join(large, key, "left_semi"), STEP, max_bits))


def walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between two sorted arrays of fingerprints under one node pair: places in ``a`` and in ``b``.

    A frontier holds node pairs as ranges of both arrays. Large frontiers are cut and walked one part after the
    other, which bounds memory.
    """
    top = [(depth, *(np.array([x]) for x in (0, len(a), 0, len(b))))]
    while top:
        level, alo, ahi, blo, bhi = top.pop()
        if level == 64:  # ranges are single fingerprints: arrays hold no value twice
            keep = alo < blo if same else np.ones(len(alo), bool)
            yield alo[keep], blo[keep]
            continue
        bit = np.uint64(1) << np.uint64(63 - level)
        amid, bmid = _split(a, alo, ahi, bit), _split(b, blo, bhi, bit)
        parts = [(alo, amid, blo, bmid), (amid, ahi, bmid, bhi), (alo, amid, bmid, bhi), (amid, ahi, blo, bmid)]
        if same:  # of a node with itself, the two mixed pairs are one
            twin = (alo == blo) & (ahi == bhi)
            parts[3] = tuple(x[~twin] for x in parts[3])
        alo, ahi, blo, bhi = (np.concatenate(x) for x in zip(*parts, strict=True))
        live = (alo < ahi) & (blo < bhi)
        alo, ahi, blo, bhi = alo[live], ahi[live], blo[live], bhi[live]
        shift = np.uint64(63 - level)
        differ = np.bitwise_count((a[alo] >> shift) ^ (b[blo] >> shift))
        live = differ <= _budget(level + 1, max_bits)
        if same:
            live &= ~((ahi - alo == 1) & (alo == blo) & (bhi - blo == 1))
        alo, ahi, blo, bhi = alo[live], ahi[live], blo[live], bhi[live]
        single = (ahi - alo == 1) & (bhi - blo == 1)  # both subtrees are one leaf: the rest of the path at once
        if single.any():
            left, right = alo[single], blo[single]
            near = np.bitwise_count(a[left] ^ b[right]) <= max_bits
            if level + 1 < HALF:
                near &= np.bitwise_count((a[left] ^ b[right]) >> np.uint64(HALF)) <= max_bits // 2
            left, right = left[near], right[near]
            keep = left < right if same else slice(None)
            yield left[keep], right[keep]
            alo, ahi, blo, bhi = (x[~single] for x in (alo, ahi, blo, bhi))
        for lo in range(0, len(alo), FRONTIER):
            hi = lo + FRONTIER
            top.append((level + 1, alo[lo:hi], ahi[lo:hi], blo[lo:hi], bhi[lo:hi]))


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where, in each range of sorted values alike above ``bit``, that bit turns to one."""
    first = values[lo]
    return np.clip(np.searchsorted(values, (first & ~(bit - np.uint64(1))) | bit), lo, hi)


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) of every fingerprint that has a link, by union-find over the links as they come."""
    parent = np.arange(n)
    for left, right in links:
        while len(left):
            for _ in range(64):
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            a, b = parent[left], parent[right]
            open_ = a != b
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    for _ in range(64):
        up = parent[parent]
        if (up == parent).all():
            break
        parent = up
    member = np.flatnonzero(parent != np.arange(n))
    return member, parent[member]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, unit: int = UNIT) -> DataFrame:
    """``distinct``: fp. Pairs (left, right) of fingerprints whose components are those of all links."""
    flipped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    both = F.explode(F.array(F.struct(F.lit(0).alias("trie"), F.col("fp").alias("bits")), F.struct(F.lit(1).alias("trie"), flipped.alias("bits"))))
    tries = distinct.select(both.alias("t")).select("t.*")

    def pair(group):
        import pandas as pd
        depth, left, right = int(group["depth"].iat[0]), int(group["left"].iat[0]), int(group["right"].iat[0])
        bits = np.unique(group["bits"].to_numpy().view(np.uint64))
        if left == right or not depth:
            a = b = bits
            base = 0
        else:
            base = int(np.searchsorted(bits >> np.uint64(64 - depth), np.uint64(right)))
            a, b = bits[:base], bits[base:]
        found = ((x, y + base) for x, y in walk(a, b, a is b, depth, max_bits)) if len(a) and len(b) else iter(())
        member, root = _forest(len(bits), found)
        flip = int(group["trie"].iat[0]) == 1
        back = lambda v: ((v << np.uint64(32)) | (v >> np.uint64(32)) if flip else v).view(np.int64)
        return pd.DataFrame({"left": back(bits[member]), "right": back(bits[root])})

    ready = units(tries, distinct.count(), max_bits, unit)
    return ready.groupBy("trie", "depth", "left", "right").applyInPandas(pair, "left long, right long")


# ---- components --------------------------------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (left, right): root is the smallest node of its component.

    Alternating large and small stars: pre-aggregated minima joined back to the edges, so a node with any number of
    neighbours is a skewed join key, which Spark splits, and never a group in one task.
    """
    edges = cut(edges.where("left <> right").select(F.greatest("left", "right").alias("a"), F.least("left", "right").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = cut(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())  # every larger neighbour, to the least
        lows = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lows, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        stars = cut(small.where("a <> b").distinct())
        again = stars.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() and stars.join(
            stars.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
        if again:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        edges = stars


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def labelled(prints: DataFrame, max_bits: int = MAX_BITS, unit: int = UNIT) -> DataFrame:
    """``prints``: rid, doc_id, fp. Adds ``first``, the (no id, id, rid) of the component's first row."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    firsts = cut(prints.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size")), lasting=True)
    roots = cut(components(links(firsts.select("fp"), max_bits, unit)).withColumnRenamed("node", "fp"))
    of_root = roots.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("lead"))
    led = firsts.join(roots.join(of_root, "root").select("fp", "lead"), "fp", "left").select("fp", F.coalesce("lead", "first").alias("first"), "size")
    return join_groups(prints, cut(led, lasting=True), "fp", "size")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, unit: int = UNIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    prints = cut(fingerprints(_rows(docs, id_col, text_col), words))
    return labelled(prints, max_bits, unit).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, unit: int = UNIT) -> DataFrame:
    """The documents, one of each component (smallest id, then the row read first), with all their columns."""
    whole = numbered(docs)
    rows = whole.select("rid", F.col(f"row.`{id_col}`").alias("doc_id"), text_of(F.col(f"row.`{text_col}`")).alias("text"))
    return without(whole, labelled(cut(fingerprints(rows, words)), max_bits, unit).where(F.col("rid") != F.col("first.rid")))
