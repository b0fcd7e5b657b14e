"""Similarity join of texts by the Jaccard similarity of their sets of word n-grams, with token-combination prefixes.

A set holds the 64-bit hashes of a text's distinct runs of ``words`` words, A-Z lower-cased; a text of fewer words is
one run, a text without words the empty set, which links with nothing. Equal sets are one class, told by a 128-bit
digest; the rest of the work sees one row of each class.

*Order.* Two count sketches of ``SLOTS`` counters, filled from all texts, estimate by how much a token exceeds the
mean load of its counters. That excess orders the tokens, rare ones first, and gives each a class: ``k`` = 1 for rare
tokens, 2 and 3 for frequent ones. The sketches are the only thing sent to all tasks, 1 MB whatever the input.

*Keys.* Of a set of n tokens, at most ``e = n - ceil(percent * n / 100)`` are missing from a set similar to it. Rare
tokens are keys by themselves; frequent ones are dealt into B buckets by hash, and every combination of k tokens of
one bucket is a key. The prefix is extended along the order until ``e + 1`` of its tokens count, where the first
``k - 1`` of a bucket do not. Were fewer than k tokens shared in every bucket and no rare one, more than e tokens would
be missing; and what one of two similar sets shares in its prefix also stands in the other's, if that reaches further.
So two similar sets have a key in common. B grows with the set (an eighth of it, rounded down to a power of two), which
keeps combinations in proportion to the set. A pair uses the larger set's B, so a set within reach of the next power
gives keys for both.

*Verification.* Keys are counted first, and only those of several sets go on. Two members of a key are a pair, which is
all there is to compare; the members of a larger one are compared with up to three of them (the smallest number, one by hash, and the one with the commonest keys), and what is similar becomes one
component; then members of different components under one key are compared, the key's largest component with the
others and the others among themselves. A set's odd sketch, the parities of its tokens in ``PARITIES`` bits, rules
candidates out where they stand: two sets differ in at least as many tokens as their sketches in bits. Across components
it moves with every key, folded to half its bits, and the whole one is asked for what that leaves. The rest is
verified by the exact similarity of the two texts' sets. A large group of near copies is thus joined by its leaders,
nothing is written for a pair that the sketch rules out (long sets have a longer one too, read before texts are moved),
and no link between different sets is lost. Tables of each
step are removed when the join ends.

NULL is an empty text. Repeated rows and ids are rows of their own that share a class. A component's id is its smallest
document id (any comparable type); NULL ids are carried, and chosen only if there is no other. An empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import join_groups, runs, text_of
from riskgraph.llm.simhash import components
from riskgraph.operators.lineage import cut, scope

WORDS, PERCENT, SEED = 4, 85, 42
SLOTS, SKETCHES, CLASSES, PARITIES = 1 << 17, 2, 3, 1024
LEAST_EXCESS, STEP = 16, 16  # a token of class 2 exceeds its counters' mean by so much, one of class 3 by STEP times as much
MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(text: str | None, words: int, blank: bool = False) -> np.ndarray:
    """The sorted distinct hashes of a text's word runs; of a text without words none or, if ``blank``, that of nothing."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w and not blank:
        return np.zeros(0, dtype=np.uint64)
    parts = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED))), dtype=">u8").astype(np.uint64))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


# ---- order and classes ---------------------------------------------------------------------------------------
def _slots(tokens: np.ndarray) -> list[np.ndarray]:
    return [(tokens >> np.uint64(47 - 17 * i) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(SKETCHES)]


def sketch(rows: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The excess of each counter over the mean, from all rows; from which excess on a token is of class 2 and 3."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCHES * SLOTS, dtype=np.int64)
        for batch in runs(batches):
            tokens = np.concatenate([np.zeros(0, np.uint64), *(shingles(t, words) for t in batch.column("text").to_pylist())])
            for i, slot in enumerate(_slots(tokens)):
                counts[i * SLOTS : (i + 1) * SLOTS] += np.bincount(slot, minlength=SLOTS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["slot", "n"])

    table = rows.select("text").mapInArrow(each, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SKETCHES * SLOTS, dtype=np.int64)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    mean = counts.sum() / len(counts)
    beyond_chance = max(LEAST_EXCESS, 4 * np.sqrt(mean))
    return np.clip(counts - int(mean), -(2**31), 2**31 - 1).astype(np.int32), np.array([beyond_chance * STEP**i for i in range(CLASSES - 1)])


# ---- keys ----------------------------------------------------------------------------------------------------
def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * MIX[0]
        x = (x ^ (x >> np.uint64(29))) * MIX[1]
        return x ^ (x >> np.uint64(32))


def buckets(n: int) -> int:
    return 1 << max(0, (n // 8).bit_length() - 1)


def bucket_counts(n: int, percent: int) -> set[int]:
    """The bucket counts under which a set of ``n`` tokens can meet a similar one of its size or larger."""
    most = 100 * n // percent
    return {buckets(n), buckets(most)}  # sizes within a quarter of each other: there is no third one between


def _combined(tokens: np.ndarray, bucket: np.ndarray, k: int) -> list[np.ndarray]:
    """Keys of all k-combinations of tokens within a bucket."""
    order = np.lexsort((tokens, bucket))
    tokens, bucket = tokens[order], bucket[order]
    size = np.bincount(np.unique(bucket, return_inverse=True)[1]) if len(bucket) else np.zeros(0, int)
    out, end = [], 0
    for many in size.tolist():
        own, end = tokens[end : end + many], end + many
        if many < k:
            continue
        with np.errstate(over="ignore"):
            i, j = np.triu_indices(many, 1)
            if k == 2:
                out.append(_mixed(own[i] * MIX[2] + _mixed(own[j])))
            else:
                for first in range(many - 2):  # one token and every pair beyond it
                    later = i > first
                    out.append(_mixed(own[first] * MIX[1] + _mixed(own[i[later]] * MIX[2] + _mixed(own[j[later]]))))
    return out


def keys(own: np.ndarray, excess: np.ndarray, limits: np.ndarray, percent: int) -> np.ndarray:
    """The keys of one set. ``own``: its sorted tokens. None if every other set lacks too much by one token already."""
    n = len(own)
    if 100 * n < percent * (n + 1):
        return np.zeros(0, dtype=np.uint64)
    need = n - -(-percent * n // 100) + 1
    over = np.minimum(*(excess[i * SLOTS + slot] for i, slot in enumerate(_slots(own))))
    order = np.argsort(over, kind="stable")
    tokens, level = own[order], np.searchsorted(limits, over[order], side="right")
    if level[need - 1] == 0:
        return tokens[:need]
    found = []
    for many in bucket_counts(n, percent):
        bucket = (_mixed(tokens) % np.uint64(many)).astype(np.int64) + level * many
        place = np.argsort(bucket, kind="stable")  # within a bucket, along the order
        start = np.flatnonzero(np.concatenate([[True], np.diff(bucket[place]) != 0]))
        nth = np.empty(n, dtype=np.int64)
        nth[place] = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
        length = int(np.searchsorted(np.cumsum(nth >= level), need)) + 1
        for k in range(CLASSES):
            here = level[:length] == k
            found.extend(_combined(tokens[:length][here], bucket[:length][here], k + 1) if k else [tokens[:length][here]])
    return np.unique(np.concatenate(found))


# ---- the join ------------------------------------------------------------------------------------------------
def parities(own: np.ndarray) -> np.ndarray:
    """The odd sketch of a set: a bit for each residue of its tokens, 1 for an odd number of them."""
    odd = np.bincount((own & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def long_sketch(own: np.ndarray) -> bytes | None:
    """The odd sketch of a large set in at least two bits a token; None where the short one has that."""
    bits = 1 << max(0, 2 * len(own) - 1).bit_length()
    if bits <= PARITIES:
        return None
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """In how many tokens two sets differ at least; the longer sketch is folded to the length of the other."""
    x, y = (np.frombuffer(v, dtype=np.uint8) for v in (a, b))
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _fit(percent: int, bits: int = PARITIES) -> str:
    """Whether sizes n, m and sketches s, t of so many bits leave the similarity possible."""
    differ = " + ".join(f"bit_count(s[{i}] ^ t[{i}])" for i in range(bits // 64))
    return f"100 * least(n, m) >= {percent} * greatest(n, m) AND {100 + percent} * ({differ}) <= {100 - percent} * (n + m)"


def _folded(sketch: str = "sketch") -> Column:
    """The odd sketch of half the bits."""
    half = PARITIES // 128
    return F.array(*[F.get(sketch, F.lit(i)).bitwiseXOR(F.get(sketch, F.lit(i + half))) for i in range(half)])


def signed(rows: DataFrame, words: int, percent: int, blank: bool) -> DataFrame:
    """rid, n (tokens of the row), digest (of its set), sketch, wide (sketch of a large set), keys."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch(rows, words))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            sizes, digests, odd, wide, found = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text, words, blank)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                odd.append(parities(own))
                wide.append(long_sketch(own))
                found.append(keys(own, *shared.value, percent))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            odd_ends = np.arange(0, (len(odd) + 1) * PARITIES // 64, PARITIES // 64, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("rid"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(odd_ends, pa.array(np.concatenate([np.zeros(0, np.int64), *odd]))),
                pa.array(wide, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(flat)),
            ], ["rid", "n", "digest", "sketch", "wide", "keys"])

    return rows.select("rid", "text").mapInArrow(each, "rid long, n int, digest binary, sketch array<long>, wide binary, keys array<long>")


def _promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` that the sketches of large sets do not rule out either."""
    large = sets.where("wide is not null")
    one, two = (large.select(F.col("rid").alias(a), F.col("n").alias(n), F.col("wide").alias(w)) for a, n, w in (("left", "n", "s"), ("right", "m", "t")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [s is None or t is None or (100 + percent) * least_difference(s, t) <= (100 - percent) * (n + m)
                    for n, m, s, t in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "s", "t")), strict=True)]
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("left").filter(ok), batch.column("right").filter(ok)], ["left", "right"])

    both = pairs.join(one, "left", "left").join(two, "right", "left").select("left", "right", "n", "m", "s", "t")
    return both.mapInArrow(each, "left long, right long")


def _verified(rows: DataFrame, pairs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (left, right) of rows whose sets are similar; only texts of candidates are moved."""
    pairs = cut(_promising(pairs, sets, percent))
    ends = cut(pairs.select(F.explode(F.array("left", "right")).alias("rid")).distinct())
    texts = cut(rows.select("rid", "text").join(ends, "rid", "left_semi"))
    both = pairs.join(texts.select(F.col("rid").alias("right"), F.col("text").alias("b")), "right").join(
        texts.select(F.col("rid").alias("left"), F.col("text").alias("a")), "left").select("left", "right", "a", "b")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(64)(shingles)
        for batch in runs(batches, "a"):
            ok = pa.array([similar(known(a, words), known(b, words), percent)
                           for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("left").filter(ok), batch.column("right").filter(ok)], ["left", "right"])

    return cut(both.mapInArrow(each, "left long, right long"))


def _links(rows: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """``sets``: rid, n, sketch, keys; one row of each class. Similar pairs (left, right) whose components are those of all similar pairs."""
    keyed = sets.select("rid", "n", F.explode("keys").alias("key"))
    several = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1"))
    member = cut(keyed.join(several, "key"))
    of_size = f"100 * least(n, m) >= {percent} * greatest(n, m)"  # before pairs are moved with their sketches
    ends = [F.min("rid").alias("left"), F.max("rid").alias("right"), F.min("n").alias("n"), F.max("n").alias("m")]
    twos = member.where("many = 2").groupBy("key").agg(*ends).where(of_size).select("left", "right")  # most keys: two members are one pair
    member = member.where("many > 2")
    # three of each other key to compare with: the first, one by hash, and the one whose keys are the commonest, as an original's are among its copies
    scored = member.join(cut(member.groupBy("rid").agg(F.sum("many").alias("score"))), "rid")
    least = lambda rank: F.struct(*[F.min(F.struct(rank.alias("rank"), "rid", "n")).getField(c).alias(c) for c in ("rid", "n")])
    chosen = F.array(least(F.lit(0).cast("long")), least(F.xxhash64("rid")), least(-F.col("score")))
    led = scored.groupBy("key").agg(F.array_distinct(chosen).alias("leads")).select("key", F.explode("leads").alias("lead"))
    leads = cut(led.select("key", F.col("lead.rid").alias("other"), F.col("lead.n").alias("m")))
    ordered = [F.least("rid", "other").alias("left"), F.greatest("rid", "other").alias("right")]
    stars = member.join(leads, "key").where("rid <> other").where(of_size).select(*ordered)
    stars = cut(twos.unionByName(stars).distinct())
    compared = stars.select(F.explode(F.array("left", "right")).alias("rid")).unionByName(member.select("rid")).distinct()
    known = cut(sets.select("rid", "n", "sketch", "wide").join(compared, "rid", "left_semi"))
    short = known.select("rid", "n", "sketch")
    one, two = short.toDF("left", "n", "s"), short.toDF("right", "m", "t")
    near = _verified(rows, cut(stars.join(one, "left").join(two, "right").where(_fit(percent)).select("left", "right")), known, words, percent)

    of = cut(components(near).select(F.col("node").alias("rid"), "root"))
    member = cut(member.select("key", "rid").join(of, "rid", "left").select("key", "rid", F.coalesce("root", "rid").alias("part")))
    parts = member.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("part", F.struct("size", "part")).alias("main"))
    mixed = cut(mixed.where("parts > 1").select("key", "main"))
    mixed = cut(member.join(mixed, "key").select("key", "rid", "part", (F.col("part") == F.col("main")).alias("is_main")).join(
        known.select("rid", "n", _folded().alias("sketch")), "rid"))
    a = mixed.select("key", "rid", "part", "is_main", "n", F.col("sketch").alias("s"))
    b = mixed.where("not is_main").select("key", F.col("rid").alias("other"), F.col("part").alias("other_part"), F.col("n").alias("m"), F.col("sketch").alias("t"))
    across = a.join(b, "key").where("part <> other_part AND (is_main OR part < other_part)").where(_fit(percent, PARITIES // 2))
    rest = cut(across.select(*ordered).distinct().join(stars, ["left", "right"], "left_anti"))
    rest = cut(rest.join(one, "left").join(two, "right").where(_fit(percent)).select("left", "right"))
    return near.unionByName(_verified(rows, rest, known, words, percent))


def classes(rows: DataFrame, words: int = WORDS, percent: int = PERCENT, blank: bool = False) -> DataFrame:
    """``rows``: rid, text, written once. Gives rid, n, and ``root``, the same number for all rows of a component."""
    if not 80 <= percent <= 100:
        raise ValueError("the prefixes hold enough tokens from a similarity of 80 percent on")
    spark = rows.sparkSession
    with scope(spark):
        sets = cut(signed(rows, words, percent, blank))
        copies = cut(sets.where("n > 0").groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min("rid").alias("lead")).where("size > 1"))
        copied = cut(join_groups(sets.select("rid", "digest"), copies, "digest", "size").select("rid", "lead").where("rid <> lead"))
        links = _links(rows, sets.join(copied, "rid", "left_anti").select("rid", "n", "sketch", "wide", "keys"), words, percent)
        roots = cut(components(links).select(F.col("node").alias("lead"), "root"))
        led = sets.select("rid", "n").join(copied, "rid", "left").select("rid", "n", F.coalesce("lead", "rid").alias("lead"))
        return cut(led.join(roots, "lead", "left").select("rid", "n", F.coalesce("root", "lead").alias("root")), lasting=True)


def first_of(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (rid, n, root) with the rows' doc_id, and ``first``: the (no id, id, rid) of the component's first row."""
    order: Column = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    labelled = cut(found.join(rows.select("rid", "doc_id"), "rid"), lasting=True)
    firsts = cut(labelled.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size")), lasting=True)
    return join_groups(labelled, firsts, "root", "size")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) of every row."""
    with scope(docs.sparkSession):
        rows = cut(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")))
        found = first_of(rows, classes(rows, words, percent))
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))
