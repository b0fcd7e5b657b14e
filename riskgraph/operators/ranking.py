"""Ranks and running sums that never put an unbounded group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.feature import Bucketizer

from riskgraph.operators.joins import lookup_join
from riskgraph.operators.lineage import cut


HOT_KEYS, HOT_ROWS = 1_000, 10_000


def largest_key(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the most frequent key; the counts are pre-aggregated, only keys are moved."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0


def first_of_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """Flag exactly one row per key: the first in ``order`` (NULLs first); the rows of NULL keys form one key.

    Keys are counted first, pre-aggregated; where none repeats, that is all. Else the rows are moved once and ranked
    within their key. The most frequent keys, up to ``HOT_KEYS`` of ``HOT_ROWS`` rows or more, are not gathered: their least
    row is a mergeable minimum over counted copies and is broadcast, their rows are spread by a salt and compare with it.
    Rows alike in all columns are interchangeable: if such a least row has copies, they come from the aggregate, one of
    them flagged.
    """
    columns, every = df.columns, [*keys, *[c for c in df.columns if c not in keys]]
    ranked = [c for c in (*order, *every) if c not in keys]
    ranked = list(dict.fromkeys(ranked))
    most = largest_key(df, keys)
    if most <= 1:
        return df.withColumn(flag, F.lit(True))
    by = [F.col(c).asc_nulls_first() for c in ranked] or [F.lit(0)]
    if most < HOT_ROWS:
        return df.withColumn(flag, F.row_number().over(Window.partitionBy(*keys).orderBy(*by)) == 1)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= HOT_ROWS)
    hot = cut(counted.orderBy(F.desc("_n")).limit(HOT_KEYS).select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    copies = df.join(F.broadcast(hot), same, "left_semi").groupBy(*every).agg(F.count(F.lit(1)).alias("_copies"))
    lows = cut(copies.groupBy(*keys).agg(F.min(F.struct(*ranked, "_copies")).alias("_least")))
    sided = lows.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_least")
    rows = df.join(F.broadcast(sided), same, "left").select(*columns, "_least")
    is_hot = F.col("_least").isNotNull()
    salt = F.when(is_hot, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(F.lit(0))
    place = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*by))
    rows = rows.withColumn("_salt", salt).withColumn("_place", place)
    least = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_least").getField(c)) for c in ranked], is_hot)
    alone = F.coalesce(F.col("_least._copies") == 1, F.lit(True))
    first = F.when(is_hot, least & alone).otherwise(F.col("_place") == 1)
    once = rows.where(alone | ~least).select(*columns, first.alias(flag))
    several = lows.where("_least._copies > 1").select(*keys, "_least.*").select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    return once.unionByName(several.select(*columns, (F.col("_copy") == 1).alias(flag)))


def ordinal_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, largest: int | None = None) -> DataFrame:
    """Number the rows of each key 1..n without gathering a large key in one task.

    Keys are counted first (``largest`` is the largest count, where it is known): unique rows are number 1, keys below
    ``HOT_ROWS`` are numbered by one window. Where a key is larger, rows are numbered within (key, input partition); the
    first row of each such part carries its row count into a running sum over the key's parts (one row per part), and
    the parts then read their shift back. Exact copies are interchangeable, so keys that only repeat as copies are
    numbered independently of the layout.
    """
    largest = largest_key(df, keys) if largest is None else largest
    by = [F.col(c).asc_nulls_first() for c in order] or [F.lit(0)]
    if largest <= 1:
        return df.withColumn(name, F.lit(1).cast("long"))
    if largest < HOT_ROWS:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*by)).cast("long"))
    part = Window.partitionBy(*keys, "_part")
    numbered = df.withColumn("_part", F.spark_partition_id()).select(
        "*", F.row_number().over(part.orderBy(*by)).alias("_rn"), F.count(F.lit(1)).over(part).alias("_n")
    )
    led = numbered.withColumn("_heat", F.when(F.col("_rn") == 1, F.lit(-1)).otherwise(F.col("_part")))
    before = Window.partitionBy(*keys, "_heat").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = led.withColumn("_shift", F.when(F.col("_rn") == 1, F.coalesce(F.sum("_n").over(before), F.lit(0))))
    ordinal = (F.col("_rn") + F.max("_shift").over(part)).cast("long")
    return shifted.withColumn(name, ordinal).drop("_part", "_rn", "_n", "_heat", "_shift")


def hash_rank(
    df: DataFrame, strata: Sequence[str], identity: Column, seed: int, rank: str = "_rank", size: str = "_size",
    hex_digits: int = 4,
) -> DataFrame:
    """Rank the rows of each stratum by ``md5(identity|seed)`` and attach the stratum's size. Exact.

    The leading hex digits of the hash split a stratum into 16**hex_digits even buckets. Bucket counts are
    pre-aggregated, their running sum gives each bucket's offset, and the window only ranks inside a bucket,
    so a stratum with a third of all rows is ranked by thousands of tasks. ``identity`` must be unique per row.
    """
    key = F.to_json(F.struct(*strata)) if strata else F.lit("")
    md5 = F.md5(F.concat(identity.cast("string"), F.lit(f"|{seed}")))
    hashed = df.select("*", key.alias("_stratum"), md5.alias("_md5"))
    hashed = hashed.withColumn("_bucket", F.substring("_md5", 1, hex_digits))
    group = ["_stratum", "_bucket"]
    counts = hashed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    stratum = Window.partitionBy("_stratum")
    before = stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), F.sum("_n").over(stratum).alias(size)
    )
    local = hashed.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy("_md5")))
    joined = lookup_join(local, offsets, group)
    return joined.select(*df.columns, (F.col("_rn") + F.col("_offset")).alias(rank), F.col(size))


def hash_first(
    df: DataFrame, strata: Sequence[str], identity: Column, seed: int, quota: Column, flag: str, hex_digits: int = 4,
) -> DataFrame:
    """Flag the first ``quota`` rows of each stratum in the order of ``hash_rank``; ``quota`` may use ``_size``. Exact.

    Buckets below a stratum's quota are in and buckets above it are out by their counts alone. Only the rows of the one
    bucket that holds the quota are ranked; all other rows stay where they are.
    """
    key = F.to_json(F.struct(*strata)) if strata else F.lit("")
    hashed = df.select("*", key.alias("_stratum"), F.md5(F.concat(identity.cast("string"), F.lit(f"|{seed}"))).alias("_md5"))
    hashed = hashed.withColumn("_bucket", F.substring("_md5", 1, hex_digits))
    counts = hashed.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    stratum = Window.partitionBy("_stratum")
    placed = counts.select("*", F.sum("_n").over(stratum.orderBy("_bucket")).alias("_upto"), F.sum("_n").over(stratum).alias("_size"))
    marked = placed.withColumn("_quota", quota).where(F.col("_upto") > F.col("_quota"))
    first = F.min(F.struct("_bucket", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left")))
    cuts = cut(marked.groupBy("_stratum").agg(first.alias("_cut")))  # strata without one are in as a whole
    rows = hashed.join(cuts, "_stratum", "left")
    border = F.col("_bucket") == F.col("_cut._bucket")
    sure = rows.where(~F.coalesce(border, F.lit(False))).withColumn(flag, F.coalesce(F.col("_bucket") < F.col("_cut._bucket"), F.lit(True)))
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_md5"))
    open_ = rows.where(border).withColumn(flag, rank <= F.col("_cut._left"))
    return sure.unionByName(open_).select(*df.columns, flag)


def running_sums(
    df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), buckets: int = 256
) -> DataFrame:
    """Inclusive running sums ``cum_<name>`` of each column in ascending ``order``, within ``by``.

    ``df`` holds one row per (by, order). Approximate quantiles cut the order into ranges; each range is summed
    in its own task and shifted by the totals of the earlier ranges. The cut points only balance the work.
    """
    quantiles = df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets))
    cuts = [float("-inf"), *(sorted(set(quantiles)) or [0.0]), float("inf")]
    ranged = Bucketizer(splits=cuts, inputCol=order, outputCol="_range", handleInvalid="keep").transform(df)
    group = [*by, "_range"]
    window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(window).alias(f"_local_{c}") for c in sums])
    totals = ranged.groupBy(*group).agg(*[F.sum(c).alias(f"_total_{c}") for c in sums])
    outer = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = outer.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        *group, *[F.coalesce(F.sum(f"_total_{c}").over(before), F.lit(0)).alias(f"_shift_{c}") for c in sums]
    )
    joined = lookup_join(local, shifts, group)
    return joined.select(
        *df.columns, *[(F.col(f"_local_{c}") + F.col(f"_shift_{c}")).alias(f"cum_{c}") for c in sums]
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of each numeric column, NULL ignored: rows ``(feature, median)``.

    Values are first reduced to distinct (feature, value) counts; running counts then locate the middle.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]))
    values = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = cut(values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    placed = lookup_join(running_sums(counts, "value", ["n"], by=["feature"]), totals, "feature")
    first, last = F.col("cum_n") - F.col("n") + 1, F.col("cum_n")
    lower, upper = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    return placed.groupBy("feature").agg(
        ((F.max(F.when(lower.between(first, last), F.col("value")))
          + F.max(F.when(upper.between(first, last), F.col("value")))) / 2).alias("median")
    )
