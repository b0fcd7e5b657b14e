"""Centroid clustering (k-means) in exact integers, by expressions of the JVM alone.

Kept are vectors with exactly ``dims`` components, none NULL, NaN or infinite. A component x becomes the integer
floor(``scale`` * x), clamped to +-``LARGEST`` so that every squared distance fits a long. The first centroids are the vectors
of the ``k`` smallest SHA-256 values of ``<seed>:<vec_id>`` (a NULL id: nothing after the colon; ties: the smaller vector),
in that order, or all of them if there are fewer.

A step sends the centroids as literals, k x dims integers. ``zip_with`` and ``aggregate`` give the squared distance to
each of them, ``array_min`` of structs (distance, number) the nearest one, the smaller number of equals, and one hash
aggregate with a column sum for each component the new centroids: floor(sum / count), in exact integers; an empty one
stays. Only those k rows reach the driver. Vectors are integers in a table written once; a step neither sorts nor
shuffles them, and equal vectors or a hot cluster are summed where they are.

A squared distance is |v|^2 + |c|^2 + sum(v_i * -2 c_i): the last sum is what ``zip_with`` and ``aggregate`` make, the first is
computed once a vector and the second is a literal.

Repeated rows and ids are vectors of their own. Inertia is summed as a decimal and NULL where it leaves the longs. An
empty table, or one without a kept vector, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.lineage import cut, scope

DIMS, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, 2
LARGEST = 1 << 27

Centroids = list[list[int]]


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, v (the integer components) and own (their squares' sum) of the vectors that take part."""
    wide = F.col(vector_col).cast("array<double>")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST))))
    rows = vectors.select(F.col(id_col).alias("vec_id"), wide.alias("x")).where(F.size("x") == dims).where(finite)
    return rows.select("vec_id", F.transform("x", whole).cast("array<bigint>").alias("v")).withColumn("own", dot("v", "v"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> Centroids:
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.v for r in rows.select(named.alias("name"), "v").orderBy("name", "v").limit(k).collect()]


def _literal(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{x}L' for x in values)})")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("bigint"), lambda s, x: s + x)


def nearest(v: Column | str, centroids: Centroids) -> Column:
    """(distance less the vector's own square, cluster) of the nearest centroid."""
    return F.array_min(F.array(*[
        F.struct((dot(v, _literal([-2 * x for x in c])) + sum(x * x for x in c)).alias("rest"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def assigned(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """vec_id, v, own (the square of v), distance and cluster of every row (vec_id, v, own)."""
    found = rows.select("vec_id", "v", "own", nearest("v", centroids).alias("best"))
    return found.select("vec_id", "v", "own", (F.col("own") + F.col("best.rest")).alias("distance"), F.col("best.cluster").alias("cluster"))


def moved(rows: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one step over ``rows`` with their cluster."""
    dims = len(centroids[0])
    sums = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])
    floors = sums.select("cluster", F.array(*[F.expr(f"(s{i} - pmod(s{i}, n)) div n") for i in range(dims)]).alias("c"))
    new = {r.cluster: r.c for r in floors.collect()}
    return [new.get(i, c) for i, c in enumerate(centroids)]


def clusters(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE, k: int = K, rounds: int = ROUNDS, seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    with scope(vectors.sparkSession):
        rows = cut(kept(vectors, id_col, vector_col, dims, scale))
        centroids = first_centroids(rows, k, seed) or [[0] * dims]
        for _ in range(rounds):
            centroids = moved(assigned(rows, centroids), centroids)
        last = cut(assigned(rows, centroids).select("vec_id", "cluster", "distance"), lasting=True)
        of = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(r.s for r in of)
    fits = lambda x: int(x) if x < 1 << 63 else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    about = vectors.sparkSession.createDataFrame(
        [(r.cluster, fits(r.s), fits(total), names[r.cluster]) for r in of], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
