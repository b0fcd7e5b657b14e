"""Centroid clustering against a plain integer version."""

import hashlib
import math
import random

import pytest

from riskgraph.llm import centroids as C


def plain(rows, dims, k, rounds):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x):
            kept.append((vec_id, [math.floor(max(-C.LARGEST, min(C.LARGEST, c * 256))) for c in x]))
    name = lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]
    for step in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids)) for _, v in kept]
        if step < rounds:
            for i in range(len(centroids)):
                own = [v for (_, v), (_, at) in zip(kept, best, strict=True) if at == i]
                if own:
                    centroids[i] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    sums = {}
    for d, i in best:
        sums[i] = sums.get(i, 0) + d
    fits = lambda x: x if x < 2**63 else None
    return [(vec_id, i, d, fits(sums[i]), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest())
            for (vec_id, _), (d, i) in zip(kept, best, strict=True)]


def vectors(rng, n, dims):
    rows = [(i, [rng.choice([rng.gauss(0, 1), rng.choice([-0.5, 0.0, 1.0])]) for _ in range(dims)]) for i in range(n)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, rows[6][1])] + [(1000 + i, rows[0][1]) for i in range(n)]
    return rows + [(2000, None), (2001, []), (2002, rows[0][1][:-1]), (2003, rows[0][1] + [1.0]), (2004, [None] + rows[0][1][1:]),
                   (2005, [float("nan")] + rows[0][1][1:]), (2006, [float("-inf")] + rows[0][1][1:])]


@pytest.mark.parametrize(("seed", "kind"), [(1, "double"), (2, "float")])
def test_same_as_plain(spark, seed, kind):
    import numpy as np
    rng = random.Random(seed)
    rows = vectors(rng, 90, 6)
    if kind == "float":
        rows = [(i, x and [None if c is None else float(np.float32(c)) for c in x]) for i, x in rows]
    table = spark.createDataFrame([(*r, 9, "v") for r in rows], f"vec_id long, embedding array<{kind}>, cluster int, v string").repartition(4)
    found = C.clusters(table, dims=6, k=12)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain(rows, 6, 12, 5)))


def test_few_none_and_huge(spark):
    rows = [(i, [x, -x]) for i, x in enumerate([1e300, -1e300, 1e30, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, C.clusters(table, dims=2, k=9).collect())) == sorted(plain(rows, 2, 9, 5))
    wide = [(i, [rng * 1e9 for rng in random.Random(i).choices([-1, 1], k=64)]) for i in range(200)]
    found = C.clusters(spark.createDataFrame(wide, "vec_id long, embedding array<double>"), k=1)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain(wide, 64, 1, 5)))
    assert found.first().inertia is None
    for none in ("false", "vec_id = 3"):
        assert C.clusters(table.where(none)).collect() == []
