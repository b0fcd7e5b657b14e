"""SimHash groups against all pairs on small tables."""

import random
import re

import numpy as np
import pytest
import xxhash

from riskgraph.llm import simhash as S


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(values, most=3):
    """Smallest place in the list that each value reaches over links."""
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprint_and_spark_hash(spark):
    texts = [None, "", " \n", "One", "one TWO", "É a b c d", "a b c a b c a b c a b c", "x " * 5000]
    assert [S.fingerprint(t) for t in texts] == [plain(t) for t in texts]
    row = spark.sql("select xxhash64('a b c') h").first().h
    assert row % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", seed=42)


def near(rng, n, centres):
    values = []
    for _ in range(n):
        v = rng.choice(centres)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5])):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    return sorted(set(values))


@pytest.mark.parametrize(("unit", "most"), [(1 << 14, 3), (20, 3)])
def test_trie_join_loses_no_link(spark, unit, most):
    rng = random.Random(unit + most)
    values = near(rng, 300, [rng.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1])
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long").repartition(4)
    edges = S.cut(S.links(frame, most, unit))
    assert all((int(r.left) ^ int(r.right)) % (1 << 64) != 0 and ((int(r.left) ^ int(r.right)) % (1 << 64)).bit_count() <= 64 for r in edges.collect())
    place = {int(np.uint64(v).view(np.int64)): i for i, v in enumerate(values)}
    got = list(range(len(values)))
    by_root = {}
    for r in S.components(edges).collect():
        by_root.setdefault(r.root, []).append(place[r.node])
    for members in by_root.values():
        for m in members:
            got[m] = min(members)
    assert got == groups(values, most)


def test_walk_in_parts(monkeypatch):
    monkeypatch.setattr(S, "FRONTIER", 7)
    rng = random.Random(1)
    values = np.array(near(rng, 300, [rng.getrandbits(64) for _ in range(10)]), dtype=np.uint64)
    found = {(int(i), int(j)) for x, y in S.walk(values, values, True, 0, 3) for i, j in zip(x, y)}
    upper = lambda i, j: (int(values[i]) >> 32 ^ int(values[j]) >> 32).bit_count() <= 1
    assert found == {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
                     if (int(values[i]) ^ int(values[j])).bit_count() <= 3 and upper(i, j)}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 150)] + [(300, 200), (250, 300), (7, 7)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "left long, right long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), **dict.fromkeys((200, 250, 300), 200)}


def test_documents(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(4)]
    rows = [(i + 3, rng.choice(base).replace(rng.choice(words), "Zz", rng.choice([0, 1]))) for i in range(40)]
    rows += [(0, None), (1, ""), (2, " \t"), (None, "solo text"), (9, "solo  TEXT"), (50, base[0]), (50, base[0]), (None, "lone"), (None, None)]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, fp string, rid long, row string").repartition(3)
    prints = [plain(t) for _, t in rows]
    roots = groups(prints)
    lead = {}
    for i, r in enumerate(roots):
        d = rows[i][0]
        lead[r] = min(lead.get(r, (True, 0)), (d is None, d or 0))
    want = sorted(str((d, f"{prints[i]:016x}", None if lead[roots[i]][0] else lead[roots[i]][1])) for i, (d, _) in enumerate(rows))
    assert sorted(str(tuple(r)) for r in S.near_groups(docs).collect()) == want
    kept = S.keep_one(docs)
    assert kept.schema == docs.schema and kept.count() == len(set(roots))
    assert S.near_groups(docs.where("false")).count() == 0 and S.keep_one(docs.where("false")).count() == 0
