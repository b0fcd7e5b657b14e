"""The n-gram join against all pairs of exact shingle sets."""

import random

import numpy as np
import pytest

from riskgraph.llm import ngram_join as J


def shingle_set(text, k=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def components(rows, percent=85):
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    links = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links += a != b
                lo, hi = sorted((root[i], root[j]))
                root = [lo if r == hi else r for r in root]
    return sets, root, links


def texts(rng, n):
    words = [f"w{i}" for i in range(300)]
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [say(rng.choice([9, 25, 60])) for _ in range(4)]
    base = [say(rng.choice([5, 9, 12, 40, 90, 200])) for _ in range(8)] + [say(900)] + [" ".join(rng.sample(passages, 3)) for _ in range(4)] + passages
    out = list(base)
    while len(out) < n:
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(2)
        out.append(" ".join(w + rng.choice([[], [], [rng.choice(words)], rng.choice(passages).split()])))
    return out


@pytest.mark.parametrize("frequent", [False, True])
def test_same_as_all_pairs(spark, frequent, monkeypatch):
    rng = random.Random(3)
    rows = list(enumerate(texts(rng, 160))) + [(None, None), (None, "a b c d e"), (900, "A  b\tc d\x0be"), (901, ""), (902, " \n"), (903, "one"), (904, "ONE")]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (905, rows[4][1].upper()), (906, "É é"), (907, "é é")]
    if frequent:  # nearly every token is of class 2 or 3
        monkeypatch.setattr(J, "sketch", lambda rows, words: (np.tile([40, 700, 3], J.SLOTS)[: 2 * J.SLOTS].astype(np.int32), np.array([16, 256])))
    sets, root, links = components(rows)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rid long, n string").repartition(5)
    found = J.similar_groups(docs).collect()
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least.setdefault(r, []).append(d)
    want = sorted(str((d, len(s), min((x for x in least[r] if x is not None), default=None))) for (d, _), s, r in zip(rows, sets, root, strict=True))
    assert sorted(str(tuple(r)) for r in found) == want and links > 60
    assert J.similar_groups(docs.where("false")).collect() == []


def test_prefixes_of_similar_sets_share_a_key():
    rng, draw, seen = random.Random(5), np.random.default_rng(5), 0
    limits = np.array([16, 256])
    for _ in range(800):
        n, percent = rng.choice([4, 6, 7, 8, 15, 16, 17, 31, 32, 64, 150]), rng.choice([80, 85, 90])
        excess = draw.choice([-5, 20, 500], size=2 * J.SLOTS, p=rng.choice([[0.3, 0.4, 0.3], [0, 0, 1], [0, 1, 0]])).astype(np.int32)
        one = [rng.getrandbits(64) for _ in range(n)]
        other = one[rng.randrange(1 + n // 6) :] + [rng.getrandbits(64) for _ in range(rng.randrange(1 + n // 6))]
        a, b = (np.unique(np.array(x, dtype=np.uint64)) for x in (one, other))
        if len(a) != len(b) and J.similar(a, b, percent) or J.similar(a, b, percent) and not np.array_equal(a, b):
            seen += 1
            assert len(np.intersect1d(J.keys(a, excess, limits, percent), J.keys(b, excess, limits, percent)))
    assert seen > 150
    long = np.unique(draw.integers(0, 2**63, 20000).astype(np.uint64))
    assert len(J.keys(long, np.full(2 * J.SLOTS, 500, np.int32), limits, 85)) < 2 * len(long)  # combinations grow with the set, not its square


def test_sketches_never_rule_out_too_much():
    draw = np.random.default_rng(9)
    for n in (3, 300, 511, 513, 3000, 9000):
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        for share in (0, 0.02, 0.3, 1):
            b = np.unique(np.concatenate([a[int(share * n) :], draw.integers(0, 2**63, int(1.1 * share * n)).astype(np.uint64)]))
            differ = len(np.setxor1d(a, b))
            assert np.bitwise_count((J.parities(a) ^ J.parities(b)).view(np.uint64)).sum() <= differ
            wide = J.long_sketch(a), J.long_sketch(b)
            assert (wide[0] is None) == (2 * len(a) <= 1024)
            if None not in wide:
                assert differ * 0.3 <= J.least_difference(*wide) <= differ


def test_no_similarity_below_the_proof(spark):
    with pytest.raises(ValueError):
        J.classes(spark.createDataFrame([], "rid long, text string"), 4, 70)


def test_a_hub_and_its_copies(spark):
    """Copies similar to one original but not to each other are one component."""
    words = [f"h{i}" for i in range(120)]
    rows = [(i, " ".join(words[:10 * i % 110] + [f"x{i}a"] + words[10 * i % 110 + 1 :] + [f"t{i}_{j}" for j in range(6)])) for i in range(1, 60)] + [(60, " ".join(words))]
    _, root, _ = components(rows)
    found = {r.doc_id: r.component_id for r in J.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {d: rows[r][0] for (d, _), r in zip(rows, root, strict=True)} and len(set(found.values())) < 10


def test_keys_of_two_members_move_once(spark, monkeypatch):
    """Pairs of copies: their keys are pairs at once; no lead is chosen, and nothing is left for a second comparison."""
    rng = random.Random(4)
    rows = []
    for i in range(30):
        w = [f"u{i}_{rng.randrange(10**6)}" for _ in range(80)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:79], "end"]))]
    tables, cut = [], J.cut
    monkeypatch.setattr(J, "cut", lambda df, **options: tables.append((df.columns, (made := cut(df, **options)).count())) or made)
    found = {r.doc_id: r.component_id for r in J.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {d: d - d % 2 for d, _ in rows}
    assert [n for columns, n in tables if columns == ["key", "other", "m"]] == [0]  # leads
    assert [n for columns, n in tables if columns == ["rid", "score"]] == [0]
    assert (["left", "right"], 30) in tables


def test_folded_sketches_bound_the_difference(spark):
    draw = np.random.default_rng(2)
    for n in (5, 400, 3000):
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 10 :], draw.integers(0, 2**63, n // 10).astype(np.uint64)]))
        frame = spark.createDataFrame([(J.parities(a).tolist(), J.parities(b).tolist())], "a array<long>, b array<long>")
        x, y = (np.array(v, dtype=np.int64) for v in frame.select(J._folded("a"), J._folded("b")).first())
        bits = np.bitwise_count((x ^ y).view(np.uint64)).sum()
        assert len(x) == J.PARITIES // 128 and bits <= len(np.setxor1d(a, b)) and (n < 100 or bits > 0)
