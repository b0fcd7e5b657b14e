"""Line classes against all pairs and a plain edit distance."""

import random

import numpy as np
import pytest
import xxhash

from riskgraph.llm import line_dedup as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def linked(a, b):
    most = min(min(len(a), len(b)) // L.SHORT, L.MOST)
    return abs(len(a) - len(b)) <= most and distance(a, b) <= most


def edited(text, n, rng):
    chars = list(text)
    for _ in range(n):
        i = rng.randrange(len(chars))
        rng.choice([lambda: chars.pop(i), lambda: chars.insert(i, "ä"), lambda: chars.__setitem__(i, "x")])()
    return "".join(chars)


def some_lines(rng, n):
    base = ["".join(rng.choice("abcdefg é") for _ in range(rng.choice([5, 19, 20, 25, 39, 40, 60, 90]))) for _ in range(n)]
    return base + [edited(x, rng.choice([1, 1, 2, 2, 3]), rng) for x in base for _ in range(2)]


def test_keys_follow_the_substrings():
    lines = [f"{i:04d}" + "the same text in all of these lines, but for its head" for i in range(50)] + ["x" * 57]
    chars, sizes, starts = L._codes(lines)
    keys = [set() for _ in lines]
    for rows, key, role, place, size in L.keys_of(chars, sizes, starts):
        for r, k in zip(rows[role == 3 and slice(None) or slice(0)].tolist(), key.tolist()):
            keys[r].add(k)
    assert len(keys[0] & keys[1]) == 2 and len(set().union(*keys[:50])) == 52 and not keys[0] & keys[50]


def test_within_as_plain_distance():
    rng = random.Random(4)
    lines = some_lines(rng, 60) + [""]
    pairs = [(a, b) for a in lines for b in rng.sample(lines, 12)] + list(zip(lines[:60], lines[60:120])) + [("", ""), ("", "ab"), ("a" * 3000, "a" * 2999)]
    for most in (0, 1, 2):
        got = L.within([a for a, _ in pairs], [b for _, b in pairs], np.full(len(pairs), most))
        assert got.tolist() == [distance(a, b) <= most if len(a) < 1000 else most > 0 for a, b in pairs]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, rid int, line string").repartition(3)


def expected(rows):
    lines = sorted({x for _, t in rows if t is not None for x in t.split("\n")})
    root = {x: x for x in lines}
    degree = dict.fromkeys(lines, 0)
    for i, a in enumerate(lines):
        for b in lines[:i]:
            if linked(a, b):
                degree[a] += 1
                degree[b] += 1
                old, new = root[a], root[b]
                root = {k: new if v == old else v for k, v in root.items()}
    return root, degree


@pytest.mark.parametrize(("size", "pairs"), [(3, 1 << 22), (7, 5), (1000, 300)])
def test_units_over_batches(monkeypatch, size, pairs):
    monkeypatch.setattr(L, "PAIRS", pairs)
    rng = random.Random(size)
    rows = sorted(((rng.randrange(12) ** 2 % 30, rng.randrange(2), 2 * n + rng.randrange(2), 0) for n in range(400)), key=lambda r: (r[0], r[1], -(r[2] & 1)))
    batches = [L.pa.RecordBatch.from_arrays([L.pa.array(c) for c in zip(*rows[i : i + size])], ["key", "block", "who", "signs"]) for i in range(0, 400, size)]
    got = sorted((int(a), int(b)) for x in L._pairs(iter(batches)) for a, b in zip(x.column("left").to_pylist(), x.column("right").to_pylist()))
    want = sorted((min(a[2] & -2, b[2] & -2), max(a[2] & -2, b[2] & -2)) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[:2] == b[:2] and (a[2] | b[2]) & 1)
    assert got == want


@pytest.mark.parametrize("unit", [2048, 2])
def test_classes_as_brute_force(spark, unit):
    rng = random.Random(unit)
    lines = some_lines(rng, 25) + ["", " "] + [f"user {i:05d} logged in from the same old template line at noon" for i in range(0, 99, 7)]
    rows = [(i // 2, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for i in range(40)] + [(None, None), (50, None), (3, lines[0]), (3, lines[0]), (None, lines[1])]
    root, degree = expected(rows)
    got = L.line_classes(table(spark, rows), unit=unit).collect()
    name = {xxhash.xxh3_128_hexdigest(x.encode()): x for x in root}
    assert sorted((str(r.doc_id), r.line_no, name[r.line_hash]) for r in got) == sorted(
        (str(d), i, x) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")))
    by_class = {}
    for r in got:
        by_class.setdefault(r.class_hash, set()).add(name[r.line_hash])
    want = {}
    for x, r in root.items():
        want.setdefault(r, set()).add(x)
    assert sorted(map(sorted, by_class.values())) == sorted(map(sorted, want.values()))
    assert all(r.n_links == degree[name[r.line_hash]] for r in got)
    for members in by_class.values():
        mine = [r for r in got if name[r.line_hash] in members]
        first = min((r.doc_id is None, r.doc_id or 0, r.line_no) for r in mine)
        assert sum(r.kept for r in mine) == 1 and all(r.class_size == len(mine) for r in mine)
        kept = next(r for r in mine if r.kept)
        assert (kept.doc_id is None, kept.doc_id or 0, kept.line_no) == first


def test_strip_and_empty_tables(spark):
    rows = [(1, "keep this line of text here\n\nsecond line is only here"), (2, "keep this line of text hera\n\nanother one that is alone"), (3, None), (4, ""), (4, "")]
    docs = table(spark, rows)
    got = L.strip(docs)
    assert got.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(str(x) for x in [
        rows[0], (2, "\nanother one that is alone"), rows[2], (4, ""), (4, "")])
    none = docs.where("false")
    assert L.line_classes(none).count() == 0 and L.strip(none).count() == 0
