"""Spelling variants against all pairs of words."""

import random
import re
import zlib

import pytest

from riskgraph.llm import spelling as W


def near(a, b):
    """Exactly one insertion, deletion or replacement, told by what remains without the common ends."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    rest = (a[i + (len(a) >= len(b)) :], b[i + (len(b) >= len(a)) :])
    return rest[0] == rest[1]


def plain(rows, every=31, times=10):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out = {}
    for w, n in counts.items():
        close = sorted((-counts[v], v) for v in counts if near(v, w))
        fits = close and -close[0][0] >= times * n
        out[w] = (close[0][1] if fits else None, n, len(close), -close[0][0] if fits else None)
    rows = []
    for w, (form, n, many, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, many, form_n))
    return sorted(rows)


def corpus(rng):
    alphabet = "abcdeilmnorstuàéßÿ×"
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.choice([7, 7, 8, 9, 12]))) for _ in range(25)]
    stems += [s[::-1] for s in stems[:5]] + ["aaaaaaa", "aaaaaaaa", "a" * 3000, "a" * 2999 + "b"]

    def edited(w):
        at, kind = rng.randrange(len(w)), rng.randrange(3)
        return w[:at] + ("" if kind == 0 else rng.choice(alphabet)) + w[at + (kind != 2) :]

    pool = [w for s in stems for w in [s] * rng.choice([2, 30, 400])]
    pool += [e for s in stems for _ in range(6) for e in [edited(s)] * rng.choice([1, 2, 3])]
    pool += [edited(edited(s)) for s in stems for _ in range(3)] * 2
    pool += ["chainword"] * 600 + ["chainwort"] * 40 + ["chainwoot"] * 3
    rng.shuffle(pool)
    rows, docs = [], 0
    while pool:
        n = rng.choice([1, 40, 400])
        rows.append((docs, rng.choice([" ", "-", "_1 ", "ĀĂ"]).join(w.upper() if w.isascii() and rng.random() < 0.1 else w for w in pool[:n])))
        pool, docs = pool[n:], docs + 1
    return rows + [(None, None), (None, "Straßen Straßen Straßen"), (7, ""), (7, "short"), rows[0], rows[0]]


@pytest.mark.parametrize("every", [0, 3, 31])
def test_same_as_all_pairs(spark, every):
    rows = corpus(random.Random(every))
    docs = spark.createDataFrame([(*r, "w", 5) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    got = sorted(tuple(r) for r in W.variants(docs, every=every).collect())
    want = plain(rows, every)
    assert got == want
    assert sum(r[1] is not None for r in want) > 10 and any(r[1] and r[1] != r[2] for r in want)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert W.variants(docs).columns == ["word", "form", "root", "n", "n_near", "form_n"] and W.variants(docs).count() == 0


@pytest.mark.parametrize(("n1", "n2"), [(1, 3), (1, 5), (2, 2), (2, 3), (3, 1)])
def test_signatures_of_near_words_meet(n1, n2):
    rng = random.Random(n1 * n2)
    for _ in range(300):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 12)))
        at = rng.randrange(len(w))
        v = rng.choice([w[:at] + w[at + 1 :] if len(w) > 7 else w, w[:at] + "f" + w[at + 1 :], w[:at] + "é" + w[at:]])
        a, b = W.signatures([w, v], {c: i % (n1 * n2) for i, c in enumerate("abcdeéf")}, n1, n2, 3).tolist()
        assert set(a) & set(b)


def test_chains_are_followed(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [("x", "w3")]
    got = {r.word: (r.form, r.root) for r in W.last_forms(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: (f, "w19") for w, f in forms}
