"""Benchmark passages against a plain dynamic program over every window and text."""

import random

from riskgraph.llm import decontaminate as D

SCHEMA = "doc_id long, text string, rid long, row string, item_id string"


def fold_plain(text):
    out = []
    for c in text or "":
        c = " " if c.isspace() else c.lower() if len(c.lower()) == 1 else c
        if c != " " or not out or out[-1] != " ":
            out.append(c)
    return "".join(out)


def windows(text):
    t = fold_plain(text).strip(" ")
    last = max(0, len(t) - D.WINDOW)
    return [t[a : a + D.WINDOW] for a in sorted({*range(0, last, D.WINDOW // 2), last})] if len(t) >= D.Q else []


def fewest(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def spoilt(text, edits, rng):
    chars = list(text)
    for _ in range(min(edits, len(chars) - 1)):
        i = rng.randrange(max(1, len(chars)))
        rng.choice([lambda: chars.pop(i), lambda: chars.insert(i, "z"), lambda: chars.__setitem__(i, "q")])()
    return "".join(chars)


def test_same_as_brute_force(spark):
    rng = random.Random(3)
    words = ["tion", "the ", "an", "er ", "ing", "ble ", "Éon", "ment ", "ß", "  "]
    text = lambda n: "".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([3, 8, 30, 60, 90]))) for i in range(14)] + [(50, None), (51, "short"), (None, text(40)), (3, text(30))]
    docs = [(None, None), (1, ""), (2, "\n\t ")]
    for i in range(40):
        passage = (rng.choice(items)[1] or "")[rng.choice([0, 0, 40]) :]
        docs.append((i // 2, text(40) + spoilt(passage or "xxxxxxxxxxxx", rng.choice([0, 0, 2, 4, 9]), rng).upper() + text(rng.choice([0, 30]))))
    docs += [(90, items[4][1]), (91, items[4][1]), (90, items[4][1])]
    left = spark.createDataFrame([(*d, 1, "r", "i") for d in docs], SCHEMA).repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for d, t in docs:
        folded = fold_plain(t)
        for item, x in items:
            found = [e for w in windows(x) if (e := fewest(w, folded)) <= len(w) // D.PER_EDIT]
            if found:
                expected.append((d, item, min(found)))
    expected = {(d, i, e) for d, i, e in expected}
    got = D.contaminated(left, right).collect()
    best = {}
    for r in got:  # two items of one id are answered together
        best[r.doc_id, r.item_id] = min(r.edits, best.get((r.doc_id, r.item_id), 99))
    want = {}
    for d, i, e in expected:
        want[d, i] = min(e, want.get((d, i), 99))
    assert best == want and len(want) > 10
    kept = D.clean(left, right)
    hit = {t for d, t in docs if any(fewest(w, fold_plain(t)) <= len(w) // D.PER_EDIT for _, x in items for w in windows(x))}
    assert kept.columns == left.columns and sorted(str(r.text) for r in kept.collect()) == sorted(str(t) for _, t in docs if t not in hit)


def test_spans_point_into_the_original(spark):
    item = "The quick brown fox, jumping over lazy dogs, found a very narrow path between two hills."
    text = "é\n\n intro   " + item.upper().replace(" ", "\n ") + " and so on"
    row = D.contaminated(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert text[row.start : row.end] == item.upper().replace(" ", "\n ") and (row.item_id, row.edits, row.windows) == (7, 0, 1)


def test_blocks_and_empty_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{i} " + "abcdefghij klmno pqrst " * 4 + str(i)) for i in range(4)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"{i} " + "abcdefghij klmno pqrst " * 4 + str(i)) for i in range(4)], "item_id long, text string")
    whole = sorted(map(tuple, D.contaminated(docs, items).collect()))
    monkeypatch.setattr(D, "BLOCK", 150)
    assert sorted(map(tuple, D.contaminated(docs, items).collect())) == whole and len(whole) >= 4
    assert D.contaminated(docs.where("false"), items).count() == 0 and D.contaminated(docs, items.where("false")).count() == 0
    assert D.clean(docs, items.where("false")).count() == 4 and D.clean(docs.where("false"), items).count() == 0


def test_quotes_from_any_place_and_edited_short_items():
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    item = letters(400)
    quotes = [letters(50) + item[at : at + n] + letters(50) for n in (96, 110) for at in range(0, 400 - n)]
    assert {d for d, *_ in D.find(D.Index([(1, item)], D.STRIDE), quotes)} == set(range(len(quotes)))
    for n in (16, 19, 20, 23, 32, 34, 35):
        short, k = letters(n), n // D.PER_EDIT
        chars = list(short)
        for e in range(k):
            chars[(e + 1) * n // (k + 1)] = "#"
        found = D.find(D.Index([(1, short)], D.STRIDE), [letters(30) + "".join(chars) + letters(30)])
        assert [(d, i, e) for d, i, _, _, e, _ in found] == [(0, 1, k)]


def test_queries_take_the_small_stride(spark, tmp_path):
    import corpus_pipeline
    from riskgraph.llm.queries import QUERIES
    item = "".join(random.Random(5).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400))
    docs = spark.createDataFrame([(i, "0" * 40 + item[i : i + 110] + "0" * 40) for i in range(100, 148)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert QUERIES["op6_decontaminate"](spark, str(tmp_path)).count() == 48
    assert corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).count() == 0


def test_a_long_run_of_one_character(spark):
    """A ruler of 200,000 characters against an item that holds one: one hit, in bounded memory."""
    import resource
    index = D.Index([(1, "-" * 300), (2, "a table " + "=-" * 60)], D.STRIDE)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = D.find(index, ["x " + "-" * 200_000, "", "=-" * 2000 + "\n" + "-" * 40])
    assert [(d, item, edits) for d, item, _, _, edits, _ in found] == [(0, 1, 0), (2, 2, 0)]
    assert found[0][4] >= 0 and all(b - a == 96 for _, _, a, b, _, _ in found)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB


def test_slices_change_nothing(monkeypatch):
    rng = random.Random(4)
    items = [(i, "".join(rng.choice("ab =-") for _ in range(rng.choice([14, 40, 96, 250])))) for i in range(12)]
    texts = [items[i % 12][1][rng.randrange(60):] + "=" * rng.randrange(50) + items[i % 7][1] for i in range(30)]
    index = D.Index(items, D.STRIDE)
    whole = D.find(index, texts)
    for name, value in (("SLICE", 512), ("RUN", 16), ("ROWS", 7)):
        monkeypatch.setattr(D, name, value)
    assert D.find(index, texts) == whole and len(whole) > 20
