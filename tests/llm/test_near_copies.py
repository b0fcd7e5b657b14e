"""Near copies against all pairs of exact shingle sets."""

import random

from riskgraph.llm import near_copies as N
from riskgraph.llm import simhash as S


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_same_as_all_pairs(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([12, 60, 200]))) for _ in range(8)] + [passage]
    texts = list(base)
    for _ in range(120):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w[rng.choice([0, 0, 5]) :] + rng.choice([[], [], passage.split()])))
    rows = list(enumerate(texts)) + [(None, None), (500, ""), (501, " \t"), (None, base[0].upper()), (3, base[3]), (3, base[3]), (502, "a b"), (503, "A  B"), (504, "a c")]
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    wide = 0
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                wide += (S.fingerprint(rows[i][1]) ^ S.fingerprint(rows[j][1])).bit_count() > 3
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rid long, row string").repartition(3)
    kept = N.keep_one(docs)
    assert kept.schema == docs.schema and wide > 20
    want = {}
    for i, r in enumerate(root):
        d = rows[i][0]
        want[r] = min(want.get(r, (True, 0)), (d is None, d or 0))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(None if none else d) for none, d in want.values())
    assert S.keep_one(docs).count() > len(want)  # three words and three bits leave near copies
    assert N.keep_one(docs.where("false")).count() == 0


def test_stage_links_by_fingerprint_and_by_sets(spark):
    """The stage of the pipeline against all pairs under both laws, with components that need links of both kinds."""
    import corpus_pipeline
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = []
    for i in range(6):
        beat = f"a{i} b{i} c{i} " * 40
        texts += [beat + say(4), beat + say(5)]  # fingerprints alike, sets not
        long = say(60).split()
        near = [*long[:30], "other", *long[31:]]  # sets alike
        texts += [" ".join(long), " ".join(near)]
        far = beat.split() + say(100).split()  # repeats for the fingerprint, new words for the sets
        texts += [" ".join(far), " ".join([*far[:-1], "last"])]
    rows = [(900 - i, t) for i, t in enumerate(texts)] + [(None, None), (2, " "), (None, texts[0])]
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    only = {"bits": 0, "sets": 0}
    for i in range(len(rows)):
        for j in range(i):
            bits = (S.fingerprint(rows[i][1]) ^ S.fingerprint(rows[j][1])).bit_count() <= 3
            alike = jaccard(sets[i], sets[j]) >= 0.8
            only["bits"] += bits and not alike
            only["sets"] += alike and not bits
            if bits or alike:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert min(only.values()) > 2
    want = {}
    for i, r in enumerate(root):
        d = rows[i][0]
        want[r] = min(want.get(r, (True, 0)), (d is None, d or 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.one_of_near_copies(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(None if none else d) for none, d in want.values())
    assert corpus_pipeline.one_of_near_copies(spark, docs.where("false"), "").count() == 0
