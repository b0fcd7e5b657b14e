"""Classifiers: held-out accuracy, parts of the models against plain code, and hostile tables."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from riskgraph.llm import language, quality, toxicity

SYLLABLES = {"en": ["the", "an", "tion", "er", "ing", "wh"], "de": ["sch", "ein", "ung", "ß", "keit", "ü"], "fr": ["eau", "qu", "é", "oi", "ment", "x"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text, toxic, good = words(rng, lang, rng.randint(20, 120)), rng.random() < 0.3, rng.random() < 0.7
        if not good:
            text = " ".join(w + "%%%" for w in text.split())
        if toxic:
            text = text.replace(" ", " vilefool ", 4)
        docs.append((i, text, lang))
        labels.append((i, int(good), int(toxic)))
    docs += [(None, None, None), (900, None, "en"), (901, "", "de"), (902, "12 + 34", None), (903, "the " * 20000, "en"), (3, docs[3][1], "en")]
    labels += [(None, 1, 1), (5, None, None), (7, 0, 0), (7, 0, 0), (5000, 1, 1)]
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame([(*d, 1.0, "x", True) for d in docs], "doc_id long, text string, lang string, score double, row string, held_out boolean")
    return docs, labels, frame.repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 4 == 2


def test_language(tables):
    docs, _, frame, _ = tables
    rows = language.identify(frame, language.train(frame)).collect()
    assert sorted((str(r.doc_id), r.held_out) for r in rows) == sorted((str(d), held(d)) for d, _, _ in docs)
    truth = {d: (t, x) for d, t, x in docs}
    tested = [r for r in rows if r.held_out and r.doc_id is not None and truth[r.doc_id][0] and r.doc_id < 900]
    assert len(tested) > 50 and np.mean([r.lang_pred == truth[r.doc_id][1] for r in tested]) > 0.95
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (None, 900, 901, 902))
    assert all(0 <= r.score <= 1 for r in rows)
    kept = language.keep_known(frame, language.train(frame))
    assert kept.schema == frame.schema and kept.count() == len(docs) - 4
    assert language.identify(frame.where("false"), language.train(frame.where("false"))).count() == 0
    assert {r.lang_pred for r in language.identify(frame, None).collect()} == {"und"}


def test_language_kernel_is_the_shared_ngrams_kernel():
    def grams(t):
        t = "".join(c.lower() if c.isalpha() else " " for c in t)
        t = " ".join(t.split()) + " "
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    texts = ["the thing", "Einung, sch", "eau qui é", "the eau"]
    model = language.Model(texts, ["en", "de", "fr", "en"])
    got = model._kernel(*language._grams(texts))
    want = [[len(grams(a) & grams(b)) / math.sqrt(len(grams(a)) * len(grams(b))) for b in texts] for a in texts]
    assert np.allclose(got, want, atol=1e-5)


@pytest.mark.parametrize(("module", "place", "threshold"), [(quality, 1, 0.7), (toxicity, 2, 0.3)])
def test_labelled_classifiers(tables, module, place, threshold):
    docs, labels, frame, label_frame = tables
    rows = module.score(frame, label_frame).collect()
    assert sorted((str(r.doc_id), r.held_out) for r in rows) == sorted((str(d), held(d)) for d, _, _ in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    truth = {x[0]: x[place] for x in labels if x[place] is not None}
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(tested) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.9
    assert len({r.score for r in rows if r.doc_id in (None, 900, 901)}) == 1
    assert module.score(frame.where("false"), label_frame).count() == 0
    flat = {r.score for r in module.score(frame, label_frame.where("false")).collect()}
    assert len(flat) == 1


def test_scores_do_not_use_held_out_labels(tables):
    _, labels, frame, label_frame = tables
    spark = frame.sparkSession
    turned = spark.createDataFrame([(d, 1 - q if held(d) and q is not None else q, t) for d, q, t in labels], "doc_id long, quality int, toxic int")
    score = lambda x: sorted((str(r.doc_id), r.score) for r in quality.score(frame, x).collect())
    assert score(label_frame) == score(turned)


def test_kneser_ney_ratios_by_hand():
    toxic, ordinary = Counter({"vile": 3, "fool": 2, "a": 1}), Counter({"fold": 4, "a": 5, "vine": 1})
    n, d = toxicity.ORDER, toxicity.DISCOUNT
    pad = lambda w: "\1" * (n - 1) + w + "\1"
    grams = lambda c: Counter({g: sum(k for w, k in c.items() for i in range(len(w) + 1) if pad(w)[i : i + n] == g)
                               for w in c for i in range(len(w) + 1) for g in [pad(w)[i : i + n]]})
    classes = [grams(toxic), grams(ordinary)]
    pooled = set(classes[0]) | set(classes[1])
    letters = {g[-1] for g in pooled}

    def chain(h, x):
        if not h:
            longer = {g[-2:] for g in pooled}
            count, total = sum(g[1] == x for g in longer), len(longer)
            return max(count - d, 0) / total + d * len({g[1] for g in longer}) / total / (len(letters) + 1)
        size = len(h) + 1
        longer = {g[n - size - 1 :] for g in pooled}
        count, total = sum(g[1:] == h + x for g in longer), sum(g[1:-1] == h for g in longer)
        lower = chain(h[1:], x)
        return lower if not total else max(count - d, 0) / total + d * len({g[-1] for g in longer if g[1:-1] == h}) / total * lower

    def prob(c, g):
        total = sum(k for x, k in c.items() if x[:-1] == g[:-1])
        if not total:
            return chain(g[1:-1], g[-1])
        kinds = sum(x[:-1] == g[:-1] for x in c)
        return max(c[g] - d, 0) / total + d * kinds / total * chain(g[1:-1], g[-1])

    model = toxicity.KneserNey(toxic, ordinary)
    for w in ["vile", "fool", "fold", "a", "vinefool", "zzz", "foo"]:
        got = model.word_ratios([w])[0]
        grams_of = [pad(w)[i : i + n] for i in range(len(w) + 1)]
        want = 0.0
        for g in grams_of:
            if g in pooled:
                want += math.log(prob(classes[0], g) / prob(classes[1], g))
            else:
                back = []
                for c in classes:
                    total = sum(k for x, k in c.items() if x[:-1] == g[:-1])
                    back.append(d * sum(x[:-1] == g[:-1] for x in c) / total if total else 1.0)
                want += math.log(back[0] / back[1])
        assert got == pytest.approx(want, abs=1e-4)


def test_language_sample_counts_distinct_texts(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(None, "copied text of one group", "en")] * 4000 + [(None, words(rng, "en", 30), "en") for _ in range(60)]
    rows += [(None, words(rng, "de", 30), "de") for _ in range(60)] + [(None, f"{chr(0x4e00 + i)} {chr(0x4e00 + i)}x", f"l{i:03d}") for i in range(230)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    monkeypatch.setattr(language, "Model", lambda texts, labels: seen.update(Counter(labels)))
    language.train(frame, per_class=50)
    assert 30 < seen["en"] <= 61 and 30 < seen["de"] <= 60 and sum(x.startswith("l") for x in seen) == 230
    seen.clear()
    language.train(frame, per_class=0)
    assert set(seen.values()) == {1} and len(seen) == 232


def test_toxicity_reads_all_labelled_texts(spark):
    """A word that stands in one text of 4,500 a class counts, and no more of the rows than the distinct texts reach the fit."""
    from riskgraph.llm.common import all_labelled_texts

    ids = [i for i in range(12000) if not held(i)]
    docs = spark.createDataFrame([(i, f"text w{'abcdefghij'[i % 10]}{i % 2}x q{chr(97 + i // 500)}{chr(97 + i // 20 % 25)}{chr(97 + i % 20)}z") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    texts, odds = all_labelled_texts(docs, labels, "toxic")
    assert texts.count() == len(ids) > 8000 and abs(odds) < 0.1
    rows = texts.collect()
    for c in (0, 1):
        mine = sorted((r.text, r.half) for r in rows if r.label == c)
        assert [half for _, half in mine] == [k % 2 == 1 for k in range(len(mine))]
    want = [Counter(), Counter()]
    for r in rows:
        want[1 - r.label].update(toxicity.WORD.findall(r.text))
    found = toxicity.gram_counts(texts.repartition(5)).toArrow()
    whole, all_at_once = toxicity.KneserNey.of_grams(found), toxicity.KneserNey(*want)
    assert np.array_equal(whole.gram, all_at_once.gram) and np.allclose(whole.ratio, all_at_once.ratio) and np.allclose(whole.back, all_at_once.back)


def test_logistic_over_rows_equals_the_one_in_memory(spark):
    from riskgraph.llm.common import fit_logistic, fit_logistic_rows

    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 4))
    y = (x @ [1, -2, 0.5, 0] + rng.logistic(size=500) > 0.7).astype(int)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "features array<double>, label int").repartition(5)
    assert np.allclose(fit_logistic_rows(rows, 4, 0.3), fit_logistic(x, y, 0.3), atol=1e-6)
