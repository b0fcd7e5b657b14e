"""Pieces against the library, against a plain agenda with dropout, and exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings, strategies as st

from riskgraph.llm import pieces as P
from riskgraph.llm.queries import PIECE_MODEL

ODD = ["a  b", "  a", "a ", "", " ", "\n a\tb", "ﬁ ½", "a　b", "<s>hi</s>", "x\r\ny", "\x00a", "日本語€ 😀", " " * 40, "a\n \n b",
       "あ" * 90 + " ok", "loooo" * 40, "word " * 300, "é" * 70 + "tion" * 20]


@pytest.fixture(scope="module")
def model():
    return P.load(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def test_without_dropout_as_the_library(model, library):
    assert model.encode(ODD).to_pylist() == library.encode(ODD)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(max_size=80), max_size=4), rate=st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_round_trip(model, texts, rate):
    assert model.decode(model.encode(texts, rate)) == texts


def test_marks_in_a_text_come_back(model):
    texts = ["▁x ▁ a▁", "▁"]
    assert model.decode(model.encode(texts, 0.2)) == texts


def plain_agenda(model, chunk, draw, rate):
    """One list, the best and leftmost pair again and again; a skipped pair stays out until a neighbour changes."""
    mask = (1 << 64) - 1

    def mixed(x):
        x = ((x ^ x >> 30) * int(P.KEYS[1])) & mask
        x = ((x ^ x >> 27) * int(P.KEYS[2])) & mask
        return x ^ x >> 31

    key = mixed((xxhash.xxh64_intdigest(chunk.encode(), P.SEED) + draw * int(P.KEYS[2])) & mask)
    joins = dict(zip(model.pair.tolist(), model.joined.tolist(), strict=True))
    symbols = [(model.char.get(ord(c.replace(" ", "▁")), -1), i) for i, c in enumerate(chunk)]
    while True:
        best = None
        for i in range(len(symbols) - 1):
            (a, place), (b, _) = symbols[i : i + 2]
            piece = joins.get(a * model.size + b) if a >= 0 and b >= 0 else None
            if piece is None or mixed((key + place * int(P.KEYS[0]) + piece * int(P.KEYS[3])) & mask) < int(rate * 2**64):
                continue
            if best is None or model.rank[piece] > best[0]:
                best = (model.rank[piece], i, piece)
        if best is None:
            return [s for s, _ in symbols]
        symbols[best[1] : best[1] + 2] = [(best[2], symbols[best[1]][1])]


@pytest.mark.parametrize("long", [2, P.LONG])
def test_dropout_as_a_plain_agenda(model, monkeypatch, long):
    monkeypatch.setattr(P, "LONG", long)
    rng = random.Random(2)
    for rate in (0.1, 0.6):
        chunks = [" " + "".join(rng.choice(["tion", "er", "th", "ing", "un", "a", "qu", "s"]) for _ in range(rng.randint(1, 8))) for _ in range(60)]
        key = P._mixed(np.array([xxhash.xxh64_intdigest(c.encode(), P.SEED) for c in chunks], dtype=np.uint64) + np.uint64(3) * P.KEYS[2])
        got = model._ragged(chunks, key, np.uint64(int(rate * 2**64))).to_pylist()
        assert got == [plain_agenda(model, c, 3, rate) for c in chunks]


def test_dropout_varies_and_repeats(model):
    text = " ".join(["internationalization"] * 200)
    one, two = (model.encode([text, text], 0.3).to_pylist() for _ in range(2))
    assert one == two and one[0] == one[1] and model.encode([text], 0.3, seed=5).to_pylist()[0] != one[0]
    assert len(one[0]) > len(model.encode([text]).to_pylist()[0])
    assert len({tuple(p) for p in np.array_split(np.array(one[0]), 40) for p in [p.tolist()]}) > 3


def test_sharing_changes_nothing(model, monkeypatch):
    texts = [" ".join(["of", "the", "internationalization", "ﬁ▁x", "  a"] * 150), "the " * 400, "é" * 70 + " ok"]
    shared = model.encode(texts, 0.2).to_pylist()
    monkeypatch.setattr(P, "SHARED", -1)
    assert model.encode(texts, 0.2).to_pylist() == shared


def test_frequent_chunks_have_many_draws(model):
    text = " ".join(["internationalization"] * 3000)
    pieces, cut = model.encode([text], 0.1).to_pylist()[0], []
    for p in pieces:
        if model.raw[p].as_py().startswith(b" "):
            cut.append([])
        cut[-1].append(p)
    assert len(cut) == 3000 and len({tuple(c) for c in cut}) > 8


def test_documents(spark, model):
    rows = [(i % 5, t) for i, t in enumerate(ODD)] + [(None, None), (7, None), (7, "x" * 100000)]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, n_pieces int, lossless boolean").repartition(3)
    got = P.encode(docs, model).collect()
    assert len(got) == len(rows) and all(r.lossless and r.n_pieces == len(r.pieces) for r in got)
    want = sorted((str(d), model.encode([t or ""], P.RATE).to_pylist()[0]) for d, t in rows)
    assert sorted((str(r.doc_id), r.pieces) for r in got) == want
    assert P.encode(docs.where("false"), model).count() == 0
