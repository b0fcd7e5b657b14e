"""Ids of any type and extra columns of any name."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskgraph.llm import decontaminate, language, line_dedup, near_copies, ngram_join, simhash


def own(i):
    return " ".join(f"{chr(97 + i)}{chr(97 + (i * j + j * j) % 26)}{i * 7 + j}" for j in range(1, 16))


@pytest.fixture(scope="module")
def docs(spark):
    line = "a line that many documents share, long enough to be one"
    texts = [f"{line}\n{own(i)}" for i in range(12)] + [f"{line}\n{own(1)}", None, ""]
    rows = [(f"d{i:02}", t, "en", 1.5, "x", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id string, text string, lang string, `my col` double, `x.y` string, rid int").repartition(3)


def test_text_ids(spark, docs):
    groups = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
    assert groups["d12"] == "d01" and groups["d14"] == "d13" and groups["d00"] == "d00"
    same = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs).collect()}
    assert same["d12"] == "d01" and same["d14"] == "d14"
    benchmark = spark.createDataFrame([(1, own(3))], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, benchmark).collect()] == ["d03"]
    lines = line_dedup.line_classes(docs)
    assert lines.where("kept").count() < lines.count() and dict(lines.dtypes)["doc_id"] == "string"


def test_stages_carry_any_columns(spark, docs, tmp_path):
    benchmark = spark.createDataFrame([(1, own(3))], "item_id long, text string")
    assert language.keep_known(docs, language.train(docs)).schema == docs.schema
    kept = {r.doc_id for r in near_copies.keep_one(docs).select("doc_id").collect()}
    assert kept == {f"d{i:02}" for i in range(14)} - {"d12"}
    clean = decontaminate.clean(docs, benchmark)
    assert clean.schema == docs.schema and clean.count() == 14


def test_the_whole_pipeline(spark, tmp_path):
    """``run`` is its stages one after the other, each on what the one before kept."""
    from riskgraph.llm import pieces
    words = "the quick brown fox jumps over a lazy dog while seven wizards box with daft zombies and quote verse".split()
    say = lambda i: " ".join(words[(i * 7 + j * (i % 5 + 1)) % len(words)] + (f" n{i}x{j}" if j % 6 == 0 else "") for j in range(90))
    texts = [say(i) for i in range(20)]
    item = "a passage of the benchmark that has more than fifty characters and must not be trained on by anyone who reads it, ever"
    texts += [texts[0], texts[1].replace(" ", "  "), texts[2] + " and one more", texts[3] + " " + item, None, "12 + 34", ""]
    spark.createDataFrame([(i, t, "en" if i % 2 else "de", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # equal texts: the longest stays; near ones: the smallest id
    assert set(found) == ({*range(20)} - {1}) | {21} and all(r.lossless for r in found.values())
    model = pieces.load(corpus_pipeline.PIECE_MODEL)
    assert found[5].pieces == model.encode([texts[5]], pieces.RATE).to_pylist()[0]
    docs, step = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        step[name] = docs.count()
    assert [step[n] for n, _ in corpus_pipeline.STAGES] == [24, 22, 21, 20, 20]
    assert {r.doc_id for r in docs.select(F.col("doc_id")).collect()} == set(found)
