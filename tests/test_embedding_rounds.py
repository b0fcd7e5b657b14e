"""The default number of training rounds on a larger graph."""

import inspect

from riskgraph.operators import embedding


def larger_graph(spark):
    rows = [(f"m{i}", "in", f"block{i % 12}") for i in range(480)] + [(f"m{i}", "near", f"m{(i + 12) % 480}") for i in range(480)]
    return spark.createDataFrame(rows, "s string, p string, o string")


def test_default_rounds_train_a_larger_graph(spark):
    assert inspect.signature(embedding.train_translation_model).parameters["rounds"].default >= 30
    train, test = embedding.split_triples(larger_graph(spark))
    losses = []
    for options in ({"rounds": 0}, {}):
        entities, relations = embedding.train_translation_model(train, "TransE", 8, **options)
        losses.append(embedding.margin_loss(train, entities, relations, "TransE").first().loss)
    asked = embedding.cut(embedding.link_queries(test, entities, relations, "TransE"))
    known = embedding.true_answers(asked, train.unionByName(test))
    ranks = embedding.rank_metrics(embedding.target_ranks(asked, entities, "l2", known=known, average_ties=True)).first()
    print("losses untrained and after the default:", losses, "MRR:", ranks.mrr)
    assert losses[1] < 0.3 * losses[0] and ranks.mrr > 0.1 and ranks.ranked == 192


def test_every_pair_of_blocks_meets_once(spark):
    from pyspark.sql import functions as F
    for blocks in (1, 2, 3, 4, 5, 8):
        pairs = spark.range(blocks).selectExpr("cast(id as int) i").crossJoin(spark.range(blocks).selectExpr("cast(id as int) j")).where("i <= j")
        met = {(r.i, r.j): (r.turn, r.back) for r in pairs.select("i", "j", embedding._turn_of(F.col("i"), F.col("j"), blocks).alias("turn"), embedding._turn_of(F.col("j"), F.col("i"), blocks).alias("back")).collect()}
        assert all(a == b for a, b in met.values()) and len({t for t, _ in met.values()}) <= (1 if blocks == 1 else blocks + blocks % 2)
        for turn in {t for t, _ in met.values()}:
            here = [p for p, (t, _) in met.items() if t == turn]
            assert len({b for p in here for b in p}) == sum(len(set(p)) for p in here)  # a block is in one pair
            of = {r.i: r.pair for r in spark.range(blocks).selectExpr("cast(id as int) i").select("i", embedding._pair_of(F.col("i"), turn, blocks).alias("pair")).collect()}
            assert all(of[i] == of[j] == i for i, j in here)


def test_blocks_and_slices_train_too(spark):
    train, _ = embedding.split_triples(larger_graph(spark))
    options = {"block_rows": 180, "bucket_edges": 150, "least_updates": 0, "batch": 32}
    for model in ("TransE", "DistMult"):
        losses = [embedding.margin_loss(train, *embedding.train_translation_model(train, model, 8, rounds=n, **options), model).first().loss for n in (0, 5)]
        assert losses[1] < 0.6 * losses[0], (model, losses)
    entities, relations = embedding.train_translation_model(train, "TransE", 8, rounds=1, **options)
    assert entities.count() == 492 and entities.select("node").distinct().count() == 492 and relations.count() == 2
