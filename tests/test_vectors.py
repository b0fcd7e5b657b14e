import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators import embedding, features, joins, models


def dense(spark, edges):
    df = spark.createDataFrame(edges, "left string, right string")
    names = sorted({n for e in edges for n in e})
    at = {n: i for i, n in enumerate(names)}
    a = np.eye(len(names))
    for x, y in set(edges):
        if x != y:
            a[at[x], at[y]] = a[at[y], at[x]] = 1.0
        else:
            a[at[x], at[x]] = 2.0
    d = np.maximum(a.sum(1), 1)
    return df, names, a / np.sqrt(np.outer(d, d))


def test_adjacency_and_svd(spark):
    rng = np.random.default_rng(3)
    edges = [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 14, (30, 2))] + [("hub", f"n{i}") for i in range(14)]
    df, names, a = dense(spark, edges)
    got = np.zeros_like(a)
    for r in embedding.normalised_adjacency(df).collect():
        got[names.index(r.i), names.index(r.j)] = r.w
    assert np.allclose(got, a)
    rows = {r.node: r.vec for r in embedding.svd_embedding(df, dim=4, oversample=8, iterations=6).collect()}
    ours = np.array([rows[n] for n in names])
    u, s, _ = np.linalg.svd(a)
    # Singular values match; the span matches through the rank-4 product.
    assert np.allclose(np.sort(np.linalg.norm(ours, axis=0))[::-1], s[:4], atol=1e-6)
    assert np.allclose(ours @ ours.T, (u[:, :4] * s[:4] ** 2) @ u[:, :4].T, atol=1e-5)


def test_svd_pads_small_graphs(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c")], "left string, right string")
    rows = embedding.svd_embedding(df, dim=5).collect()
    assert len(rows) == 3 and all(len(r.vec) == 5 and r.vec[2:] == [0.0] * 3 for r in rows)


def test_ranks_match_brute_force(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(60, 6))
    entities = spark.createDataFrame([(f"e{i}", x.tolist()) for i, x in enumerate(v)], "node string, vec array<double>")
    asked = [(f"q{i}", f"e{(i * 7) % 60}", v[i].tolist(), v[(i * 7) % 60].tolist()) for i in range(25)]
    queries = spark.createDataFrame(asked, "query_id string, target string, q array<double>, t array<double>")
    for kind in ("dot", "l2"):
        got = {r.query_id: r["rank"] for r in embedding.target_ranks(queries, entities, kind, block_rows=11).collect()}
        for name, target, q, t in asked:
            score = v @ np.array(q) if kind == "dot" else -((v - np.array(q)) ** 2).sum(1)
            own = score[int(target[1:])]
            assert got[name] == 1 + int((np.delete(score, int(target[1:])) > own + 1e-9).sum())


def test_filtered_ranks_with_ties(spark):
    v = [[1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [0.5, 0.0], [3.0, 0.0], [1.0, 5.0]]
    entities = spark.createDataFrame([(f"e{i}", x) for i, x in enumerate(v)], "node string, vec array<double>")
    queries = spark.createDataFrame([("q", "e0", [1.0, 0.0], v[0])], "query_id string, target string, q array<double>, t array<double>")
    known = spark.createDataFrame([("q", "e4"), ("q", "e0"), ("q", "e5"), ("q", "e4")], "query_id string, node string")
    rank = lambda **o: embedding.target_ranks(queries, entities, **o).first()["rank"]
    assert rank() == 3 and rank(average_ties=True) == 4.0  # e2, e4 higher; e1, e5 equal
    assert rank(known=known) == 2 and rank(known=known, average_ties=True) == 2.5


def graph(spark):
    """Members of one block link to their block node and to their successor in the block."""
    rows = [(f"m{i}", "in", f"block{i % 4}") for i in range(60)] + [(f"m{i}", "near", f"m{(i + 4) % 60}") for i in range(60)]
    return spark.createDataFrame(rows, "s string, p string, o string")


def test_split_keeps_everything_in_training(spark):
    train, test = embedding.split_triples(graph(spark))
    names = lambda df: {x for r in df.collect() for x in r}
    assert train.count() == 108 and test.count() == 12 and names(test) <= names(train)
    assert train.join(test, ["s", "p", "o"], "left_semi").count() == 0


def test_training_lowers_the_loss(spark):
    triples = graph(spark)
    losses = []
    for rounds in (0, 8):
        entities, relations = embedding.train_translation_model(triples, "TransE", 8, rounds=rounds)
        losses.append(embedding.margin_loss(triples, entities, relations, "TransE").first().loss)
    assert entities.count() == 64 and relations.count() == 2 and losses[1] < 0.7 * losses[0]


def test_best_model_ranks_better_than_chance(spark):
    vectors, table = embedding.best_model(graph(spark), dim=8, rounds=8)
    best = table.where("selected").first()
    assert best.mrr > 0.1 and table.count() == 2 and best.ranked == 24
    assert all(len(r.vec) == 8 for r in vectors.limit(5).collect())


def test_a_failed_model_is_no_result(spark, monkeypatch):
    """One model that fails, or that gives vectors of NaN (which nothing outranks), fails the selection."""
    train = embedding.train_translation_model

    def fails(triples, model, dim, **options):
        if model == "TransE":
            raise ValueError("broken")
        return train(triples, model, dim, **options)

    def no_numbers(triples, model, dim, **options):
        entities, relations = train(triples, model, dim, **options)
        return (entities.withColumn("vec", F.transform("vec", lambda x: x * float("nan"))) if model == "DistMult" else entities), relations

    for broken, name in ((fails, "TransE"), (no_numbers, "DistMult")):
        monkeypatch.setattr(embedding, "train_translation_model", broken)
        with pytest.raises(RuntimeError, match=f"{name} failed"):
            embedding.best_model(graph(spark), dim=4, rounds=1, least_updates=0)


def node_vectors(spark):
    nodes = ["dataset/a", "population-group/age-1/gender-female", "indicator/smoking", "indicator/high-cholesterol", "indicator/age-years"]
    rows = [(V.hr(n), [float(k), float(k + 1)]) for k, n in enumerate(nodes, 1)]
    return spark.createDataFrame(rows, "node string, vec array<double>")


def records(spark):
    columns = {c: None for c, _ in V.CANONICAL_COLUMNS}
    rows = [
        {**columns, "source_dataset": "a", "source_record_id": "1", "age_group_code": 1, "gender": "female", "age_years_proxy": 20.0,
         "smoking_flag": True, "high_cholesterol_flag": True, "target": True},
        {**columns, "source_dataset": "a", "source_record_id": "2", "age_group_code": 9, "gender": "female", "target": False},
        {**columns, "source_dataset": "a", "source_record_id": "3", "age_group_code": 1, "gender": "female", "target": None},
    ]
    schema = ", ".join(f"{c} {k}" for c, k in V.CANONICAL_COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c, _ in V.CANONICAL_COLUMNS) for r in rows], schema)


def test_kg_features(spark):
    rows = features.kg_features(records(spark), node_vectors(spark), 2).collect()
    assert len(rows) == 1  # no vector for the group of record 2, no label on record 3
    d, g = [1.0, 2.0], [2.0, 3.0]
    observed, risk = [(3 + 4 + 5) / 3, (4 + 5 + 6) / 3], [3.5, 4.5]
    assert np.allclose(rows[0].features, d + g + observed + risk + [0.0, 0.0] + [2.0, 6.0] + [1.0, 1.0] + [3.0, 2.0, 0.0])
    assert rows[0].observed_indicator_count == 3


def test_hybrid_features(spark):
    rows = {r.source_record_id: r for r in features.hybrid_features(records(spark), node_vectors(spark), 2).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["2"].kg_group == [0.0, 0.0] and rows["2"].kg_dataset == [1.0, 2.0] and rows["2"].tab_bmi is None
    assert rows["1"].kg_interact == [2.0, 6.0] and rows["1"].tab_smoking_flag == 1.0


def test_lookup_join(spark):
    large = spark.range(2000).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string")
    counts = {how: joins.lookup_join(large, small, "k", how).count() for how in ("inner", "left", "left_semi", "left_anti")}
    assert counts == {"inner": 1334, "left": 2000, "left_semi": 1334, "left_anti": 666}

def test_model_end_to_end(spark, tmp_path):
    """A learnable label: both candidates beat chance, the model survives saving, importance finds the signal."""
    from riskgraph.sources.reports import load_model, save_model

    base = spark.range(600).select(
        F.lit("a").alias("source_dataset"), F.col("id").cast("string").alias("source_record_id"), F.lit(1).alias("record_ordinal"),
        F.when(F.col("id") % 10 != 0, (F.col("id") % 97).cast("double")).alias("age_years_proxy"), (F.col("id") % 13).cast("double").alias("bmi"),
        *[((F.col("id") % k) == 0).alias(c) for k, c in enumerate(V.CORE_CATEGORICAL, 2)],
        ((F.col("id") % 97) + (F.col("id") % 5) > 50).alias("target"))
    light = (models.Candidate("lr", "logistic", {"maxIter": 50}), models.Candidate("rf", "forest", {"numTrees": 5, "maxDepth": 4}))
    trained = models.train_core(base, candidates=light, folds=2)
    row = trained.report.first()
    assert row.rows_train == 480 and row.rows_test == 120 and row.roc_auc > 0.85
    assert trained.selected.scores.count() == 2 and trained.selected.scores.where("selected").count() == 1
    top = models.feature_importance(trained.selected.model, trained.selected.names).first()
    assert top.feature == "num__age_years_proxy"
    path = str(tmp_path / "model")
    save_model(trained.selected.model, path)
    frame = features.model_frame(base, V.CORE_NUMERIC, V.CORE_CATEGORICAL)
    again = {r.source_record_id: r.p for r in models.score(load_model(path), frame).collect()}
    first = {r.source_record_id: r.p for r in models.score(trained.selected.model, frame).collect()}
    assert again == first


def test_orthonormal_columns_of_an_ill_conditioned_block(spark):
    import numpy as np
    draw = np.random.default_rng(3)
    rows = draw.normal(size=(300, 6)) @ np.diag([1, 1e-3, 1e-6, 1e-9, 1e-10, 0]) @ np.linalg.qr(draw.normal(size=(6, 6)))[0]
    block = spark.createDataFrame([(f"n{i}", r.tolist()) for i, r in enumerate(rows)], "node string, vec array<double>").repartition(40)
    q = np.stack([r.vec for r in embedding._orthonormal(block).orderBy("node").collect()])
    kept = np.linalg.norm(q, axis=0) > 0.5
    assert kept.sum() == 5 and np.abs(q[:, kept].T @ q[:, kept] - np.eye(5)).max() < 1e-10


def test_kg_features_derived_once_a_signature(spark):
    """What follows from the vector comes in its place, from as many vectors as there are signatures, not records."""
    whole = features.kg_features(records(spark), node_vectors(spark), 2)
    told = features.kg_features(records(spark), node_vectors(spark), 2, [F.size("features").alias("width"), F.get("features", F.lit(0)).alias("first")])
    assert "features" not in told.columns
    key = ("source_dataset", "source_record_id")
    want = sorted(((*(r[k] for k in key), len(r.features), r.features[0]) for r in whole.collect()), key=str)
    assert sorted(((*(r[k] for k in key), r.width, r["first"]) for r in told.collect()), key=str) == want
    assert "features" not in told._jdf.queryExecution().optimizedPlan().toString()
