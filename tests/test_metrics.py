import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as hs
from pyspark.sql import functions as F

from riskgraph.operators import comparison, features, metrics, sampling
from riskgraph.operators.ranking import exact_medians, hash_rank, running_sums


def brute(rows):
    """Metrics straight from their definitions."""
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    auc = ap = None
    if pos and neg:
        auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
        ap, last = 0.0, 0.0
        for cut in sorted({p for _, p in rows}, reverse=True):
            tp, fp = sum(p >= cut for p in pos), sum(p >= cut for p in neg)
            ap += (tp / len(pos) - last) * tp / (tp + fp)
            last = tp / len(pos)
    best, at = -1.0, 0.5
    for cut in sorted({p for _, p in rows}):
        tp, fp = sum(p >= cut for p in pos), sum(p >= cut for p in neg)
        precision, recall = tp / (tp + fp), (tp / len(pos) if pos else 1.0)
        f1 = 2 * precision * recall / (precision + recall + 1e-12)
        if f1 > best:
            best, at = f1, cut
    return auc, ap, at


def check(spark, rows):
    df = spark.createDataFrame(rows, "y int, p double")
    auc, ap, at = brute(rows)
    got = metrics.classification_metrics(df, at).first()
    assert metrics.f1_threshold(df).first()[0] == at
    for mine, theirs in ((got.roc_auc, auc), (got.pr_auc, ap)):
        assert (mine is None) == (theirs is None) and (mine is None or math.isclose(mine, theirs, abs_tol=1e-12))
    tp = sum(y == 1 and p >= at for y, p in rows)
    assert got.confusion_matrix[1][1] == tp
    single = metrics.point_metrics(metrics.confusion(df.withColumn("pred", (F.col("p") >= at).cast("int")))).first()
    assert single.f1 == got.f1 and single.accuracy == got.accuracy


@pytest.mark.parametrize("rows", [
    [(0, 0.5), (1, 0.5), (0, 0.5)], [(1, 0.2), (1, 0.9)], [(0, 0.2), (0, 0.9)], [(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.8)]])
def test_small_cases(spark, rows):
    check(spark, rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.tuples(hs.integers(0, 1), hs.integers(0, 12).map(lambda k: k / 12)), min_size=1, max_size=40))
def test_random_cases(spark, rows):
    check(spark, rows)


def test_empty_threshold(spark):
    assert metrics.f1_threshold(spark.createDataFrame([], "y int, p double")).first()[0] == 0.5


def test_auc_is_rank_invariant(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, p double")
    moved = df.withColumn("p", F.exp(F.col("p") * 3))
    assert metrics.roc_auc(df).first()[0] == metrics.roc_auc(moved).first()[0]


def test_running_sums_with_skewed_order(spark):
    values = sorted({i**4 for i in range(400)} | {-1, -2})
    df = spark.createDataFrame([(float(v), 1) for v in values], "v double, n int")
    rows = running_sums(df, "v", ["n"], buckets=16).orderBy("v").collect()
    assert [r.cum_n for r in rows] == list(range(1, len(values) + 1))


@pytest.mark.parametrize("values,median", [([3.0, 1.0, 2.0], 2.0), ([1.0, 2.0, 3.0, 10.0], 2.5), ([5.0] * 9 + [1.0], 5.0)])
def test_medians(spark, values, median):
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None)], "a double, b double")
    assert {r.feature: r.median for r in exact_medians(df, ["a", "b"]).collect()} == {"a": median}


def test_hash_rank_is_a_permutation(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("s"))
    ranks = hash_rank(df, ["s"], F.col("id"), 1, hex_digits=2).groupBy("s").agg(
        F.count("*").alias("n"), F.countDistinct("_rank").alias("d"), F.max("_rank").alias("hi"), F.max("_size").alias("size"))
    assert all(r.n == r.d == r.hi == r["size"] for r in ranks.collect())


def test_sample_quotas(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 3, "tiny").otherwise(F.when(F.col("id") < 800, "a").otherwise("b")).alias("s"))
    got = {r.s: r.n for r in sampling.stratified_sample(df, ["s"], F.col("id"), 100).groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert got == {"tiny": 1, "a": 80, "b": 20}
    assert sampling.stratified_sample(df, ["s"], F.col("id"), 100, trim=True).count() == 100
    assert sampling.stratified_sample(df, ["s"], F.col("id"), 1000).count() == 1000


def test_split_and_folds(spark):
    df = spark.range(300).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    split = sampling.stratified_split(df, "y", F.col("id"))
    assert {(r.y, r.n) for r in split.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()} == {(0, 40), (1, 20)}
    folds = sampling.stratified_folds(df, "y", F.col("id"), 3).groupBy("y", "fold").count().collect()
    assert {(r.y, r["count"]) for r in folds} == {(0, 67), (0, 66), (1, 34), (1, 33)} and len(folds) == 6


def test_class_guards(spark):
    assert sampling.fold_count({0: 10, 1: 2}) == 2 and sampling.fold_count({0: 10, 1: 1}) == 0
    assert sampling.require_two_classes({0: 5, 1: 1}) is False
    with pytest.raises(ValueError):
        sampling.require_two_classes({0: 5})
    weights = sampling.class_weights(spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int"), "y").collect()
    assert {r.y: r.weight for r in weights} == {0: 4 / 6, 1: 2.0}


def test_preprocessing_stage(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "it's"), (5.0, None)], "x double, c string")
    stats = features.fit_stats(train, ["x"], ["c"])
    stage, names = features.preprocessing(stats, ["x"], ["c"])
    out = stage.transform(spark.createDataFrame([(None, "new"), (3.0, None), (3.0, "it's")], "x double, c string")).select(*names).collect()
    assert [tuple(r) for r in out] == [(0.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)]


def report(spark, name, f1, auc):
    return spark.createDataFrame(
        [(name, "m", 0.8, 0.5, 0.5, f1, auc, 0.4)],
        "pipeline string, selected_model string, accuracy double, precision double, recall double, f1 double, roc_auc double, pr_auc double")


def test_comparison(spark):
    table = comparison.comparison_table(
        [report(spark, "tabular_core", 0.5, 0.7), None, report(spark, "tabular_enriched", 0.6, 0.8), report(spark, "kg_embedding", 0.55, None)])
    assert table.count() == 3
    best = {r.metric: r.best_pipeline for r in comparison.best_per_metric(table, ["tabular_enriched", "tabular_core"]).collect()}
    assert best["f1"] == "tabular_enriched" and best["accuracy"] == "tabular_enriched" and best["roc_auc"] == "tabular_enriched"
    deltas = {r.metric: r for r in comparison.deltas_vs_tabular(table).collect()}
    assert deltas["f1"].delta == -0.05 and deltas["f1"].kg_wins is False and "roc_auc" not in deltas
    summary = comparison.run_summary("ts", [table, None], ["a"]).first()
    assert len(summary.pipelines) == 3
