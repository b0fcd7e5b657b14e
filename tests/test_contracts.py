import pytest
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.operators import catalogue as cat
from riskgraph.operators.contracts import evaluate, missing_sources, require_sources, union_quarantine
from riskgraph.operators.ranking import first_of_key, ordinal_in_key
from riskgraph.plans import zones
from tests import fixtures


@pytest.fixture(scope="module")
def checked(spark):
    frames = zones.formatted(fixtures.raw(spark), "ts")
    out = {}
    for name, df in frames.items():
        standardise, contract, _ = cat.SOURCES[name]
        out[name] = evaluate(standardise(df), contract, "run", "ts")
    return out


def violations(e):
    return {r.rule_name: r.violations for r in e.metrics().collect()}


def test_rule_counts():
    assert [len(c.outcomes) for _, c, _ in cat.SOURCES.values()] == [17, 17, 17]


def test_cardio(checked):
    e = checked[V.CARDIO]
    assert sorted(r.patient_id for r in e.clean().collect()) == ["1", "2", "3", "7"]
    reasons = {}
    for r in e.quarantine().collect():
        reasons.setdefault(r.record_key, []).append(r.quarantine_reason)
    assert reasons["5"] == ["age_out_of_range;gender_invalid;cholesterol_domain_invalid"]
    assert reasons["4"] == ["bp_order_invalid"]
    assert reasons["6"] == ["height_out_of_range;bmi_out_of_range"]
    assert reasons["3"] == ["duplicate_patient_id"] * 2
    assert sorted(reasons[None]) == ["missing_patient_id", "missing_patient_id;duplicate_patient_id"]
    assert reasons["8"] == ["height_out_of_range;systolic_bp_out_of_range"]
    v = violations(e)
    assert v["patient_id_unique"] == 3 and v["patient_id_present"] == 2 and v["rows_quarantined_total"] == 8
    assert e.clean().columns[:7] == ["patient_id", "age_years", "age_group_code", "gender", "height_cm", "weight_kg", "bmi"]


def test_cdc_keeps_copies(checked):
    e = checked[V.CDC]
    clean = e.clean()
    assert clean.count() == 6 and clean.select("respondent_id").distinct().count() == 5
    reasons = sorted(r.quarantine_reason for r in e.quarantine().collect())
    assert reasons == [
        "age_group_invalid;age_proxy_invalid", "gender_invalid;bmi_out_of_range;missing_smoking_flag",
        "mental_health_days_invalid"]
    assert len(e.columns) == 23


def test_cleveland(checked):
    e = checked[V.CLEVELAND]
    assert e.clean().count() == 4 and len(e.columns) == 16
    reasons = sorted(r.quarantine_reason for r in e.quarantine().collect())
    assert reasons == ["duplicate_record_key", "num_major_vessels_invalid;missing_target"]


def test_partition_of_rows(checked):
    for e in checked.values():
        total = e.frame.count()
        assert e.clean().count() + e.quarantine().count() == total
        rows = e.metrics().collect()
        assert all(r.total_rows == total and 0 <= r.violations <= total for r in rows)
        assert rows[-1].rule_name == "rows_quarantined_total"


def test_missing_source_columns_violate(spark):
    df = spark.createDataFrame([(1,)], "id int")
    e = evaluate(cat.standardise_cardio(df), cat.CARDIO_CONTRACT, "run", "ts")
    assert e.clean().count() == 0
    assert violations(e)["target_present"] == 1


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int")
    e = evaluate(cat.standardise_cardio(df), cat.CARDIO_CONTRACT, "run", "ts")
    assert {r.violation_pct for r in e.metrics().collect()} == {0.0}
    assert union_quarantine(spark, []).count() == 0


def test_required_sources(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "source_dataset string")
    assert [r[0] for r in missing_sources(df, ["a", "b", "c"]).collect()] == ["c"]
    require_sources(df, ["a", "b"])
    with pytest.raises(ValueError):
        require_sources(df, ["c"])


def test_first_of_hot_key(spark):
    """A key that holds most rows, spread over many partitions, keeps exactly one row: the smallest."""
    df = spark.range(0, 5000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot")).otherwise(
            F.col("id").cast("string")).alias("k"), (F.col("id") % 50).alias("v"))
    kept = first_of_key(df, ["k"], ["v"], "first").where("first").groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    rows = {r.k: (r.n, r.v) for r in kept.collect()}
    least = {r.k: r.v for r in df.groupBy("k").agg(F.min("v").alias("v")).collect()}
    assert rows == {k: (1, v) for k, v in least.items()}


def test_ordinals_are_dense(spark):
    df = spark.range(0, 3000, numPartitions=12).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), F.lit(1).alias("v"))
    out = ordinal_in_key(df, ["k"], ["v"], "n").groupBy("k").agg(
        F.count("*").alias("rows"), F.countDistinct("n").alias("d"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    assert all(r.rows == r.d == r.hi and r.lo == 1 for r in out.collect())


def test_hot_keys_stay_spread(spark):
    """With automatic broadcasts off, a key with a third of all rows, and copies of the least row, are no large task."""
    df = spark.range(0, 60000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 9000).cast("string")).alias("k"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("v"), F.array(F.lit("same")).alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = first_of_key(df, ["k"], ["v"], "first")
        sizes = sorted(r["count"] for r in flagged.groupBy(F.spark_partition_id().alias("p")).count().collect())
        kept = {r.k: (r.n, r.v, r.all) for r in flagged.groupBy("k").agg(
            F.count_if("first").alias("n"), F.min(F.when(F.col("first"), F.coalesce("v", F.lit(-1)))).alias("v"), F.count("*").alias("all")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    least = {r.k: (1, r.v, r.all) for r in df.groupBy("k").agg(F.min(F.coalesce("v", F.lit(-1))).alias("v"), F.count("*").alias("all")).collect()}
    assert kept == least and sizes[-1] <= 3 * max(1, sizes[len(sizes) // 2])


@pytest.mark.parametrize("name", list(cat.SOURCES))
def test_one_write_gives_all_outputs(spark, checked, name):
    e = checked[name]
    split = e.split()
    assert {tuple(r) for r in split.metrics().collect()} == {tuple(r) for r in e.metrics().collect()}
    assert sorted(map(str, split.clean().collect())) == sorted(map(str, e.clean().collect()))
    assert sorted(map(str, split.quarantine().collect())) == sorted(map(str, e.quarantine().collect()))
    assert split.clean().columns == e.clean().columns
    plan = split.clean()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(_is_clean" in plan


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], zones.formatted(fixtures.raw(spark), "ts")[V.CARDIO].schema)
    split = evaluate(cat.standardise_cardio(df), cat.CARDIO_CONTRACT, "run", "ts").split()
    assert split.clean().count() == split.quarantine().count() == 0 and {r.total_rows for r in split.metrics().collect()} == {0}


def test_clean_rows_are_a_compiled_filter(spark):
    """No array of flags and no lambda over it is left in the filter of the clean rows, which keeps the same rows."""
    from pyspark.sql import functions as F
    from riskgraph.operators.contracts import Contract, Rule, evaluate

    rows = spark.range(10).select(F.col("id").cast("string").alias("key"), F.col("id").alias("n"))
    contract = Contract("d", "key", (Rule("a", "low", lambda: F.col("n") > 2), Rule("b", "odd", lambda: F.col("n") % 2 == 0)), ("u", "twice"))
    found = evaluate(rows, contract, "r", "t")
    plan = found.clean()._jdf.queryExecution().optimizedPlan().toString()
    assert "forall" not in plan and "array" not in plan
    assert [r.n for r in found.clean().orderBy("n").collect()] == [4, 6, 8]
    assert found.quarantine().count() == 7
    assert evaluate(rows, Contract("d", "key", ()), "r", "t").clean().count() == 10


def test_events_parse_their_text_once(spark):
    """The rules filter on what derives from the JSON text; it is parsed in one place of the plan."""
    from pyspark.sql import functions as F
    from riskgraph.operators.contracts import evaluate
    from riskgraph.plans.bindings import EVENTS_CONTRACT, events_from

    events = spark.range(40).select(
        F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.lit(50.0).alias("value"),
        F.concat(F.lit('{"k": '), F.col("id").cast("string"), F.lit("}")).alias("props"))
    clean = evaluate(events_from(events), EVENTS_CONTRACT, "r", "t").clean()
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1
    assert clean.count() == 36  # bands 14 and 15 have no midpoint
    assert evaluate(events_from(events.withColumn("props", F.lit("?"))), EVENTS_CONTRACT, "r", "t").quarantine().count() == 40


def test_batches_rank_their_rows_once(spark):
    """Rows of a batch are ranked within their key once, then read for the first ones and for the others."""
    from pyspark.sql import functions as F
    from riskgraph.operators.contracts import Contract, evaluate

    rows = spark.range(12).select((F.col("id") % 4).cast("string").alias("key"), F.col("id").alias("n"))
    fresh = spark.createDataFrame([("0",), ("1",)], "key string")
    found = evaluate(rows, Contract("d", "key", (), ("u", "twice")), "r", "t", fresh).clean()
    assert "row_number" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.key, r.n) for r in found.collect()) == [("0", 0), ("1", 1)]
