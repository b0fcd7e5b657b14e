import pytest
from pyspark.sql import functions as F

from riskgraph.functions import iri, standardise as st
from riskgraph.functions.names import normalize_name, normalize_names
from riskgraph.functions.predicates import not_below, optional_range, required_domain, required_present, required_range
from riskgraph.operators.formatting import format_dataset, split_single_column


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_names():
    assert normalize_name("  Heart Disease--or__Attack! ") == "heart_disease_or_attack"
    assert normalize_names(["a", "A ", "", "!!", "a"]) == ["a", "a_2", "column", "column_2", "a_3"]


def test_parse_binary(spark):
    words = ["YES", " y ", "2", "", "0.0", "no", None, "1"]
    assert column(spark, words, "string", st.parse_binary) == [True, True, None, None, False, False, None, True]


def test_parse_binary_or_positive(spark):
    words = ["3", "0", "-1", "yes", "n", "x", None, "0.5"]
    assert column(spark, words, "string", st.parse_binary_or_positive) == [True, False, None, True, False, None, None, True]


def test_age_bands(spark):
    ages = [24, 25, 29, 30, 79, 80, 150, 0, None]
    assert column(spark, ages, "int", st.age_band_of_years) == [1, 2, 2, 3, 12, 13, 13, 1, None]
    labels = ["18 to 24", "2.0", "80 OR OLDER", "99", "1.5", None, " 75 to 79 "]
    assert column(spark, labels, "string", st.age_band_of_label) == [1, 2, 13, 99, None, None, 12]
    assert column(spark, [1, 2, 13, 14, None], "int", st.age_band_midpoint) == [21.0, 27.0, 82.0, None, None]


def test_numbers(spark):
    assert column(spark, ["12.7", "NaN", "abc", "-0.5", None, "1e30"], "string", st.to_int) == [12, None, None, 0, None, None]
    assert column(spark, ["18393", "6574", "6575"], "string", st.days_to_years) == [50, 17, 18]
    bmi = column(spark, [170.0, 0.0, None], "double", lambda h: F.round(st.body_mass_index(F.lit(68.0), h), 3))
    assert bmi == [23.529, None, None]


def test_slug_and_iris(spark):
    texts = ["  Heart & Disease ", "---", "", None, "a__b"]
    assert column(spark, texts, "string", iri.slug) == ["heart-disease", "unknown", "unknown", "unknown", "a-b"]
    outcome = column(spark, [True, False, None], "boolean", iri.outcome_iri)
    assert [o.rsplit("/", 1)[1] for o in outcome] == ["heart-disease-positive", "heart-disease-negative", "unknown"]
    text = column(spark, [0.0001, 1.0, 1e7, 0.408163], "double", iri.double_text)
    assert text == ["0.000100", "1.000000", "10000000.000000", "0.408163"]


@pytest.mark.parametrize("value,required,optional", [
    (18, True, True), (100, True, True), (17, False, False), (101, False, False), (None, False, True)])
def test_ranges(spark, value, required, optional):
    df = spark.createDataFrame([(value,)], "v int")
    row = df.select(required_range("v", 18, 100), optional_range("v", 18, 100), required_present("v")).first()
    assert tuple(row) == (required, optional, value is not None)


def test_domain_and_order(spark):
    df = spark.createDataFrame([(1, 2), (4, 4), (None, 1), (3, None)], "a int, b int")
    rows = df.select(required_domain("a", (1, 2, 3)), not_below("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(True, False), (False, True), (False, False), (True, False)]


@pytest.mark.parametrize("mark", [";", ","])
def test_split_single_column(spark, mark):
    header = mark.join(["id", "Age", "Cardio"])
    df = spark.createDataFrame([(mark.join(["1", " 40", "0"]),), (mark.join(["2", "50"]),)], f"`{header}` string")
    rows = split_single_column(df, ["id", "age", "cardio"]).collect()
    assert [tuple(r) for r in rows] == [("1", "40", "0"), ("2", "50", None)]
    assert split_single_column(df, ["id", "age"]).columns == [header]


def test_format_adds_lineage(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "`Row Id` int, `A-b` string")
    out = format_dataset(df, "demo", "ts")
    assert out.columns == ["row_id", "a_b", "_source_dataset", "_formatted_record_id", "_formatted_at_utc"]
    ids = [r._formatted_record_id for r in out.orderBy("row_id").collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64
