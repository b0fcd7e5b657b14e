"""The three roles bound to the star-schema tables: orders with customer, lineitem, events."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.functions import standardise as st
from riskgraph.operators import catalogue as cat
from riskgraph.operators.contracts import Contract, Evaluated, evaluate
from riskgraph.operators.entailment import materialise
from riskgraph.operators.harmonise import to_canonical, union_canonical
from riskgraph.operators.lineage import cut
from riskgraph.operators.triples import record_triples, schema_triples, vocabulary_triples
from riskgraph.plans import zones

RUN_ID = "run-fixed"
RUN_TS = "2026-01-01T00:00:00+00:00"

ORDERS_CONTRACT = Contract("orders", "record_key", (
    cat.present("record_key_present", "missing_record_key", "record_key"),
    *cat.AGE_RULES,
    cat.GENDER_RULE,
    cat.within("systolic_bp_between_70_250", "systolic_bp_out_of_range", "systolic_bp", 70, 250),
    cat.within("diastolic_bp_between_40_150", "diastolic_bp_out_of_range", "diastolic_bp", 40, 150),
    cat.ordered("systolic_bp_gte_diastolic_bp", "bp_order_invalid", "systolic_bp", "diastolic_bp"),
    cat.one_of("priority_domain_1_5", "priority_domain_invalid", "priority_level", (1, 2, 3, 4, 5)),
    cat.present("target_present", "missing_target", "has_condition"),
), ("record_key_unique", "duplicate_record_key"))

LINEITEM_CONTRACT = Contract("lineitem", "record_key", (
    cat.present("record_key_present", "missing_record_key", "record_key"),
    *cat.AGE_RULES,
    cat.GENDER_RULE,
    cat.within("resting_bp_between_70_250", "resting_bp_out_of_range", "resting_bp", 70, 250),
    cat.present("target_present", "missing_target", "has_condition"),
), ("record_key_unique", "duplicate_record_key"))

EVENTS_CONTRACT = Contract("events", "record_key", (
    cat.present("record_key_present", "missing_record_key", "record_key"),
    cat.AGE_RULES[1],
    cat.within("age_years_proxy_between_18_90", "age_proxy_invalid", "age_years_proxy", 18, 90),
    cat.GENDER_RULE,
    cat.within_or_null("bmi_between_0_100_or_null", "bmi_invalid", "bmi", 0, 100),
    cat.present("target_present", "missing_target", "has_condition"),
))

FIELDS = {
    "orders": {
        "source_record_id": "record_key", "age_years_proxy": "age_years", "age_group_code": "age_group_code",
        "gender": "gender", "systolic_bp": "systolic_bp", "diastolic_bp": "diastolic_bp",
        "high_blood_pressure_flag": "systolic_bp >= 130 OR diastolic_bp >= 80",
        "high_cholesterol_flag": "priority_level <= 3", "glucose_risk_flag": "high_price", "target": "has_condition",
    },
    "lineitem": {
        "source_record_id": "record_key", "age_years_proxy": "age_years", "age_group_code": "age_group_code",
        "gender": "gender", "systolic_bp": "resting_bp", "high_blood_pressure_flag": "resting_bp >= 130",
        "high_cholesterol_flag": "high_discount", "glucose_risk_flag": "high_tax", "target": "has_condition",
    },
    "events": {
        "source_record_id": "record_key",
        **{c: c for c in (
            "age_years_proxy", "age_group_code", "gender", "bmi", "high_blood_pressure_flag", "high_cholesterol_flag",
            "smoking_flag", "physical_activity_flag", "heavy_alcohol_flag",
        )},
        "target": "has_condition",
    },
}
UNIQUE_SOURCES = ("orders", "lineitem")


def events_from(events: DataFrame) -> DataFrame:
    """Row-local standardisation of events, for batch and stream alike.

    The number in the JSON text is generated as a column: rules that filter on what derives from it would else be
    pushed below it and parse the text once for each mention.
    """
    band = F.col("k") % 15 + 1
    kinds = st.parse_gender(F.col("event_type"), ("view", "click"), ("signup", "purchase"))
    parsed = F.explode(F.array(st.to_int(F.get_json_object("props", "$.k"))))
    return events.select("*", parsed.alias("k")).select(
        F.col("event_id").cast("string").alias("record_key"),
        band.alias("age_group_code"),
        st.age_band_midpoint(band).alias("age_years_proxy"),
        kinds.alias("gender"),
        (F.col("value") / 5.0).alias("bmi"),
        (F.col("user_id") % 2 == 1).alias("high_blood_pressure_flag"),
        (F.col("value") >= 50).alias("high_cholesterol_flag"),
        (F.col("k") >= 50).alias("smoking_flag"),
        (F.col("user_id") % 3 == 0).alias("physical_activity_flag"),
        (F.col("k") % 7 == 0).alias("heavy_alcohol_flag"),
        (F.col("value") >= 100).alias("has_condition"),
    )


def lineitem_from(lines: DataFrame, key: Column) -> DataFrame:
    """Row-local standardisation of order lines under the given record key, for batch and stream alike."""
    return lines.select(
        key.alias("record_key"),
        F.floor(F.col("l_quantity") * 2).try_cast("int").alias("age_years"),
        st.parse_gender(F.col("l_linestatus"), ("f",), ("o",)).alias("gender"),
        (F.col("l_quantity") * 4 + 60).alias("resting_bp"),
        (F.col("l_discount") >= 0.05).alias("high_discount"),
        (F.col("l_tax") >= 0.04).alias("high_tax"),
        (F.col("l_returnflag") == "R").alias("has_condition"),
    ).withColumn("age_group_code", st.age_band_of_years(F.col("age_years")))


@dataclass(frozen=True)
class Tables:
    """One folder of Parquet tables. Every property is a lazy plan over whole tables."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders_standard(self) -> DataFrame:
        customer = self.read("customer").select("c_custkey", "c_acctbal")
        joined = self.read("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        level = st.to_int(F.substring("o_orderpriority", 1, 1))
        return joined.select(
            F.col("o_orderkey").cast("string").alias("record_key"),
            F.floor(F.col("o_totalprice") / 5000.0).try_cast("int").alias("age_years"),
            st.parse_gender(F.col("o_orderstatus"), ("f",), ("o",)).alias("gender"),
            (F.col("o_totalprice") / 2000.0).alias("systolic_bp"),
            (F.col("c_acctbal") / 60.0).alias("diastolic_bp"),
            level.alias("priority_level"),
            (F.col("o_totalprice") >= 250000).alias("high_price"),
            (level <= 2).alias("has_condition"),
        ).withColumn("age_group_code", st.age_band_of_years(F.col("age_years")))

    @cached_property
    def lineitem_standard(self) -> DataFrame:
        key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        return lineitem_from(self.read("lineitem"), key)

    @cached_property
    def events_standard(self) -> DataFrame:
        return events_from(self.read("events"))

    @cached_property
    def evaluated(self) -> dict[str, Evaluated]:
        bound = (
            (self.orders_standard, ORDERS_CONTRACT), (self.lineitem_standard, LINEITEM_CONTRACT),
            (self.events_standard, EVENTS_CONTRACT),
        )
        return {c.dataset: evaluate(df, c, RUN_ID, RUN_TS) for df, c in bound}

    @cached_property
    def trusted(self) -> zones.Trusted:
        return zones.assemble_trusted(list(self.evaluated.values()))

    fields = FIELDS

    @cached_property
    def canonical(self) -> DataFrame:
        """Lazy canonical union, for plans that read it once."""
        return union_canonical([
            to_canonical(e.clean(), name, RUN_ID, RUN_TS, FIELDS[name]) for name, e in self.evaluated.items()])

    @cached_property
    def zone(self) -> zones.Exploitation:
        """The canonical table written once, for plans that read it several times."""
        clean = {name: e.clean() for name, e in self.evaluated.items()}
        return zones.exploitation(clean, RUN_ID, RUN_TS, FIELDS, UNIQUE_SOURCES)

    @cached_property
    def records(self) -> DataFrame:
        """Numbered records for plans that read them several times: columns of written tables."""
        return self.zone.records

    @cached_property
    def schema(self) -> DataFrame:
        return schema_triples(self.spark)

    @cached_property
    def full(self) -> DataFrame:
        return zones.full_graph(self.zone, RUN_ID, RUN_TS)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return vocabulary_triples(self.spark)

    def record_graph(self, *names: str) -> DataFrame:
        """Record triples of the named predicates and the record type: all that a record pattern reads."""
        return record_triples(self.zone.records, {V.RDF_TYPE, *map(V.hr, names)})

    @cached_property
    def analytics(self) -> DataFrame:
        return zones.analytics_graph(self.zone, RUN_ID, RUN_TS)

    @cached_property
    def analytics_entailed(self) -> DataFrame:
        return cut(materialise(self.analytics, self.schema))
