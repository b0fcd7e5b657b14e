"""The three source contracts and the source-to-standard projections, held as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgraph import vocabulary as V
from riskgraph.functions import standardise as st
from riskgraph.functions.predicates import not_below, optional_range, required_domain, required_present, required_range
from riskgraph.operators.contracts import Contract, Rule

# --- fixed values: gender codes per source --------------------------------------------------------
CARDIO_FEMALE, CARDIO_MALE = ("1", "1.0", "female", "f"), ("2", "2.0", "male", "m")
ZERO_ONE_FEMALE, ZERO_ONE_MALE = ("0", "0.0", "female", "f"), ("1", "1.0", "male", "m")

# --- fixed values: expected header of the cardio snapshot -----------------------------------------
CARDIO_HEADER = (
    "id", "age", "gender", "height", "weight", "ap_hi", "ap_lo", "cholesterol", "gluc", "smoke", "alco", "active",
    "cardio",
)

# Standard columns in output order: (name, raw column, parser). A parser that is None copies text.
Parser = Callable[[Column], Column]
Spec = tuple[tuple[str, str, Parser | None], ...]


def _gender(female: tuple[str, ...], male: tuple[str, ...]) -> Parser:
    return lambda col: st.parse_gender(col, female, male)


CARDIO_SPEC: Spec = (
    ("patient_id", "id", None),
    ("age_years", "age", st.days_to_years),
    ("gender", "gender", _gender(CARDIO_FEMALE, CARDIO_MALE)),
    ("height_cm", "height", st.to_double),
    ("weight_kg", "weight", st.to_double),
    ("systolic_bp", "ap_hi", st.to_double),
    ("diastolic_bp", "ap_lo", st.to_double),
    ("cholesterol_level", "cholesterol", st.to_int),
    ("glucose_level", "gluc", st.to_int),
    ("is_smoker", "smoke", st.parse_binary),
    ("drinks_alcohol", "alco", st.parse_binary),
    ("is_active", "active", st.parse_binary),
    ("has_cardiovascular_disease", "cardio", st.parse_binary),
)
CDC_SPEC: Spec = (
    ("age_group_code", "age", st.age_band_of_label),
    ("gender", "sex", _gender(ZERO_ONE_FEMALE, ZERO_ONE_MALE)),
    ("bmi", "bmi", st.to_double),
    ("high_blood_pressure_flag", "highbp", st.parse_binary),
    ("high_cholesterol_flag", "highchol", st.parse_binary),
    ("chol_check_recent_flag", "cholcheck", st.parse_binary),
    ("smoking_flag", "smoker", st.parse_binary),
    ("stroke_history_flag", "stroke", st.parse_binary),
    ("physical_activity_flag", "physactivity", st.parse_binary),
    ("fruits_daily_flag", "fruits", st.parse_binary),
    ("veggies_daily_flag", "veggies", st.parse_binary),
    ("heavy_alcohol_flag", "hvyalcoholconsump", st.parse_binary),
    ("any_healthcare_flag", "anyhealthcare", st.parse_binary),
    ("no_doctor_cost_flag", "nodocbccost", st.parse_binary),
    ("general_health_score", "genhlth", st.to_int),
    ("mental_unhealthy_days", "menthlth", st.to_double),
    ("physical_unhealthy_days", "physhlth", st.to_double),
    ("difficulty_walking_flag", "diffwalk", st.parse_binary),
    ("education_level", "education", st.to_int),
    ("income_level", "income", st.to_int),
    ("has_heart_disease", "heartdiseaseorattack", st.parse_binary),
)
CLEVELAND_SPEC: Spec = (
    ("age_years", "age", st.to_int),
    ("gender", "sex", _gender(ZERO_ONE_FEMALE, ZERO_ONE_MALE)),
    ("chest_pain_type", "cp", st.to_int),
    ("resting_bp", "trestbps", st.to_double),
    ("serum_cholesterol", "chol", st.to_double),
    ("fasting_blood_sugar_high", "fbs", st.parse_binary),
    ("resting_ecg", "restecg", st.to_int),
    ("max_heart_rate", "thalach", st.to_double),
    ("exercise_induced_angina", "exang", st.parse_binary),
    ("st_depression", "oldpeak", st.to_double),
    ("st_slope", "slope", st.to_int),
    ("num_major_vessels", "ca", st.to_int),
    ("thalassemia_type", "thal", st.to_int),
    ("has_heart_disease", "condition", st.parse_binary_or_positive),
)

# Derived standard columns: (name, position in the output, builder over the parsed columns).
CARDIO_DERIVED = (
    ("age_group_code", 2, lambda: st.age_band_of_years(F.col("age_years"))),
    ("bmi", 6, lambda: st.body_mass_index(F.col("weight_kg"), F.col("height_cm"))),
)
CDC_DERIVED = (("age_years_proxy", 2, lambda: st.age_band_midpoint(F.col("age_group_code"))),)
CLEVELAND_DERIVED = (("age_group_code", 2, lambda: st.age_band_of_years(F.col("age_years"))),)


def _standardise(df_raw: DataFrame, spec: Spec, derived, key: tuple[str, Column] | None = None) -> DataFrame:
    parsed = [] if key is None else [key[1].alias(key[0])]
    for name, raw, parser in spec:
        source = st.optional_column(df_raw, raw)
        parsed.append((parser(source) if parser else source.cast("string")).alias(name))
    order = ([] if key is None else [key[0]]) + [name for name, _, _ in spec]
    for name, position, _ in derived:
        order.insert(position, name)
    return df_raw.select(*parsed).withColumns({name: build() for name, _, build in derived}).select(*order)


def _formatted_key(df_raw: DataFrame, prefix: str) -> Column:
    return F.coalesce(
        st.optional_column(df_raw, "_formatted_record_id").cast("string"), st.stable_record_key(df_raw, prefix)
    )


def standardise_cardio(df_raw: DataFrame) -> DataFrame:
    return _standardise(df_raw, CARDIO_SPEC, CARDIO_DERIVED)


def standardise_cdc(df_raw: DataFrame) -> DataFrame:
    return _standardise(df_raw, CDC_SPEC, CDC_DERIVED, ("respondent_id", _formatted_key(df_raw, "cdc")))


def standardise_cleveland(df_raw: DataFrame) -> DataFrame:
    key = ("record_key", _formatted_key(df_raw, "cleveland"))
    return _standardise(df_raw, CLEVELAND_SPEC, CLEVELAND_DERIVED, key)


def present(name: str, reason: str, column: str) -> Rule:
    return Rule(name, reason, lambda: required_present(column))


def within(name: str, reason: str, column: str, low: float, high: float) -> Rule:
    return Rule(name, reason, lambda: required_range(column, low, high))


def within_or_null(name: str, reason: str, column: str, low: float, high: float) -> Rule:
    return Rule(name, reason, lambda: optional_range(column, low, high))


def one_of(name: str, reason: str, column: str, values: tuple) -> Rule:
    return Rule(name, reason, lambda: required_domain(column, values))


def ordered(name: str, reason: str, upper: str, lower: str) -> Rule:
    return Rule(name, reason, lambda: not_below(upper, lower))


AGE_RULES = (
    within("age_years_between_18_100", "age_out_of_range", "age_years", 18, 100),
    within("age_group_code_between_1_13", "age_group_invalid", "age_group_code", 1, 13),
)
GENDER_RULE = one_of("gender_domain_male_female", "gender_invalid", "gender", ("female", "male"))

# --- fixed values: rule names, reason codes and bounds of the three contracts -----------------------
CARDIO_CONTRACT = Contract(V.CARDIO, "patient_id", (
    present("patient_id_present", "missing_patient_id", "patient_id"),
    *AGE_RULES,
    GENDER_RULE,
    within("height_cm_between_120_250", "height_out_of_range", "height_cm", 120, 250),
    within("weight_kg_between_30_300", "weight_out_of_range", "weight_kg", 30, 300),
    within("bmi_between_10_80", "bmi_out_of_range", "bmi", 10, 80),
    within("systolic_bp_between_70_250", "systolic_bp_out_of_range", "systolic_bp", 70, 250),
    within("diastolic_bp_between_40_150", "diastolic_bp_out_of_range", "diastolic_bp", 40, 150),
    ordered("systolic_bp_gte_diastolic_bp", "bp_order_invalid", "systolic_bp", "diastolic_bp"),
    one_of("cholesterol_level_domain_1_2_3", "cholesterol_domain_invalid", "cholesterol_level", (1, 2, 3)),
    one_of("glucose_level_domain_1_2_3", "glucose_domain_invalid", "glucose_level", (1, 2, 3)),
    present("is_smoker_present", "missing_smoker_flag", "is_smoker"),
    present("drinks_alcohol_present", "missing_alcohol_flag", "drinks_alcohol"),
    present("is_active_present", "missing_activity_flag", "is_active"),
    present("target_present", "missing_target", "has_cardiovascular_disease"),
), ("patient_id_unique", "duplicate_patient_id"))

CDC_CONTRACT = Contract(V.CDC, "respondent_id", (
    present("respondent_id_present", "missing_respondent_id", "respondent_id"),
    AGE_RULES[1],
    within("age_years_proxy_between_18_90", "age_proxy_invalid", "age_years_proxy", 18, 90),
    GENDER_RULE,
    within("bmi_between_10_100", "bmi_out_of_range", "bmi", 10, 100),
    present("high_blood_pressure_present", "missing_high_bp_flag", "high_blood_pressure_flag"),
    present("high_cholesterol_present", "missing_high_chol_flag", "high_cholesterol_flag"),
    present("smoking_flag_present", "missing_smoking_flag", "smoking_flag"),
    present("physical_activity_present", "missing_activity_flag", "physical_activity_flag"),
    present("heavy_alcohol_present", "missing_alcohol_flag", "heavy_alcohol_flag"),
    within_or_null("general_health_between_1_5_or_null", "general_health_invalid", "general_health_score", 1, 5),
    within_or_null("mental_unhealthy_days_between_0_30_or_null", "mental_health_days_invalid", "mental_unhealthy_days", 0, 30),
    within_or_null("physical_unhealthy_days_between_0_30_or_null", "physical_health_days_invalid", "physical_unhealthy_days", 0, 30),
    present("difficulty_walking_present", "missing_diff_walk_flag", "difficulty_walking_flag"),
    within_or_null("education_between_1_6_or_null", "education_invalid", "education_level", 1, 6),
    within_or_null("income_between_1_8_or_null", "income_invalid", "income_level", 1, 8),
    present("target_present", "missing_target", "has_heart_disease"),
))

CLEVELAND_CONTRACT = Contract(V.CLEVELAND, "record_key", (
    present("record_key_present", "missing_record_key", "record_key"),
    *AGE_RULES,
    GENDER_RULE,
    one_of("chest_pain_type_domain_0_3", "chest_pain_invalid", "chest_pain_type", (0, 1, 2, 3)),
    within("resting_bp_between_70_250", "resting_bp_out_of_range", "resting_bp", 70, 250),
    within("serum_cholesterol_between_50_700", "cholesterol_out_of_range", "serum_cholesterol", 50, 700),
    present("fasting_blood_sugar_present", "missing_fbs_flag", "fasting_blood_sugar_high"),
    one_of("resting_ecg_domain_0_2", "resting_ecg_invalid", "resting_ecg", (0, 1, 2)),
    within("max_heart_rate_between_40_250", "max_heart_rate_out_of_range", "max_heart_rate", 40, 250),
    present("exercise_induced_angina_present", "missing_exang_flag", "exercise_induced_angina"),
    within("st_depression_between_0_10", "st_depression_out_of_range", "st_depression", 0, 10),
    one_of("st_slope_domain_0_2", "st_slope_invalid", "st_slope", (0, 1, 2)),
    within_or_null("num_major_vessels_between_0_3_or_null", "num_major_vessels_invalid", "num_major_vessels", 0, 3),
    one_of("thalassemia_type_domain_0_2", "thalassemia_invalid", "thalassemia_type", (0, 1, 2)),
    present("target_present", "missing_target", "has_heart_disease"),
), ("record_key_unique", "duplicate_record_key"))

# (standardiser, contract, expected header) per source, in the order the zones process them.
SOURCES: Mapping[str, tuple] = {
    V.CARDIO: (standardise_cardio, CARDIO_CONTRACT, CARDIO_HEADER),
    V.CDC: (standardise_cdc, CDC_CONTRACT, None),
    V.CLEVELAND: (standardise_cleveland, CLEVELAND_CONTRACT, None),
}
