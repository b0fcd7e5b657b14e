"""Independent SQL for every query that plain SQL can express, over the same tables.

The statements share common table expressions; the fixed vocabulary enters as VALUES lists.
"""

from __future__ import annotations

from riskgraph import vocabulary as V
from riskgraph.plans.bindings import RUN_ID, RUN_TS

SQL: dict[str, str] = {}


def q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(q(c) if isinstance(c, str) else str(c) for c in r) + ")" for r in rows) + ")"


HR = q(V.HR)
TYPE, LABEL = q(V.RDF_TYPE), q(V.RDFS_LABEL)
INT, DBL, STR = (q(V.XSD + x) for x in ("integer", "double", "string"))


def band_of(years: str) -> str:
    cases = " ".join(f"WHEN {years} < {25 + 5 * i} THEN {i + 1}" for i in range(12))
    return f"CASE WHEN {years} IS NULL THEN NULL {cases} ELSE 13 END"


def midpoint_of(band: str) -> str:
    return f"CASE {band} " + " ".join(f"WHEN {i} THEN {m}" for i, m in enumerate(V.AGE_BAND_MIDPOINTS, 1)) + " ELSE NULL END"


def slug(expr: str) -> str:
    words = f"regexp_replace(lower(trim({expr})), '[^a-z0-9]+', '-', 'g')"
    return f"coalesce(nullif(trim({words}, '-'), ''), 'unknown')"


# ---- contracts ---------------------------------------------------------------------------------------------
STANDARD = f"""
orders_std AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS record_key, CAST(floor(o_totalprice / 5000.0) AS INTEGER) AS age_years,
         CASE o_orderstatus WHEN 'F' THEN 'female' WHEN 'O' THEN 'male' END AS gender,
         o_totalprice / 2000.0 AS systolic_bp, c_acctbal / 60.0 AS diastolic_bp,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_level, o_totalprice >= 250000 AS high_price,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 AS has_condition,
         {band_of('CAST(floor(o_totalprice / 5000.0) AS INTEGER)')} AS age_group_code
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
lineitem_std AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS record_key, CAST(floor(l_quantity * 2) AS INTEGER) AS age_years,
         CASE l_linestatus WHEN 'F' THEN 'female' WHEN 'O' THEN 'male' END AS gender,
         l_quantity * 4 + 60 AS resting_bp, l_discount >= 0.05 AS high_discount, l_tax >= 0.04 AS high_tax,
         l_returnflag = 'R' AS has_condition, {band_of('CAST(floor(l_quantity * 2) AS INTEGER)')} AS age_group_code
  FROM lineitem),
events_k AS (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events),
events_std AS (
  SELECT CAST(event_id AS VARCHAR) AS record_key, k % 15 + 1 AS age_group_code,
         CAST({midpoint_of('k % 15 + 1')} AS DOUBLE) AS age_years_proxy,
         CASE WHEN event_type IN ('view', 'click') THEN 'female' WHEN event_type IN ('signup', 'purchase') THEN 'male' END AS gender,
         value / 5.0 AS bmi, user_id % 2 = 1 AS high_blood_pressure_flag, value >= 50 AS high_cholesterol_flag,
         k >= 50 AS smoking_flag, user_id % 3 = 0 AS physical_activity_flag, k % 7 = 0 AS heavy_alcohol_flag,
         value >= 100 AS has_condition
  FROM events_k)"""

COMMON = {
    "age": ("age_years_between_18_100", "age_out_of_range", "age_years BETWEEN 18 AND 100"),
    "band": ("age_group_code_between_1_13", "age_group_invalid", "age_group_code BETWEEN 1 AND 13"),
    "gender": ("gender_domain_male_female", "gender_invalid", "gender IN ('female', 'male')"),
    "key": ("record_key_present", "missing_record_key", "record_key IS NOT NULL"),
    "target": ("target_present", "missing_target", "has_condition IS NOT NULL"),
    "unique": ("record_key_unique", "duplicate_record_key", "rn = 1"),
}
RULES = {
    "orders": [
        COMMON["key"], COMMON["age"], COMMON["band"], COMMON["gender"],
        ("systolic_bp_between_70_250", "systolic_bp_out_of_range", "systolic_bp BETWEEN 70 AND 250"),
        ("diastolic_bp_between_40_150", "diastolic_bp_out_of_range", "diastolic_bp BETWEEN 40 AND 150"),
        ("systolic_bp_gte_diastolic_bp", "bp_order_invalid", "systolic_bp >= diastolic_bp"),
        ("priority_domain_1_5", "priority_domain_invalid", "priority_level IN (1, 2, 3, 4, 5)"),
        COMMON["target"], COMMON["unique"],
    ],
    "lineitem": [
        COMMON["key"], COMMON["age"], COMMON["band"], COMMON["gender"],
        ("resting_bp_between_70_250", "resting_bp_out_of_range", "resting_bp BETWEEN 70 AND 250"),
        COMMON["target"], COMMON["unique"],
    ],
    "events": [
        COMMON["key"], COMMON["band"],
        ("age_years_proxy_between_18_90", "age_proxy_invalid", "age_years_proxy BETWEEN 18 AND 90"),
        COMMON["gender"], ("bmi_between_0_100_or_null", "bmi_invalid", "(bmi IS NULL OR bmi BETWEEN 0 AND 100)"),
        COMMON["target"],
    ],
}
ORDER = {
    "orders": "age_years, gender, systolic_bp, diastolic_bp, priority_level, high_price, has_condition, age_group_code",
    "lineitem": "age_years, gender, resting_bp, high_discount, high_tax, has_condition, age_group_code",
}


def _evaluated() -> str:
    parts = []
    for name, rules in RULES.items():
        flags = ", ".join(f"coalesce({sql}, false) AS r{i}" for i, (_, _, sql) in enumerate(rules))
        rank = "1 AS rn"
        if name in ORDER:
            by = ", ".join(f"{c} ASC NULLS FIRST" for c in ORDER[name].split(", "))
            rank = f"row_number() OVER (PARTITION BY record_key ORDER BY {by}) AS rn"
        every = " AND ".join(f"r{i}" for i in range(len(rules)))
        parts.append(
            f"{name}_ev AS (SELECT *, {every} AS ok FROM (SELECT *, {flags} FROM (SELECT *, {rank} FROM {name}_std)))")
    return ",\n".join(parts)


META = f"'{RUN_ID}' AS _run_id, '{RUN_TS}' AS _processed_at_utc"
CANON_ORDERS = """SELECT 'orders' AS source_dataset, record_key AS source_record_id, CAST(age_years AS DOUBLE) AS age_years_proxy,
  age_group_code, gender, CAST(NULL AS DOUBLE) AS bmi, systolic_bp, diastolic_bp,
  systolic_bp >= 130 OR diastolic_bp >= 80 AS high_blood_pressure_flag, priority_level <= 3 AS high_cholesterol_flag,
  high_price AS glucose_risk_flag, CAST(NULL AS BOOLEAN) AS smoking_flag, CAST(NULL AS BOOLEAN) AS physical_activity_flag,
  CAST(NULL AS BOOLEAN) AS heavy_alcohol_flag, CAST(NULL AS INTEGER) AS general_health_score,
  CAST(NULL AS DOUBLE) AS mental_unhealthy_days, CAST(NULL AS DOUBLE) AS physical_unhealthy_days,
  CAST(NULL AS BOOLEAN) AS difficulty_walking_flag, CAST(NULL AS DOUBLE) AS max_heart_rate,
  CAST(NULL AS BOOLEAN) AS exercise_induced_angina, has_condition AS target FROM orders_ev WHERE ok"""
CANON_LINEITEM = """SELECT 'lineitem', record_key, CAST(age_years AS DOUBLE), age_group_code, gender, NULL, resting_bp, NULL,
  resting_bp >= 130, high_discount, high_tax, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, has_condition
  FROM lineitem_ev WHERE ok"""
CANON_EVENTS = """SELECT 'events', record_key, age_years_proxy, age_group_code, gender, bmi, NULL, NULL, high_blood_pressure_flag,
  high_cholesterol_flag, NULL, smoking_flag, physical_activity_flag, heavy_alcohol_flag, NULL, NULL, NULL, NULL, NULL, NULL,
  has_condition FROM events_ev WHERE ok"""
CANON = f"""
canon AS (SELECT *, '{RUN_ID}' AS trusted_run_id, '{RUN_TS}' AS trusted_processed_at_utc, '{RUN_ID}' AS exploitation_run_id,
  '{RUN_TS}' AS exploitation_created_at_utc FROM ({CANON_ORDERS} UNION ALL {CANON_LINEITEM} UNION ALL {CANON_EVENTS})),
records AS (SELECT *, row_number() OVER (PARTITION BY source_dataset, source_record_id ORDER BY age_years_proxy) AS record_ordinal
  FROM canon)"""


def _quality() -> str:
    parts = []
    for name, rules in RULES.items():
        total = f"(SELECT count(*) FROM {name}_ev)"
        listed = [(n, f"r{i}", "quarantine_row") for i, (n, _, _) in enumerate(rules)]
        listed.append(("rows_quarantined_total", "ok", "excluded_from_trusted"))
        for rule, flag, action in listed:
            parts.append(
                f"SELECT '{RUN_ID}' AS run_id, '{name}' AS dataset, '{rule}' AS rule_name, count(*) AS total_rows, "
                f"count(*) FILTER (WHERE NOT {flag}) AS violations, '{action}' AS action_applied FROM {name}_ev")
    return ("quality AS (SELECT run_id, dataset, rule_name, total_rows, violations, "
            "round(coalesce(violations * 100.0 / nullif(total_rows, 0), 0.0), 4)::DOUBLE AS violation_pct, action_applied, "
            f"'{RUN_TS}' AS measured_at_utc FROM (" + " UNION ALL ".join(parts) + "))")


def _quarantine() -> str:
    parts = []
    for name, rules in RULES.items():
        codes = ", ".join(f"CASE WHEN NOT r{i} THEN '{reason}' END" for i, (_, reason, _) in enumerate(rules))
        parts.append(
            f"SELECT '{RUN_ID}' AS run_id, '{name}' AS dataset, record_key, concat_ws(';', {codes}) AS quarantine_reason, "
            f"'{RUN_TS}' AS quarantined_at_utc FROM {name}_ev WHERE NOT ok")
    return "quarantine AS (" + " UNION ALL ".join(parts) + ")"


NUMERIC_AVG = "round(avg({c}), 3)"
PROFILE = f"""
profile AS (SELECT source_dataset, count(*) AS rows_total, count(*) FILTER (WHERE target) AS target_positive_rows,
  round(avg(CAST(target AS DOUBLE)), 4) AS target_positive_rate, round(avg(age_years_proxy), 3) AS age_proxy_avg,
  round(avg(bmi), 3) AS bmi_avg, round(avg(systolic_bp), 3) AS systolic_bp_avg,
  round(avg(CAST(high_blood_pressure_flag AS DOUBLE)), 4) AS high_bp_rate,
  round(avg(CAST(high_cholesterol_flag AS DOUBLE)), 4) AS high_chol_rate,
  round(count(*) FILTER (WHERE bmi IS NULL)::DOUBLE / count(*) * 100.0, 3) AS bmi_missing_pct,
  round(count(*) FILTER (WHERE smoking_flag IS NULL)::DOUBLE / count(*) * 100.0, 3) AS smoking_missing_pct,
  round(count(*) FILTER (WHERE physical_activity_flag IS NULL)::DOUBLE / count(*) * 100.0, 3) AS activity_missing_pct,
  '{RUN_TS}' AS profile_created_at_utc FROM canon GROUP BY source_dataset)"""


def _measurements() -> str:
    parts = [
        f"SELECT source_dataset, age_group_code, gender, {q(i.id)} AS indicator_id, {q(i.label)} AS indicator_label, "
        f"{q(i.kind)} AS kind, count({i.column}) AS observations, round(avg(CAST({i.column} AS DOUBLE)), 6) AS value "
        "FROM canon WHERE age_group_code IS NOT NULL AND gender IS NOT NULL GROUP BY ALL HAVING count(" + i.column + ") > 0"
        for i in V.INDICATORS
    ]
    return "cells AS (" + " UNION ALL ".join(parts) + ")"


BASE = ",\n".join([STANDARD, _evaluated(), CANON, _quality(), _quarantine(), PROFILE, _measurements()])


def base(select: str) -> str:
    return f"WITH RECURSIVE {BASE}\n{select}"


# ---- graph ---------------------------------------------------------------------------------------------------
def text6(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(20,6)) AS VARCHAR)"


GROUP_IRI = f"{HR} || 'population-group/age-' || coalesce(CAST(age_group_code AS VARCHAR), 'unknown') || '/gender-' || coalesce(gender, 'unknown')"
CELL_IRI = (f"{HR} || 'aggregate-measurement/' || source_dataset || '/age-' || age_group_code || '/gender-' || gender || '/' || indicator_id")
REC_IRI = f"{HR} || 'record/' || source_dataset || '/' || sha1(source_record_id || '|' || record_ordinal)"


def iri_t(s: str, p: str, o: str, tail: str) -> str:
    return f"SELECT {s} AS s, {p} AS p, {o} AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_type {tail}"


def lit_t(s: str, p: str, o: str, kind: str, tail: str) -> str:
    return f"SELECT {s} AS s, {p} AS p, {o} AS o, 'literal' AS o_kind, CAST({kind} AS VARCHAR) AS o_type {tail}"


def _schema() -> str:
    parts = [
        iri_t(f"{HR} || n", TYPE, q(V.RDFS_CLASS), "FROM classes"), lit_t(f"{HR} || n", LABEL, "l", "NULL", "FROM classes"),
        iri_t(f"{HR} || c", q(V.RDFS_SUBCLASS), f"{HR} || p", "FROM sub_class"),
        iri_t(f"{HR} || c", q(V.RDFS_SUBPROPERTY), f"{HR} || p", "FROM sub_property"),
        iri_t(f"{HR} || n", TYPE, q(V.RDF_PROPERTY), "FROM props"), iri_t(f"{HR} || n", q(V.RDFS_DOMAIN), f"{HR} || d", "FROM props"),
        iri_t(f"{HR} || n", q(V.RDFS_RANGE), "r", "FROM props"), lit_t(f"{HR} || n", LABEL, "n", "NULL", "FROM props"),
        lit_t(f"{HR} || n", q(V.RDFS_COMMENT), "c", "NULL", "FROM props"),
    ]
    props = [(n, d, V.HR + r, c) for n, d, r, c in V.OBJECT_PROPERTIES] + [(n, d, V.XSD + r, c) for n, d, r, c in V.DATA_PROPERTIES]
    return (f"classes AS (SELECT * FROM {values(V.CLASSES)} t(n, l)), sub_class AS (SELECT * FROM {values(V.SUBCLASS_OF)} t(c, p)), "
            f"sub_property AS (SELECT * FROM {values(V.SUBPROPERTY_OF)} t(c, p)), props AS (SELECT * FROM {values(props)} t(n, d, r, c)), "
            "schema_t AS (" + " UNION ALL ".join(parts) + ")")


def _vocabulary() -> str:
    nodes = [(f"age-group/{i}", "AgeGroup", label) for i, label in enumerate(V.AGE_BAND_LABELS, 1)]
    nodes += [(f"gender/{g}", "Gender", g) for g in V.GENDERS] + [(f"indicator/{i.id}", "Indicator", i.label) for i in V.INDICATORS]
    nodes += [(n, "Outcome", label) for n, label in V.OUTCOMES]
    extra = [(f"age-group/{i}", "ageGroupCode", str(i), "integer") for i in range(1, 14)]
    for i in V.INDICATORS:
        extra += [(f"indicator/{i.id}", "indicatorColumn", i.column, "string"), (f"indicator/{i.id}", "indicatorCategory", i.category, "string"),
                  (f"indicator/{i.id}", "valueKind", i.kind, "string")]
    return (f"nodes AS (SELECT * FROM {values(nodes)} t(n, k, l)), extra AS (SELECT * FROM {values(extra)} t(n, p, v, x)), vocab_t AS ("
            + " UNION ALL ".join([
                iri_t(f"{HR} || n", TYPE, f"{HR} || k", "FROM nodes"), lit_t(f"{HR} || n", LABEL, "l", "NULL", "FROM nodes"),
                lit_t(f"{HR} || n", f"{HR} || p", "v", f"{q(V.XSD)} || x", "FROM extra")]) + ")")


def h(name: str) -> str:
    return q(V.HR + name)


RUN_IRI = h(f"kg-run/{RUN_ID}")
RUN_PARTS = " UNION ALL ".join([
    iri_t(RUN_IRI, TYPE, h("KnowledgeGraphRun"), ""), lit_t(RUN_IRI, LABEL, q(f"KG generation run {RUN_ID}"), "NULL", ""),
    lit_t(RUN_IRI, h("runId"), q(RUN_ID), STR, ""), lit_t(RUN_IRI, h("createdAtUtc"), q(RUN_TS), q(V.XSD + "dateTime"), ""),
    iri_t(RUN_IRI, q(V.DCTERMS + "conformsTo"), q(V.RDFS), ""),
    iri_t(RUN_IRI, h("generatedGraph"), f"{HR} || 'dataset/' || source_dataset", "FROM profile")])
D = f"{HR} || 'dataset/' || source_dataset"
DATASET_PARTS = " UNION ALL ".join([
    iri_t(D, TYPE, h("Dataset"), "FROM profile"), lit_t(D, LABEL, "source_dataset", "NULL", "FROM profile"),
    lit_t(D, h("rowsTotal"), "CAST(rows_total AS VARCHAR)", INT, "FROM profile"),
    lit_t(D, h("targetPositiveRate"), text6("target_positive_rate"), DBL, "FROM profile")])


def groups_of(source: str) -> str:
    src = f"FROM (SELECT DISTINCT age_group_code, gender FROM {source})"
    return " UNION ALL ".join([
        iri_t(GROUP_IRI, TYPE, h("PopulationGroup"), src),
        lit_t(GROUP_IRI, LABEL, "'Age ' || coalesce(CAST(age_group_code AS VARCHAR), 'unknown') || ' / gender ' || coalesce(gender, 'unknown')", "NULL", src),
        iri_t(GROUP_IRI, h("populationGroupAgeGroup"), f"{HR} || 'age-group/' || coalesce(CAST(age_group_code AS VARCHAR), 'unknown')", src),
        iri_t(GROUP_IRI, h("populationGroupGender"), f"{HR} || 'gender/' || coalesce(gender, 'unknown')", src)])


FACTORS = [("hasObservedRiskFactor", c, i) for c, i in V.RISK_COLUMNS.items()] + [
    ("hasObservedProtectiveFactor", c, i) for c, i in V.PROTECTIVE_COLUMNS.items()]
RECORD_PARTS = " UNION ALL ".join([
    iri_t(REC_IRI, TYPE, h("HealthRecord"), "FROM records"), iri_t(REC_IRI, h("fromDataset"), D, "FROM records"),
    iri_t(REC_IRI, h("belongsToAgeGroup"), f"{HR} || 'age-group/' || age_group_code", "FROM records"),
    iri_t(REC_IRI, h("hasGender"), f"{HR} || 'gender/' || gender", "FROM records"),
    iri_t(REC_IRI, h("belongsToPopulationGroup"), GROUP_IRI, "FROM records"),
    iri_t(REC_IRI, h("hasOutcome"), f"{HR} || 'outcome/' || CASE WHEN target THEN 'heart-disease-positive' WHEN NOT target THEN 'heart-disease-negative' ELSE 'unknown' END", "FROM records"),
    lit_t(REC_IRI, h("sourceRecordId"), "source_record_id", STR, "FROM records"),
    lit_t(REC_IRI, h("recordOrdinal"), "CAST(record_ordinal AS VARCHAR)", INT, "FROM records"),
    lit_t(REC_IRI, h("sourceDatasetName"), "source_dataset", STR, "FROM records"),
    *[iri_t(REC_IRI, h(p), h(f"indicator/{i}"), f"FROM records WHERE {c}") for p, c, i in FACTORS]])
CELL_PARTS = " UNION ALL ".join([
    iri_t(CELL_IRI, TYPE, h("AggregateMeasurement"), "FROM cells"), iri_t(CELL_IRI, h("fromDataset"), D, "FROM cells"),
    iri_t(CELL_IRI, h("forPopulationGroup"), GROUP_IRI, "FROM cells"),
    iri_t(CELL_IRI, h("measuresIndicator"), f"{HR} || 'indicator/' || indicator_id", "FROM cells"),
    iri_t(GROUP_IRI, h("hasAggregateMeasurement"), CELL_IRI, "FROM cells"),
    lit_t(CELL_IRI, LABEL, "indicator_label || ' for ' || source_dataset || ', age ' || age_group_code || ', gender ' || gender", "NULL", "FROM cells"),
    lit_t(CELL_IRI, h("observationCount"), "CAST(observations AS VARCHAR)", INT, "FROM cells"),
    lit_t(CELL_IRI, h("positiveRate"), text6("value"), DBL, "FROM cells WHERE kind = 'boolean'"),
    lit_t(CELL_IRI, h("meanValue"), text6("value"), DBL, "FROM cells WHERE kind = 'numeric'")])
SUPER = " UNION ".join([
    "SELECT 'property' AS k, c AS child, p AS parent FROM sub_property", "SELECT 'class', c, p FROM sub_class"])
GRAPH = ",\n".join([
    _schema(), _vocabulary(), f"run_t AS ({RUN_PARTS})", f"dataset_t AS ({DATASET_PARTS})", f"groups_t AS ({groups_of('canon')})",
    f"cell_groups_t AS ({groups_of('cells')})", f"record_t AS ({RECORD_PARTS})", f"cell_t AS ({CELL_PARTS})",
    "full_g AS (" + " UNION ".join(f"SELECT * FROM {t}" for t in ("schema_t", "vocab_t", "run_t", "dataset_t", "groups_t", "record_t", "cell_t")) + ")",
    "small_g AS (" + " UNION ".join(f"SELECT * FROM {t}" for t in ("schema_t", "vocab_t", "run_t", "dataset_t", "cell_groups_t", "cell_t")) + ")",
    f"above AS ({SUPER} UNION SELECT a.k, a.child, b.parent FROM above a JOIN (SELECT 'property' AS k, c AS child, p AS parent FROM sub_property UNION ALL SELECT 'class', c, p FROM sub_class) b ON a.k = b.k AND a.parent = b.child)",
    f"up AS (SELECT k, {HR} || child AS child, {HR} || parent AS parent FROM above)",
    "full_new AS (SELECT s, parent AS p, o, o_kind, o_type FROM full_g JOIN up ON up.k = 'property' AND child = p EXCEPT SELECT * FROM full_g)",
    f"small_new AS ((SELECT s, parent AS p, o, o_kind, o_type FROM small_g JOIN up ON up.k = 'property' AND child = p UNION SELECT s, p, parent, o_kind, o_type FROM small_g JOIN up ON up.k = 'class' AND child = o WHERE p = {TYPE}) EXCEPT SELECT * FROM small_g)",
    "small_all AS (SELECT * FROM small_g UNION ALL SELECT * FROM small_new)",
])


def graph(select: str) -> str:
    return f"WITH RECURSIVE {BASE},\n{GRAPH}\n{select}"


TRIPLE = "SELECT s, p, o, o_kind, o_type"

# ---- slice and formatting --------------------------------------------------------------------------------------
SQL["flagship_group_rank"] = base(
    "SELECT source_dataset, age_group_code, gender, value AS positive_rate, observations FROM cells WHERE source_dataset = 'orders' "
    f"AND indicator_id = '{V.OUTCOME_INDICATOR}' AND observations >= 25 ORDER BY value DESC, observations DESC, age_group_code, gender LIMIT 20")
SQL["fmt_normalise_names"] = "SELECT n_nationkey AS n_nation_key, n_name, n_regionkey AS n_name_2 FROM (SELECT n_nationkey, n_name, n_regionkey FROM nation)"
SQL["fmt_split_single_column"] = (
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS s_nationkey FROM supplier")
SQL["fmt_fingerprint"] = f"""
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment, 'customer' AS _source_dataset,
  sha256(concat_ws('|', 'customer', coalesce(CAST(c_custkey AS VARCHAR), ''), coalesce(c_name, ''), coalesce(CAST(c_nationkey AS VARCHAR), ''),
    coalesce(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), ''), coalesce(c_mktsegment, ''))) AS _formatted_record_id,
  '{RUN_TS}' AS _formatted_at_utc FROM customer"""

# ---- scalars ------------------------------------------------------------------------------------------------------
WORDS = ["YES", " y ", "2", "", "0", "0.0", "-3", "no", "N", "true", "1.0", "maybe", "7.25", "False"]
FLAG = [True, True, None, None, False, False, None, False, False, True, True, None, None, False]
POSITIVE = [True, True, True, None, False, False, None, False, False, True, True, None, True, False]


def _sql_bool(v) -> str:
    return "NULL" if v is None else str(v).lower()


SQL["sc_parse_flags"] = (
    "SELECT event_id, flag, flag_or_positive, CASE event_id % 3 WHEN 1 THEN true WHEN 0 THEN false END AS number_flag FROM events JOIN (VALUES "
    + ", ".join(f"({i}, CAST({_sql_bool(a)} AS BOOLEAN), CAST({_sql_bool(b)} AS BOOLEAN))" for i, (a, b) in enumerate(zip(FLAG, POSITIVE)))
    + ") t(n, flag, flag_or_positive) ON event_id % 14 = n")
SQL["sc_parse_class"] = "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'female' WHEN 'O' THEN 'male' END AS gender FROM orders"
SQL["sc_band_ladder"] = f"SELECT l_orderkey, l_linenumber, l_partkey, {band_of('floor(l_quantity * 2)')} AS band FROM lineitem"
_N = "CAST(event_id % 17 AS INTEGER)"
SQL["sc_band_decode_midpoint"] = f"""
SELECT event_id, band, CAST({midpoint_of('band')} AS DOUBLE) AS midpoint FROM (SELECT event_id,
  CASE WHEN event_id % 2 = 1 THEN {_N} WHEN {_N} <= 12 THEN {_N} + 1 END AS band FROM events)"""
SQL["sc_stable_key"] = (
    "SELECT p_partkey, sha256(concat_ws('|', 'part', CAST(p_partkey AS VARCHAR), p_name, p_brand, CAST(p_size AS VARCHAR))) AS record_key FROM part")
SQL["sc_days_to_years"] = (
    "SELECT o_orderkey, CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2026-01-01') * 10 / 365.25) AS INTEGER) AS years FROM orders")
SQL["sc_ratio_guarded"] = (
    "SELECT p_partkey, CASE WHEN p_size > 10 THEN round(p_retailprice / pow((p_size - 10) / 100.0, 2), 6) END AS ratio FROM part")
_CODE = "coalesce(CASE WHEN p_size <= 13 THEN CAST(p_size AS VARCHAR) END, 'unknown')"
SQL["sc_slug_iri"] = f"""
SELECT p_partkey, {slug('name')} AS slug, {HR} || 'dataset/' || {slug('name')} AS dataset,
  {HR} || 'population-group/age-' || {_CODE} || '/gender-' || {slug('p_brand')} AS population_group,
  {HR} || 'age-group/' || {_CODE} AS age_group, {HR} || 'gender/' || {slug('name')} AS gender,
  {HR} || 'outcome/' || CASE WHEN p_size > 25 THEN 'heart-disease-positive' WHEN p_size > 5 THEN 'heart-disease-negative' ELSE 'unknown' END AS outcome,
  {HR} || 'record/part/' || sha1(p_partkey || '|1') AS record,
  {HR} || 'aggregate-measurement/part/age-' || {_CODE} || '/gender-' || {slug('p_brand')} || '/smoking' AS measurement
FROM (SELECT *, CASE WHEN p_partkey % 7 = 0 THEN ' --- ' WHEN p_partkey % 11 = 0 THEN NULL ELSE concat_ws(' / ', p_type, p_brand, p_name) END AS name FROM part)"""
_KINDS = [k for _, k in V.NODE_KINDS] + ["other", "predicate"]
SQL["sc_node_kind"] = "SELECT p_partkey, kind FROM part JOIN " + values(list(enumerate(_KINDS))) + f" t(n, kind) ON p_partkey % {len(_KINDS)} = n"
SQL["sc_coercions"] = """
SELECT event_id, n = 6 AS missing, CASE n WHEN 0 THEN 12.7 WHEN 3 THEN 5.0 WHEN 4 THEN -0.5 WHEN 5 THEN 1000.0 END::DOUBLE AS number,
  CASE n WHEN 0 THEN 12 WHEN 3 THEN 5 WHEN 4 THEN 0 WHEN 5 THEN 1000 END AS whole FROM (SELECT event_id, event_id % 7 AS n FROM events)"""

# ---- contracts --------------------------------------------------------------------------------------------------------
SQL["dq_rule_metrics"] = base("SELECT * FROM quality")
SQL["dq_quarantine"] = base("SELECT * FROM quarantine")
for _name, _rules in RULES.items():
    SQL[f"dq_clean_{_name}"] = base(
        f"SELECT * EXCLUDE ({', '.join(f'r{i}' for i in range(len(_rules)))}, rn, ok), {META} FROM {_name}_ev WHERE ok")
SQL["dq_uniqueness"] = """
SELECT 'orders' AS dataset, count(*) AS rows, count(DISTINCT o_orderkey) AS survivors FROM orders UNION ALL
SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem UNION ALL SELECT 'events', count(*), count(*) FROM events"""
SQL["dq_required_sources"] = base(
    "SELECT n AS source_dataset FROM (VALUES ('orders'), ('lineitem'), ('events'), ('returns')) t(n) WHERE n NOT IN (SELECT source_dataset FROM canon)")

# ---- harmonise -----------------------------------------------------------------------------------------------------------
SQL["hz_canonical_union"] = base("SELECT * FROM canon")
SQL["hz_profile"] = base("SELECT * FROM profile")
SQL["hz_profile_listing"] = base(
    "SELECT source_dataset, rows_total, target_positive_rate, age_proxy_avg, bmi_avg, high_bp_rate, high_chol_rate, bmi_missing_pct, "
    "smoking_missing_pct, activity_missing_pct FROM profile ORDER BY source_dataset")
SQL["hz_measurements"] = base("SELECT * FROM cells")
SQL["hz_top_violations"] = base(
    "SELECT dataset, rule_name, violations, violation_pct, action_applied FROM quality ORDER BY violations DESC, dataset, rule_name LIMIT 20")
SQL["hz_top_reasons"] = base(
    "SELECT dataset, quarantine_reason, count(*) AS rows FROM quarantine GROUP BY 1, 2 ORDER BY rows DESC, dataset, quarantine_reason LIMIT 15")
SQL["hz_quarantine_summary"] = base("""
SELECT *, round(coalesce(quarantined_rows, 0)::DOUBLE / greatest(source_rows, 1) * 100.0, 6) AS quarantine_pct FROM (
  SELECT dataset, CAST(sum(violations) FILTER (WHERE rule_name <> 'rows_quarantined_total') AS BIGINT) AS rule_violations,
    max(CASE WHEN rule_name = 'rows_quarantined_total' THEN violations END) AS quarantined_rows, max(total_rows) AS source_rows
  FROM quality GROUP BY dataset) ORDER BY dataset""")
SQL["hz_coverage"] = base("SELECT source_dataset, " + ", ".join(
    f"round(100.0 * avg(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END), 6) AS {a}" for c, a in (
        ("bmi", "bmi_coverage"), ("systolic_bp", "systolic_bp_coverage"), ("smoking_flag", "smoking_coverage"),
        ("high_blood_pressure_flag", "high_bp_coverage"), ("high_cholesterol_flag", "high_chol_coverage"),
        ("max_heart_rate", "max_hr_coverage"), ("general_health_score", "general_health_coverage"))) + " FROM canon GROUP BY 1 ORDER BY 1")
LABELS = f"(SELECT * FROM {values(list(enumerate(V.AGE_BAND_LABELS, 1)))} t(code, label))"
AGE_RATES = (
    f"SELECT label AS \"ageGroupLabel\", {D} AS dataset, round(avg(value), 6) AS \"avgOutcomeRate\", CAST(sum(observations) AS BIGINT) AS \"totalObservations\" "
    f"FROM cells JOIN {LABELS} ON code = age_group_code WHERE indicator_id = '{V.OUTCOME_INDICATOR}' GROUP BY 1, 2")
SQL["hz_rate_pivot"] = base("SELECT \"ageGroupLabel\", " + ", ".join(
    f"max(CASE WHEN dataset LIKE '%/{n}' THEN \"avgOutcomeRate\" END) AS {n}" for n in ("orders", "lineitem", "events")) + f" FROM ({AGE_RATES}) GROUP BY 1")
SQL["hz_value_counts"] = base("SELECT source_dataset, target, count(*) AS rows FROM canon GROUP BY 1, 2")
SQL["hz_describe"] = base(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS rows, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM canon" for c in ("age_years_proxy", "age_group_code")))
CONSISTENCY = (
    "SELECT indicator_label AS \"indicatorLabel\", count(DISTINCT source_dataset) AS datasets, min(value) AS \"minRate\", max(value) AS \"maxRate\", "
    "round(avg(value), 6) AS \"avgRate\" FROM cells WHERE kind = 'boolean' GROUP BY 1 HAVING count(DISTINCT source_dataset) > 1")
SQL["hz_spread"] = base(f"SELECT *, round(\"maxRate\" - \"minRate\", 6) AS spread FROM ({CONSISTENCY}) ORDER BY spread DESC, \"indicatorLabel\"")
SQL["hz_lineage"] = base("""
SELECT min(exploitation_run_id) AS exploitation_run_id, min(exploitation_created_at_utc) AS created_at_utc,
  string_agg(DISTINCT source_dataset, ', ' ORDER BY source_dataset) AS source_datasets,
  string_agg(DISTINCT trusted_run_id, ', ' ORDER BY trusted_run_id) AS trusted_run_ids, count(*) AS rows_integration FROM canon""")
SQL["hz_row_audit"] = base(" UNION ALL ".join(
    [f"SELECT 'trusted.{n}' AS table_name, count(*) AS n FROM {n}_ev WHERE ok" for n in RULES]
    + ["SELECT 'metadata.quarantine', count(*) FROM quarantine", "SELECT 'metadata.quality_report', count(*) FROM quality"]))

# ---- graph queries ------------------------------------------------------------------------------------------------------------
SQL["kg_schema"] = graph(
    "SELECT f.s, f.p, f.o, f.o_kind, f.o_type, coalesce(used, 0) AS used FROM (SELECT * FROM schema_t UNION ALL SELECT * FROM vocab_t) f "
    "LEFT JOIN (SELECT o, count(*) AS used FROM full_g WHERE o_kind = 'iri' GROUP BY o) u ON f.s = u.o")
SQL["kg_record_triples"] = graph(f"{TRIPLE} FROM record_t")
SQL["kg_measurement_triples"] = graph(f"{TRIPLE} FROM cell_t")
SQL["kg_groups"] = graph(f"{TRIPLE} FROM groups_t")
SQL["kg_datasets_run"] = graph(f"{TRIPLE} FROM dataset_t UNION ALL {TRIPLE} FROM run_t")
SQL["kg_full"] = graph(f"{TRIPLE} FROM full_g")
SQL["kg_analytics"] = graph(f"{TRIPLE} FROM small_g")
SQL["kg_closure"] = graph("SELECT child, parent FROM up")
SQL["kg_rdfs7"] = graph(f"{TRIPLE} FROM full_new")
SQL["kg_rdfs9"] = graph(f"{TRIPLE} FROM small_new")
SQL["kg_inferred_count"] = graph("SELECT 'full' AS table_name, count(*) AS n FROM full_new UNION ALL SELECT 'analytics', count(*) FROM small_new")
SQL["kg_validation"] = graph(f"""
SELECT (SELECT count(*) FROM canon) AS trusted_rows_processed, (SELECT count(DISTINCT s) FROM record_t) AS health_record_resources,
  (SELECT count(*) FROM cells) AS aggregate_measurements, (SELECT count(*) FROM full_g) AS triples,
  (SELECT count(DISTINCT source_dataset) FROM canon) AS datasets, (SELECT count(*) FROM records) AS health_record_count,
  (SELECT count(*) FROM (SELECT DISTINCT age_group_code, gender FROM canon)) AS population_group_count""")

# ---- patterns, answered from the tables instead of the triples --------------------------------------------------------------------
OUTCOME_LABEL = "CASE WHEN target THEN 'Heart disease positive' WHEN NOT target THEN 'Heart disease negative' ELSE 'Unknown outcome' END"
OUTCOME = f"indicator_id = '{V.OUTCOME_INDICATOR}'"
SQL["pat_01_entities"] = base(
    f"SELECT {REC_IRI} AS record, {D} AS dataset, {OUTCOME_LABEL} AS \"outcomeLabel\" FROM records WHERE age_group_code = 9 AND gender = 'female' ORDER BY record LIMIT 50")
SQL["pat_02_shared_indicators"] = base(
    f"SELECT {HR} || 'indicator/' || indicator_id AS indicator, indicator_label AS label, count(DISTINCT source_dataset) AS \"datasetCount\" "
    "FROM cells GROUP BY 1, 2 HAVING count(DISTINCT source_dataset) > 1")
SQL["pat_03_rank_groups"] = base(
    f"SELECT {GROUP_IRI} AS \"populationGroup\", {D} AS dataset, value AS \"positiveRate\", observations FROM cells WHERE {OUTCOME} AND observations >= 25 "
    "ORDER BY value DESC, observations DESC, 1, 2 LIMIT 20")
SQL["pat_04_combine_indicators"] = base(f"""
SELECT {GROUP_IRI.replace('age_group_code', 'c.age_group_code').replace('gender,', 'c.gender,')} AS "populationGroup", {HR} || 'dataset/' || c.source_dataset AS dataset, c.value AS "heartDiseaseRate", b.value AS "highBpRate", d.value AS "highCholesterolRate"
FROM (SELECT * FROM cells WHERE {OUTCOME}) c
LEFT JOIN (SELECT * FROM cells WHERE indicator_id = 'high-blood-pressure') b USING (source_dataset, age_group_code, gender)
LEFT JOIN (SELECT * FROM cells WHERE indicator_id = 'high-cholesterol') d USING (source_dataset, age_group_code, gender)
ORDER BY 3 DESC, 1, 2 LIMIT 50""")
MULTI = (f"SELECT {GROUP_IRI} AS \"populationGroup\", count(DISTINCT source_dataset) AS \"datasetCount\", count(*) AS \"recordCount\" FROM records "
         "GROUP BY age_group_code, gender HAVING count(DISTINCT source_dataset) > 1")
SQL["pat_05_multi_source_groups"] = base(MULTI)
SQL["pat_06_consistency"] = base(CONSISTENCY)
SQL["pat_07_outcome_by_age"] = base(AGE_RATES)


def _pairs() -> str:
    columns = sorted(V.RISK_COLUMNS.items(), key=lambda x: x[1])
    parts = []
    for a in range(len(columns)):
        for b in range(a + 1, len(columns)):
            parts.append(
                f"SELECT {q(V.BY_ID[columns[a][1]].label)} AS \"indicator1Label\", {q(V.BY_ID[columns[b][1]].label)} AS \"indicator2Label\", "
                f"count(*) AS \"coOccurringRecords\" FROM records WHERE target AND {columns[a][0]} AND {columns[b][0]}")
    return ("SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE \"coOccurringRecords\" > 0 ORDER BY \"coOccurringRecords\" DESC, 1, 2 LIMIT 20")


SQL["pat_08_cooccurrence"] = base(_pairs())
SQL["pat_09_inferred_factors"] = base("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {q(V.BY_ID[i].label)} AS \"factorLabel\", {q(V.BY_ID[i].category)} AS \"factorCategory\", count(*) AS \"recordCount\" FROM records WHERE target AND {c}"
    for _, c, i in FACTORS) + ") WHERE \"recordCount\" > 0")
SQL["pat_structure"] = base("""
SELECT 'datasets' AS class, count(DISTINCT source_dataset) AS instances FROM cells UNION ALL SELECT 'indicators', 17 UNION ALL
SELECT 'population_groups', count(DISTINCT (age_group_code, gender)) FROM cells UNION ALL SELECT 'age_groups', 13 UNION ALL SELECT 'genders', 3 UNION ALL
SELECT 'outcomes', 3 UNION ALL SELECT 'aggregate_measurements', count(*) FROM cells""")
SQL["pat_avg_rate"] = base(f"SELECT {GROUP_IRI} AS \"populationGroup\", round(avg(value), 6) AS \"avgRate\" FROM cells WHERE {OUTCOME} GROUP BY age_group_code, gender")
SQL["pat_00_match_join"] = base(f"SELECT {HR} || 'indicator/' || indicator_id AS indicator, {D} AS dataset, count(*) AS n FROM cells GROUP BY 1, 2")
SQL["pat_report_rows"] = base(
    f"SELECT count(*) AS rows_returned, CAST(least(count(*), 20) AS INTEGER) AS rows_shown, count(*) > 20 AS row_cap_applied FROM ({MULTI})")

# ---- vectors ----------------------------------------------------------------------------------------------------------------------
HELD = f"held AS (SELECT DISTINCT s FROM small_all WHERE p = {h('measuresIndicator')} AND o = {h('indicator/' + V.OUTCOME_INDICATOR)})"
LINKS = f"{HELD}, links AS (SELECT s, p, o FROM small_all WHERE o_kind = 'iri' AND s NOT IN (SELECT s FROM held) AND o NOT IN (SELECT s FROM held))"
EDGES = f"{LINKS}, edges AS (SELECT s AS l, p || '#predicate' AS r FROM links UNION ALL SELECT p || '#predicate', o FROM links)"


def graph_with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {BASE},\n{GRAPH},\n{ctes}\n{select}"


SQL["emb_iri_triples"] = graph_with(LINKS, "SELECT s, p, o FROM links")
SQL["emb_edges"] = graph_with(EDGES, "SELECT l AS \"left\", r AS \"right\" FROM edges")
SQL["emb_adjacency"] = graph_with(
    EDGES + ", both_ways AS (SELECT l AS i, r AS j FROM edges UNION SELECT r, l FROM edges), "
    "a AS (SELECT i, j, sum(w) AS w FROM (SELECT i, j, 1.0::DOUBLE AS w FROM both_ways UNION ALL SELECT DISTINCT i, i, 1.0::DOUBLE FROM both_ways) GROUP BY i, j), "
    "deg AS (SELECT i, greatest(sum(w), 1.0) AS d FROM a GROUP BY i)",
    "SELECT a.i, a.j, round(a.w / sqrt(x.d * y.d), 9) AS w FROM a JOIN deg x ON a.i = x.i JOIN deg y ON a.j = y.i")
SQL["emb_rank_metrics"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
asked AS (SELECT a.vec_id AS id, b.vec_id AS target, a.e AS e, list_inner_product(a.e, b.e) AS own FROM v a JOIN v b ON b.vec_id = a.vec_id + 1),
ranks AS (SELECT id, 1 + count(*) FILTER (WHERE v.vec_id <> target AND list_inner_product(asked.e, v.e) > own + 1e-9) AS r FROM asked, v GROUP BY id)
SELECT round(avg(1.0 / r), 9) AS mrr, round(avg(CASE WHEN r <= 10 THEN 1.0 ELSE 0.0 END), 9) AS hits_at_10, round(avg(r), 9) AS mean_rank,
  count(*) AS ranked FROM ranks"""
SQL["emb_rank_filtered"] = """
WITH v AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CASE WHEN x > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS e FROM embeddings),
asked AS (SELECT a.vec_id AS id, b.vec_id AS target, b.label AS wanted, a.e AS e, list_inner_product(a.e, b.e) AS own FROM v a JOIN v b ON b.vec_id = a.vec_id + 1),
ranks AS (SELECT id, 1 + sum(CASE WHEN v.vec_id = target OR v.label IS NOT DISTINCT FROM wanted THEN 0.0 WHEN list_inner_product(asked.e, v.e) > own + 1e-9 THEN 1.0
  WHEN abs(list_inner_product(asked.e, v.e) - own) <= 1e-9 THEN 0.5 ELSE 0.0 END) AS r FROM asked, v GROUP BY id)
SELECT round(avg(1.0 / r), 9) AS mrr, round(avg(CASE WHEN r <= 10 THEN 1.0 ELSE 0.0 END), 9) AS hits_at_10, round(avg(r), 9) AS mean_rank,
  count(*) AS ranked FROM ranks"""
SQL["emb_mean"] = """
WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS node, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
places AS (SELECT DISTINCT source, lang, unnest(range(64)) AS pos FROM documents),
m AS (SELECT source, lang, pos, avg(x) AS x FROM documents JOIN v ON CAST(doc_id AS VARCHAR) = node GROUP BY ALL)
SELECT source, lang, CAST(pos AS INTEGER) AS pos, round(coalesce(x, 0.0), 6) AS value FROM places LEFT JOIN m USING (source, lang, pos)"""
NODE_VEC = f"""
vec_nodes AS (SELECT DISTINCT s AS node FROM small_g WHERE (starts_with(s, {HR} || 'dataset/') OR starts_with(s, {HR} || 'population-group/')
  OR starts_with(s, {HR} || 'indicator/')) AND s <> {h('population-group/age-13/gender-male')}),
nv AS (SELECT node, CAST(embedding AS DOUBLE[]) AS e FROM vec_nodes JOIN embeddings
  ON vec_id = CAST('0x' || substr(md5(node), 1, 6) AS BIGINT) % (SELECT count(*) FROM embeddings))"""
ZERO = "list_transform(range(64), lambda x: 0.0::DOUBLE)"


def _mean_list(conditions: list[tuple[str, str]]) -> str:
    """Mean vector per row: weighted sum of at most 17 node vectors."""
    nodes = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {h('indicator/' + i)} END" for i, c in conditions) + "], lambda x: x IS NOT NULL)"
    return nodes


_OBS = _mean_list([(i, f"{c} IS NOT NULL") for c, i in V.OBSERVED_COLUMNS.items()])
_RISK = _mean_list([(i, c) for c, i in V.RISK_COLUMNS.items()])
_PROT = _mean_list([(i, c) for c, i in V.PROTECTIVE_COLUMNS.items()])


def _set_mean(name: str) -> str:
    """Means per distinct node set; sets are few because they range over the vocabulary."""
    return (f"{name}_set AS (SELECT DISTINCT {name} AS ns FROM rn), {name}_cells AS (SELECT ns, generate_subscripts(e, 1) AS k, unnest(e) AS x FROM "
            f"(SELECT ns, unnest(ns) AS node FROM {name}_set) JOIN nv USING (node)), {name}_avg AS (SELECT ns, k, avg(x) AS x FROM {name}_cells GROUP BY 1, 2), "
            f"{name}_mean AS (SELECT ns, list(x ORDER BY k) AS e FROM {name}_avg GROUP BY 1)")


KG_FEATURES = f"""{NODE_VEC},
rn AS MATERIALIZED (SELECT *, {D} AS dn, {GROUP_IRI} AS gn, {_OBS} AS obs, {_RISK} AS risk, {_PROT} AS prot FROM records WHERE target IS NOT NULL),
{_set_mean('obs')}, {_set_mean('risk')}, {_set_mean('prot')},
kinds AS MATERIALIZED (SELECT DISTINCT dn, gn, obs, risk, prot FROM rn),
f AS MATERIALIZED (SELECT dn, gn, obs, risk, prot, len(obs) AS n1, len(risk) AS n2, len(prot) AS n3,
  list_concat(d.e, g.e, coalesce(om.e, {ZERO}), coalesce(rm.e, {ZERO}), coalesce(pm.e, {ZERO}),
    list_transform(list_zip(d.e, g.e), lambda z: z[1] * z[2]), list_transform(list_zip(d.e, g.e), lambda z: abs(z[1] - z[2])),
    [len(obs)::DOUBLE, len(risk)::DOUBLE, len(prot)::DOUBLE]) AS x
  FROM kinds JOIN nv d ON d.node = dn JOIN nv g ON g.node = gn LEFT JOIN obs_mean om ON om.ns = obs LEFT JOIN risk_mean rm ON rm.ns = risk
  LEFT JOIN prot_mean pm ON pm.ns = prot),
sums AS MATERIALIZED (SELECT dn, gn, obs, risk, prot, n1, n2, n3, CAST(len(x) AS INTEGER) AS width, round(list_sum(x), 5) AS total,
  round(list_inner_product(x, list_transform(range(1, 452), lambda k: k::DOUBLE)), 4) AS weighted FROM f)"""
SQL["emb_kg_features"] = graph_with(KG_FEATURES, """
SELECT source_dataset, source_record_id, gn AS population_group, CAST(target AS INTEGER) AS target, CAST(n1 AS INTEGER) AS observed_indicator_count,
  CAST(n2 AS INTEGER) AS risk_indicator_count, CAST(n3 AS INTEGER) AS protective_indicator_count, width, total, weighted
FROM rn JOIN sums USING (dn, gn, obs, risk, prot)""")
_TAB = ", ".join(f"CAST({c} AS DOUBLE) AS tab_{c}" for c in (*V.ENRICHED_NUMERIC, *V.HYBRID_BINARY))
SQL["emb_hybrid_features"] = graph_with(f"""{NODE_VEC},
rn AS MATERIALIZED (SELECT *, {D} AS dn, {GROUP_IRI} AS gn FROM records WHERE target IS NOT NULL),
hf AS (SELECT dn, gn, coalesce(d.e, {ZERO}) AS de, coalesce(g.e, {ZERO}) AS ge FROM (SELECT DISTINCT dn, gn FROM rn)
  LEFT JOIN nv d ON d.node = dn LEFT JOIN nv g ON g.node = gn),
hx AS MATERIALIZED (SELECT dn, gn, list_concat(ge, de, list_transform(list_zip(ge, de), lambda z: z[1] * z[2])) AS x FROM hf),
sums AS MATERIALIZED (SELECT dn, gn, CAST(len(x) AS INTEGER) AS width, round(list_sum(x), 5) AS total,
  round(list_inner_product(x, list_transform(range(1, 193), lambda k: k::DOUBLE)), 4) AS weighted FROM hx)""", f"""
SELECT source_dataset, source_record_id, CAST(target AS INTEGER) AS target, {_TAB}, width, total, weighted
FROM rn LEFT JOIN sums ON sums.dn = rn.dn AND sums.gn IS NOT DISTINCT FROM rn.gn""")

# ---- sampling -------------------------------------------------------------------------------------------------------------------------
HASH = f"md5(source_dataset || '|' || source_record_id || '|' || record_ordinal || '|{V.SEED}')"
SQL["smp_stratified"] = base(f"""
SELECT source_dataset, source_record_id, target FROM (SELECT *, row_number() OVER (PARTITION BY source_dataset, target ORDER BY {HASH}) AS r,
  count(*) OVER (PARTITION BY source_dataset, target) AS n, count(*) OVER () AS total FROM records)
WHERE r <= greatest(1, round_even(n * 5000.0 / total, 0)) OR total <= 5000""")
SQL["smp_trimmed"] = base(f"""
SELECT source_dataset, source_record_id, target FROM (SELECT *, row_number() OVER (ORDER BY {HASH}) AS r2 FROM (SELECT *,
  row_number() OVER (PARTITION BY source_dataset, target, age_group_code ORDER BY {HASH}) AS r,
  count(*) OVER (PARTITION BY source_dataset, target, age_group_code) AS n, count(*) OVER () AS total FROM records)
WHERE r <= greatest(1, round_even(n * 999.0 / total, 0)) OR total <= 999) WHERE r2 <= 999 OR total <= 999""")
SQL["smp_split"] = base(f"""
SELECT source_dataset, source_record_id, target, r <= round(n * 0.2) AS is_test FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {HASH}) AS r,
  count(*) OVER (PARTITION BY target) AS n FROM records)""")
SQL["smp_folds"] = base(f"""
SELECT source_dataset, source_record_id, target, CAST((row_number() OVER (PARTITION BY target ORDER BY {HASH}) - 1) % 3 AS INTEGER) AS fold FROM records""")
SQL["smp_class_weights"] = base("""
SELECT target, rows, round(total::DOUBLE / (classes * rows), 9) AS weight FROM (SELECT target, count(*) AS rows FROM canon GROUP BY 1),
  (SELECT count(*) AS total, count(DISTINCT target) AS classes FROM canon)""")
SQL["smp_model_frame"] = base("SELECT source_dataset, source_record_id, " + ", ".join(
    [f"CAST({c} AS DOUBLE) AS {c}" for c in V.ENRICHED_NUMERIC] + [f"CAST({c} AS VARCHAR) AS {c}" for c in V.ENRICHED_CATEGORICAL])
    + ", CAST(target AS INTEGER) AS target FROM canon WHERE target IS NOT NULL")
SQL["smp_impute_stats"] = base(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(m, 6) AS median, round(avg(coalesce({c}, m)), 6) AS mean, round(stddev_pop(coalesce({c}, m)), 6) AS deviation "
    f"FROM canon, (SELECT median({c}) AS m FROM canon) GROUP BY m" for c in ("age_years_proxy", "bmi", "systolic_bp", "diastolic_bp")))
SQL["smp_level_modes"] = base(" UNION ALL ".join(
    f"(SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS mode FROM canon WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)"
    for c in V.CORE_CATEGORICAL))
SQL["smp_class_guard"] = base("""
SELECT source_dataset, least(p, n) AS smallest, least(p, n) > 0 AS two_classes, least(p, n) >= 2 AS can_stratify FROM (
  SELECT source_dataset, count(*) FILTER (WHERE target) AS p, count(*) FILTER (WHERE NOT target) AS n FROM canon GROUP BY 1)""")

# ---- evaluation ---------------------------------------------------------------------------------------------------------------------------
SCORED = "scored AS (SELECT source_dataset, CAST(target AS INTEGER) AS y, coalesce(systolic_bp, bmi * 5) / 300.0 AS p FROM canon)"


def curve(part: str = "", source: str = "scored") -> str:
    """Per distinct score: positives, negatives, and both counted from the top and from below."""
    by = f"PARTITION BY {part} " if part else ""
    group = f"{part}, " if part else ""
    return (f"pts AS (SELECT {group}p, sum(y) AS pos, sum(1 - y) AS neg FROM {source} WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY {group}p), "
            f"curve AS (SELECT *, sum(pos) OVER ({by}ORDER BY p DESC) AS tp, sum(neg) OVER ({by}ORDER BY p DESC) AS fp, "
            f"sum(pos) OVER ({by.strip()}) AS P_, sum(neg) OVER ({by.strip()}) AS N_ FROM pts)")


AUC = "CAST(sum(pos * (2 * (N_ - fp) + neg)) AS DOUBLE) / nullif(2.0 * max(P_) * max(N_), 0)"
AP = "CASE WHEN max(P_) > 0 AND max(N_) > 0 THEN sum((pos::DOUBLE / P_) * (tp::DOUBLE / (tp + fp))) END"


def ev(ctes: str, select: str) -> str:
    return base("").rstrip() + f",\n{SCORED}, {ctes}\n{select}"


F1 = "(2.0 * (tp::DOUBLE / (tp + fp)) * (tp::DOUBLE / P_)) / ((tp::DOUBLE / (tp + fp)) + (tp::DOUBLE / P_) + 1e-12)"
SQL["ev_threshold"] = ev(curve(), f"SELECT round(p, 9) AS threshold FROM curve ORDER BY {F1} DESC, p LIMIT 1")
CONF = ("conf AS (SELECT count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp, "
        "count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp FROM scored)")
SQL["ev_confusion"] = ev(CONF, "SELECT * FROM conf")
POINT = ("round((tp + tn)::DOUBLE / (tn + fp + fn + tp), 9) AS accuracy, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 9) AS precision, "
         "round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1")
SQL["ev_point_metrics"] = ev(CONF, f"SELECT {POINT} FROM conf")
SQL["ev_roc_auc"] = ev(curve(), f"SELECT round({AUC}, 9) AS roc_auc FROM curve")
SQL["ev_average_precision"] = ev(curve(), f"SELECT round({AP}, 9) AS pr_auc FROM curve")
SQL["ev_documents"] = f"""
WITH scored AS (SELECT toxic AS y, n_chars::DOUBLE AS p FROM labels JOIN documents USING (doc_id)), {curve()},
conf AS (SELECT count(*) FILTER (WHERE y = 0 AND p < 1000) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 1000) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < 1000) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 1000) AS tp FROM scored)
SELECT {POINT}, (SELECT round({AUC}, 9) FROM curve) AS roc_auc, (SELECT round({AP}, 9) FROM curve) AS pr_auc FROM conf"""
ROLE = "CASE source_dataset WHEN 'orders' THEN 'tabular_core' WHEN 'lineitem' THEN 'tabular_enriched' ELSE 'kg_embedding' END"
COMPARE = (curve("source_dataset") + ", conf AS (SELECT source_dataset, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp, "
           "count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp FROM scored GROUP BY 1), "
           f"areas AS (SELECT source_dataset, round({AUC}, 9) AS roc_auc, round({AP}, 9) AS pr_auc FROM curve GROUP BY 1), "
           f"cmp AS (SELECT {ROLE} AS pipeline, source_dataset AS model, {POINT}, roc_auc, pr_auc FROM conf JOIN areas USING (source_dataset))")
LONG = ", long_t AS (" + " UNION ALL ".join(f"SELECT pipeline, '{m}' AS metric, {m} AS value FROM cmp" for m in V.METRIC_KEYS) + ")"
SQL["ev_comparison"] = ev(COMPARE, "SELECT * FROM cmp")
SQL["ev_best_per_metric"] = ev(COMPARE + LONG, """
SELECT metric, pipeline AS best_pipeline, value FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC,
  CASE pipeline WHEN 'tabular_core' THEN 1 WHEN 'tabular_enriched' THEN 2 ELSE 3 END) AS r FROM long_t WHERE value IS NOT NULL) WHERE r = 1""")
SQL["ev_deltas"] = ev(COMPARE + LONG, """
SELECT c.metric, b.pipeline AS baseline, round(c.value, 4) AS kg_value, round(b.value, 4) AS tabular_value, round(c.value - b.value, 4) AS delta,
  c.value > b.value AS kg_wins, CASE WHEN b.value > 0 THEN round((c.value - b.value) / b.value * 100.0, 2) END AS change_pct
FROM long_t c JOIN long_t b ON c.metric = b.metric WHERE c.pipeline = 'kg_embedding'
  AND b.pipeline = (SELECT pipeline FROM cmp WHERE starts_with(pipeline, 'tabular') ORDER BY f1 DESC, pipeline LIMIT 1)""")
SQL["ev_cv_table"] = base("""
SELECT source_dataset AS pipeline, gender AS model, round(avg(CAST(target AS DOUBLE)), 6) AS cv_score_mean,
  round(avg(CAST(high_cholesterol_flag AS DOUBLE)), 6) AS cv_score_std, CASE WHEN source_dataset = 'orders' THEN 'roc_auc' ELSE 'pr_auc' END AS scoring
FROM canon GROUP BY source_dataset, gender""")

# ---- sources and streams ---------------------------------------------------------------------------------------------------------------------
SQL["io_snapshot_latest"] = "SELECT * FROM supplier"
_DOC = f"{HR} || 'document/' || doc_id"
SQL["io_ntriples_roundtrip"] = " UNION ALL ".join([
    lit_t(_DOC, q(V.RDFS_COMMENT), "text", "NULL", "FROM documents"),
    lit_t(_DOC, h("observationCount"), "CAST(n_chars AS VARCHAR)", INT, "FROM documents"), iri_t(_DOC, TYPE, h("Dataset"), "FROM documents")])
SQL["st_ingest_contract"] = base("SELECT rule_name, total_rows, violations FROM quality WHERE dataset = 'events'")
SQL["st_ingest_unique"] = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS rule_name, count(*) AS total_rows, count(*) FILTER (WHERE NOT coalesce({sql}, false)) AS violations FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM (
    SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS record_key, CAST(floor(l_quantity * 2) AS INTEGER) AS age_years,
      CASE l_linestatus WHEN 'F' THEN 'female' WHEN 'O' THEN 'male' END AS gender, l_quantity * 4 + 60 AS resting_bp,
      l_returnflag = 'R' AS has_condition, {band_of('CAST(floor(l_quantity * 2) AS INTEGER)')} AS age_group_code FROM lineitem))"""
    for name, _, sql in RULES["lineitem"])
SQL["io_ntriples_odd"] = """
SELECT '_:d' || doc_id AS s, 'urn:in' AS p, '_:' || source AS o, 'iri' AS o_kind, NULL AS o_type FROM documents
UNION ALL SELECT 'urn:d:' || doc_id, 'urn:lang', 'urn:l:' || lang, 'iri', NULL FROM documents
UNION ALL SELECT 'urn:d:' || doc_id, 'urn:note', 'é ' || chr(92) || source, 'literal', '@' || lang FROM documents
UNION ALL SELECT 'malformed', 'urn:line', '<urn:d:' || doc_id || '> broken ' || source, 'literal', NULL FROM documents"""

# ---- other ways to results above ------------------------------------------------------------------------------------------------------
SQL["hz_measurements_merged"], SQL["hz_profile_merged"] = SQL["hz_measurements"], SQL["hz_profile"]
SQL["kg_incremental"], SQL["kg_by_numbers"], SQL["pat_by_subject"] = SQL["kg_rdfs7"], SQL["kg_rdfs7"], SQL["pat_05_multi_source_groups"]
SQL["dq_one_write"], SQL["dq_one_write_quarantine"] = SQL["dq_rule_metrics"], SQL["dq_quarantine"]
SQL["io_published"] = "SELECT * FROM supplier"

# ---- scalars over given columns -------------------------------------------------------------------------------------------------------
SQL["sc_flags_of_text"] = r"""
WITH w AS (SELECT 'event' AS kind, event_id AS id, regexp_extract(props, '"k": *([^,}]*)', 1) AS word FROM events
  UNION ALL SELECT 'document', doc_id, regexp_extract(text, '^[ \t\n\x0B\f\r]*([^ \t\n\x0B\f\r]+)', 1) FROM documents WHERE text IS NOT NULL),
l AS (SELECT kind, id, lower(trim(word)) AS t, CASE WHEN regexp_full_match(trim(word), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[dDfF]?')
  THEN CAST(regexp_replace(trim(word), '[dDfF]$', '') AS DOUBLE) END AS x FROM w),
m AS (SELECT *, CASE WHEN regexp_full_match(t, '-?[0-9]+([.][0-9]+)?') THEN CAST(t AS DOUBLE) END AS n FROM l)
SELECT kind, id, CASE WHEN t IN ('1', '1.0', 'true', 'yes', 'y') THEN true WHEN t IN ('0', '0.0', 'false', 'no', 'n') THEN false END AS flag,
  CASE WHEN n > 0 THEN true WHEN n = 0 THEN false WHEN t IN ('true', 'yes', 'y') THEN true WHEN t IN ('false', 'no', 'n') THEN false END AS flag_or_positive,
  x AS number, CASE WHEN abs(x) < 2147483648 THEN CAST(trunc(x) AS INTEGER) END AS whole FROM m"""
_K = "CAST(regexp_extract(props, '\"k\": *([^,}]*)', 1) AS INTEGER)"
SQL["sc_bands_of_text"] = f"SELECT event_id, band, CAST({midpoint_of('band')} AS DOUBLE) AS midpoint FROM (SELECT event_id, {_K} AS band FROM events)"
_KIND = "CASE " + " ".join(f"WHEN starts_with(node, {HR} || '{prefix}') THEN '{kind}'" for prefix, kind in V.NODE_KINDS) + (
    f" WHEN contains(node, '{V.PREDICATE_MARK}') THEN 'predicate' ELSE 'other' END")
SQL["sc_kinds_of_graph"] = graph(
    f"SELECT {_KIND} AS kind, count(*) AS nodes FROM (SELECT s AS node FROM full_g UNION SELECT o FROM full_g WHERE o_kind = 'iri') GROUP BY 1")
