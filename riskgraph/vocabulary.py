"""Fixed values of the data model: names, labels and codes that results must carry.

Nothing here computes; the operators read these tables.
"""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: namespaces -------------------------------------------------------------------
HR = "https://example.org/bda/health-risk/"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCTERMS = "http://purl.org/dc/terms/"

RDF_TYPE = RDF + "type"
RDF_PROPERTY = RDF + "Property"
RDFS_CLASS = RDFS + "Class"
RDFS_LABEL = RDFS + "label"
RDFS_COMMENT = RDFS + "comment"
RDFS_DOMAIN = RDFS + "domain"
RDFS_RANGE = RDFS + "range"
RDFS_SUBCLASS = RDFS + "subClassOf"
RDFS_SUBPROPERTY = RDFS + "subPropertyOf"

# --- fixed values: source datasets --------------------------------------------------------------
CARDIO = "cardiovascular_disease"
CDC = "heart_disease_health_indicators"
CLEVELAND = "heart_disease_cleveland"
REQUIRED_SOURCES = (CARDIO, CDC, CLEVELAND)


class Indicator(NamedTuple):
    id: str
    column: str
    label: str
    kind: str
    category: str


# --- fixed values: the 17 indicators of the common vocabulary -----------------------------------
INDICATORS = (
    Indicator("age-years", "age_years_proxy", "Age in years or age-band proxy", "numeric", "demographic"),
    Indicator("body-mass-index", "bmi", "Body mass index", "numeric", "anthropometric"),
    Indicator("systolic-blood-pressure", "systolic_bp", "Systolic blood pressure", "numeric", "clinical"),
    Indicator("diastolic-blood-pressure", "diastolic_bp", "Diastolic blood pressure", "numeric", "clinical"),
    Indicator("high-blood-pressure", "high_blood_pressure_flag", "High blood pressure flag", "boolean", "risk-factor"),
    Indicator("high-cholesterol", "high_cholesterol_flag", "High cholesterol flag", "boolean", "risk-factor"),
    Indicator("glucose-risk", "glucose_risk_flag", "Glucose risk flag", "boolean", "risk-factor"),
    Indicator("smoking", "smoking_flag", "Smoking flag", "boolean", "behavior"),
    Indicator("physical-activity", "physical_activity_flag", "Physical activity flag", "boolean", "behavior"),
    Indicator("heavy-alcohol", "heavy_alcohol_flag", "Heavy alcohol consumption flag", "boolean", "behavior"),
    Indicator("general-health-score", "general_health_score", "General health score", "numeric", "self-reported-health"),
    Indicator("mental-unhealthy-days", "mental_unhealthy_days", "Mental unhealthy days", "numeric", "self-reported-health"),
    Indicator("physical-unhealthy-days", "physical_unhealthy_days", "Physical unhealthy days", "numeric", "self-reported-health"),
    Indicator("difficulty-walking", "difficulty_walking_flag", "Difficulty walking flag", "boolean", "functional-health"),
    Indicator("maximum-heart-rate", "max_heart_rate", "Maximum heart rate", "numeric", "clinical"),
    Indicator("exercise-induced-angina", "exercise_induced_angina", "Exercise-induced angina flag", "boolean", "clinical"),
    Indicator("heart-disease-outcome", "target", "Heart disease outcome", "boolean", "outcome"),
)
OUTCOME_INDICATOR = "heart-disease-outcome"

# --- fixed values: indicators counted as risk and as protective factors of a record --------------
RISK_FACTOR_IDS = (
    "high-blood-pressure", "high-cholesterol", "glucose-risk", "smoking", "heavy-alcohol", "difficulty-walking",
    "exercise-induced-angina",
)
PROTECTIVE_FACTOR_IDS = ("physical-activity",)

BY_ID = {i.id: i for i in INDICATORS}
RISK_COLUMNS = {BY_ID[i].column: i for i in RISK_FACTOR_IDS}
PROTECTIVE_COLUMNS = {BY_ID[i].column: i for i in PROTECTIVE_FACTOR_IDS}
OBSERVED_COLUMNS = {i.column: i.id for i in INDICATORS if i.id != OUTCOME_INDICATOR}

# --- fixed values: age bands 1..13 (label, midpoint) ------------------------------------------------
AGE_BAND_LABELS = (
    "18 to 24", "25 to 29", "30 to 34", "35 to 39", "40 to 44", "45 to 49", "50 to 54", "55 to 59", "60 to 64",
    "65 to 69", "70 to 74", "75 to 79", "80 or older",
)
AGE_BANDS = 13
AGE_BAND_MIDPOINTS = (21.0,) + tuple(float(m) for m in range(27, 87, 5))

GENDERS = ("female", "male", "unknown")

# --- fixed values: outcome concepts ---------------------------------------------------------------
OUTCOMES = (
    ("outcome/heart-disease-positive", "Heart disease positive"),
    ("outcome/heart-disease-negative", "Heart disease negative"),
    ("outcome/unknown", "Unknown outcome"),
)

# --- fixed values: classes and their labels (the last four are abstract) --------------------------
CLASSES = (
    ("KnowledgeGraphRun", "Knowledge graph generation run"),
    ("Dataset", "Trusted Zone source dataset"),
    ("HealthRecord", "Cleaned health record instance from a trusted dataset"),
    ("PopulationGroup", "Shared demographic group used to connect records across datasets"),
    ("AgeGroup", "Controlled age-band concept"),
    ("Gender", "Controlled gender concept"),
    ("Indicator", "Shared health indicator in the common vocabulary"),
    ("AggregateMeasurement", "Dataset and population-level aggregate measurement"),
    ("Outcome", "Controlled health outcome concept"),
    ("Concept", "Abstract super-class for all shared vocabulary concepts"),
    ("DemographicConcept", "Abstract demographic concept (age, gender, population group)"),
    ("HealthConcept", "Abstract health concept (indicators and outcomes)"),
    ("Observation", "Abstract super-class for record-level and aggregate observations"),
)

# --- fixed values: class hierarchy, child -> parent -----------------------------------------------
SUBCLASS_OF = (
    ("DemographicConcept", "Concept"),
    ("HealthConcept", "Concept"),
    ("AgeGroup", "DemographicConcept"),
    ("Gender", "DemographicConcept"),
    ("PopulationGroup", "DemographicConcept"),
    ("Indicator", "HealthConcept"),
    ("Outcome", "HealthConcept"),
    ("HealthRecord", "Observation"),
    ("AggregateMeasurement", "Observation"),
)

# --- fixed values: object properties (name, domain, range, comment) -------------------------------
OBJECT_PROPERTIES = (
    ("fromDataset", "HealthRecord", "Dataset", "links a record or aggregate to its trusted source dataset"),
    ("belongsToAgeGroup", "HealthRecord", "AgeGroup", "links a record to a shared age group"),
    ("hasGender", "HealthRecord", "Gender", "links a record to a shared gender concept"),
    ("belongsToPopulationGroup", "HealthRecord", "PopulationGroup", "links a record to its shared demographic group"),
    ("populationGroupAgeGroup", "PopulationGroup", "AgeGroup", "links a population group to its age band"),
    ("populationGroupGender", "PopulationGroup", "Gender", "links a population group to its gender concept"),
    ("hasOutcome", "HealthRecord", "Outcome", "links a record to the controlled disease outcome concept"),
    ("measuresIndicator", "AggregateMeasurement", "Indicator", "links an aggregate measurement to the shared indicator it measures"),
    ("forPopulationGroup", "AggregateMeasurement", "PopulationGroup", "links an aggregate measurement to its population group"),
    ("hasAggregateMeasurement", "PopulationGroup", "AggregateMeasurement", "links a population group to aggregate measurements"),
    ("hasObservedRiskFactor", "HealthRecord", "Indicator", "links a record to a true risk-factor indicator"),
    ("hasObservedProtectiveFactor", "HealthRecord", "Indicator", "links a record to a true protective indicator"),
    ("generatedGraph", "KnowledgeGraphRun", "Dataset", "documents graph generation provenance"),
    ("belongsToDemographicConcept", "HealthRecord", "DemographicConcept", "super-property linking a record to any demographic concept"),
    ("hasObservedFactor", "HealthRecord", "Indicator", "super-property linking a record to any observed (risk or protective) factor"),
)

# --- fixed values: property hierarchy, child -> parent --------------------------------------------
SUBPROPERTY_OF = (
    ("hasObservedRiskFactor", "hasObservedFactor"),
    ("hasObservedProtectiveFactor", "hasObservedFactor"),
    ("belongsToAgeGroup", "belongsToDemographicConcept"),
    ("hasGender", "belongsToDemographicConcept"),
    ("belongsToPopulationGroup", "belongsToDemographicConcept"),
)

# --- fixed values: data properties (name, domain, xsd range, comment) ------------------------------
DATA_PROPERTIES = (
    ("sourceRecordId", "HealthRecord", "string", "original trusted record identifier"),
    ("recordOrdinal", "HealthRecord", "integer", "row ordinal within the generated KG run, used to preserve repeated trusted records"),
    ("sourceDatasetName", "HealthRecord", "string", "source dataset name"),
    ("runId", "KnowledgeGraphRun", "string", "pipeline run identifier"),
    ("createdAtUtc", "KnowledgeGraphRun", "dateTime", "UTC creation timestamp"),
    ("indicatorColumn", "Indicator", "string", "canonical analytical column mapped to the indicator"),
    ("indicatorCategory", "Indicator", "string", "semantic category of the indicator"),
    ("valueKind", "Indicator", "string", "numeric or boolean indicator value kind"),
    ("ageGroupCode", "AgeGroup", "integer", "controlled age-band code"),
    ("observationCount", "AggregateMeasurement", "integer", "number of trusted records behind the aggregate"),
    ("meanValue", "AggregateMeasurement", "double", "average value for numeric indicators"),
    ("positiveRate", "AggregateMeasurement", "double", "true-rate for boolean indicators"),
    ("rowsTotal", "Dataset", "integer", "number of records in the integrated exploitation table"),
    ("targetPositiveRate", "Dataset", "double", "source-level positive target rate"),
)

# --- fixed values: IRI prefix -> node kind ---------------------------------------------------------
NODE_KINDS = (
    ("dataset/", "dataset"),
    ("indicator/", "indicator"),
    ("population-group/", "population_group"),
    ("age-group/", "age_group"),
    ("gender/", "gender"),
    ("outcome/", "outcome"),
    ("aggregate-measurement/", "aggregate"),
)
PREDICATE_MARK = "#predicate"

# --- fixed values: canonical columns and their types ----------------------------------------------
CANONICAL_COLUMNS = (
    ("source_dataset", "string"), ("source_record_id", "string"), ("age_years_proxy", "double"),
    ("age_group_code", "int"), ("gender", "string"), ("bmi", "double"), ("systolic_bp", "double"),
    ("diastolic_bp", "double"), ("high_blood_pressure_flag", "boolean"), ("high_cholesterol_flag", "boolean"),
    ("glucose_risk_flag", "boolean"), ("smoking_flag", "boolean"), ("physical_activity_flag", "boolean"),
    ("heavy_alcohol_flag", "boolean"), ("general_health_score", "int"), ("mental_unhealthy_days", "double"),
    ("physical_unhealthy_days", "double"), ("difficulty_walking_flag", "boolean"), ("max_heart_rate", "double"),
    ("exercise_induced_angina", "boolean"), ("target", "boolean"), ("trusted_run_id", "string"),
    ("trusted_processed_at_utc", "string"), ("exploitation_run_id", "string"),
    ("exploitation_created_at_utc", "string"),
)

# --- fixed values: model feature lists ---------------------------------------------------------------
CORE_NUMERIC = ("age_years_proxy", "bmi")
CORE_CATEGORICAL = (
    "gender", "high_blood_pressure_flag", "high_cholesterol_flag", "glucose_risk_flag", "smoking_flag",
    "physical_activity_flag", "heavy_alcohol_flag",
)
ENRICHED_NUMERIC = (
    "age_years_proxy", "bmi", "systolic_bp", "diastolic_bp", "general_health_score", "mental_unhealthy_days",
    "physical_unhealthy_days", "max_heart_rate",
)
ENRICHED_CATEGORICAL = CORE_CATEGORICAL + ("difficulty_walking_flag", "exercise_induced_angina")
HYBRID_BINARY = ENRICHED_CATEGORICAL[1:]

METRIC_KEYS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
SEED = 42
EMBEDDING_DIM = 32
MAX_SAMPLE_ROWS = 30000
MIN_GROUP_OBSERVATIONS = 25


def hr(name: str) -> str:
    """Full IRI of a name in the graph namespace."""
    return HR + name
