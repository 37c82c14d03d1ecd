"""Column layouts and code lists."""

from __future__ import annotations

RESOURCE_TYPES = ("Patient", "Encounter", "Condition", "Observation", "Claim")

# --- JSON shapes (read with from_json, never inferred) ----------------------

_CODING = "array<struct<system:string,code:string,display:string>>"
_CONCEPT = f"struct<coding:{_CODING},text:string>"
_REFERENCE = "struct<reference:string,display:string>"
_PERIOD = "struct<start:string,`end`:string>"
# Amounts stay text here: a wrong-typed number must become null on its own
# instead of nulling the record, and the text is needed for messages.
_AMOUNT = "struct<value:string,currency:string>"

BUNDLE_JSON = (
    "resourceType string, id string, "
    "entry array<struct<fullUrl:string,resource:string>>, _corrupt string"
)

ENVELOPE_JSON = "id string, meta struct<versionId:string,lastUpdated:string>"

RESOURCE_JSON = {
    "Patient": (
        "id string, active boolean, gender string, birthDate string, "
        "identifier array<struct<use:string,system:string,value:string>>, "
        "name array<struct<use:string,family:string,given:array<string>>>, "
        "telecom array<struct<system:string,value:string,use:string>>, "
        "address array<struct<use:string,line:array<string>,city:string,"
        "state:string,postalCode:string,country:string>>, "
        f"maritalStatus {_CONCEPT}, "
        f"communication array<struct<language:{_CONCEPT},preferred:boolean>>"
    ),
    "Encounter": (
        f"id string, status string, class struct<code:string>, type array<{_CONCEPT}>, "
        f"subject {_REFERENCE}, period {_PERIOD}, reasonCode array<{_CONCEPT}>, "
        f"hospitalization struct<admitSource:{_CONCEPT},dischargeDisposition:{_CONCEPT}>, "
        f"serviceProvider {_REFERENCE}"
    ),
    "Condition": (
        f"id string, clinicalStatus {_CONCEPT}, verificationStatus {_CONCEPT}, "
        f"category array<{_CONCEPT}>, code {_CONCEPT}, subject {_REFERENCE}, "
        "onsetDateTime string, abatementDateTime string, recordedDate string"
    ),
    "Observation": (
        f"id string, status string, category array<{_CONCEPT}>, code {_CONCEPT}, "
        f"subject {_REFERENCE}, encounter {_REFERENCE}, effectiveDateTime string, "
        "valueQuantity struct<value:string,unit:string,code:string>, "
        f"referenceRange array<struct<text:string>>, interpretation array<{_CONCEPT}>"
    ),
    "Claim": (
        f"id string, status string, type {_CONCEPT}, use string, patient {_REFERENCE}, "
        f"billablePeriod {_PERIOD}, created string, total {_AMOUNT}, "
        f"item array<struct<productOrService:{_CONCEPT},net:{_AMOUNT}>>"
    ),
}

# Top-level fields whose JSON type matters to a rule, kept as VARIANT.
RULE_JSON = ", ".join(
    f"{name} variant"
    for name in (
        "resourceType", "id", "status", "subject", "patient", "name", "birthDate",
        "gender", "class", "period", "clinicalStatus", "code", "onsetDateTime",
        "abatementDateTime", "effectiveDateTime", "valueQuantity", "type",
        "billablePeriod", "total", "identifier", "telecom", "use", "encounter",
    )
)

# --- table layouts ----------------------------------------------------------

LINEAGE = ("source_file", "bundle_id", "ingestion_timestamp", "pipeline_run_id")
_LINEAGE_DDL = ", ".join(f"{c} string" for c in LINEAGE)


def _strings(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


BRONZE = _strings(
    "resource_id resource_type version_id last_updated source_file bundle_id full_url "
    "ingestion_timestamp ingestion_date pipeline_run_id raw_json"
)
BRONZE_COLUMNS = tuple(part.split()[0] for part in BRONZE.split(", "))

SILVER = {
    "patient": _strings(
        "patient_id mrn first_name middle_name family_name full_name gender birth_date"
    )
    + ", active boolean, "
    + _strings(
        "address_line1 address_line2 city state postal_code country phone email "
        "marital_status_code preferred_language"
    )
    + ", " + _LINEAGE_DDL,
    "encounter": _strings(
        "encounter_id patient_id status encounter_class type_code type_display "
        "period_start period_end"
    )
    + ", length_of_stay_hours double, "
    + _strings(
        "reason_code reason_display admit_source_code discharge_disposition_code "
        "service_provider"
    )
    + ", " + _LINEAGE_DDL,
    "condition": _strings(
        "condition_id patient_id clinical_status verification_status category "
        "condition_code condition_display onset_date abatement_date recorded_date"
    )
    + ", is_active boolean, " + _LINEAGE_DDL,
    "observation": _strings(
        "observation_id patient_id encounter_id status category loinc_code observation_name"
    )
    + ", value double, "
    + _strings(
        "unit unit_code effective_date effective_datetime interpretation reference_range"
    )
    + ", " + _LINEAGE_DDL,
    "claim": _strings(
        "claim_id patient_id status claim_type claim_type_display use "
        "billable_period_start billable_period_end created_date"
    )
    + ", total_amount double, currency string, line_item_count bigint, "
    "line_item_total double, primary_cpt_code string, " + _LINEAGE_DDL,
}

GOLD = {
    "patient_encounter_summary": (
        "patient_id string, total_encounters bigint, amb_encounters bigint, "
        "imp_encounters bigint, emer_encounters bigint, avg_los_hours double, "
        "max_los_hours double, min_los_hours double, latest_encounter_date string, "
        "earliest_encounter_date string, full_name string, gender string, "
        "birth_date string, gold_created_at string"
    ),
    "patient_condition_profile": (
        "patient_id string, total_conditions bigint, active_condition_count bigint, "
        "chronic_condition_count bigint, has_chronic_condition boolean, "
        "active_icd_codes string, active_condition_names string, "
        "earliest_condition_onset string, most_recent_condition_onset string, "
        "full_name string, gender string, birth_date string, gold_created_at string"
    ),
    "claims_financial_summary": (
        "patient_id string, total_claims bigint, total_billed double, "
        "avg_claim_value double, max_claim_value double, min_claim_value double, "
        "professional_claims bigint, institutional_claims bigint, "
        "latest_claim_date string, earliest_claim_date string, full_name string, "
        "gender string, gold_created_at string"
    ),
    "monthly_utilization_trends": (
        "year_month string, encounter_class string, status string, "
        "encounter_count bigint, avg_los_hours double, total_los_hours double, "
        "gold_created_at string"
    ),
}

RUN_LOG = (
    "run_id string, stage string, status string, records bigint, created_at string"
)
QUALITY_LOG = (
    "run_id string, resource_type string, record_count bigint, quality_score double, "
    "completeness double, conformity double, consistency double, uniqueness double, "
    "passed_threshold boolean, evaluated_at string"
)
FILE_LEDGER = (
    "path string, processed_at timestamp_ntz, pipeline_run_id string, record_count bigint"
)
WATERMARK_LEDGER = (
    "source_key string, last_processed timestamp_ntz, updated_at timestamp_ntz, "
    "last_run_id string, files_processed bigint, is_reset boolean"
)

# --- fixed values: FHIR R4 code lists and documented thresholds -------------

GENDERS = ("male", "female", "other", "unknown")
ENCOUNTER_STATUSES = (
    "planned", "arrived", "triaged", "in-progress", "onleave",
    "finished", "cancelled", "entered-in-error", "unknown",
)
ENCOUNTER_CLASSES = (
    "AMB", "EMER", "IMP", "ACUTE", "NONAC", "OBSENC", "PRENC", "SS", "VR",
)
OBSERVATION_STATUSES = (
    "registered", "preliminary", "final", "amended", "corrected",
    "cancelled", "entered-in-error", "unknown",
)
CLAIM_STATUSES = ("active", "cancelled", "draft", "entered-in-error")
CLINICAL_STATUSES = (
    "active", "recurrence", "relapse", "inactive", "remission", "resolved",
)
ACTIVE_CLINICAL_STATUSES = ("active", "recurrence", "relapse")
IDENTIFIER_USES = ("usual", "official", "temp", "secondary", "old")
TELECOM_SYSTEMS = ("phone", "fax", "email", "pager", "url", "sms", "other")
TELECOM_USES = ("home", "work", "temp", "old", "mobile")
CLAIM_USES = ("claim", "preauthorization", "predetermination")

REQUIRED_FIELDS = {
    "Patient": ("id", "resourceType"),
    "Encounter": ("id", "resourceType", "status", "subject"),
    "Condition": ("id", "resourceType", "subject"),
    "Observation": ("id", "resourceType", "status", "subject"),
    "Claim": ("id", "resourceType", "status", "patient"),
}
RECOMMENDED_FIELDS = {
    "Patient": ("name", "birthDate", "gender"),
    "Encounter": ("class", "period"),
    "Condition": ("clinicalStatus", "code", "onsetDateTime"),
    "Observation": ("code", "effectiveDateTime", "valueQuantity"),
    "Claim": ("type", "billablePeriod", "total"),
}

# ICD-10 prefixes counted as chronic.
CHRONIC_PREFIXES = (
    "E10", "E11", "E13",         # diabetes
    "I10", "I11", "I12", "I13",  # hypertension
    "I25",                       # chronic ischaemic heart disease
    "I50",                       # heart failure
    "I48",                       # atrial fibrillation
    "N18",                       # chronic kidney disease
    "J44",                       # COPD
    "J45",                       # asthma
    "M06", "M05",                # rheumatoid arthritis
    "M81",                       # osteoporosis
    "F32", "F33",                # depression
    "E78",                       # hyperlipidaemia
    "I69",                       # sequelae of cerebrovascular disease
)

# Prefix groups of the disease-burden report; anything else is "Other".
CONDITION_GROUPS = {
    "Diabetes": ("E10", "E11", "E13"),
    "Hypertension": ("I10", "I11"),
    "Heart Failure": ("I50",),
    "Atrial Fibrillation": ("I48",),
    "Chronic Kidney Disease": ("N18",),
    "Rheumatoid Arthritis": ("M06", "M05"),
    "Osteoporosis": ("M81",),
    "Depression": ("F32", "F33"),
    "Hyperlipidemia": ("E78",),
    "Post-Stroke Sequelae": ("I69",),
    "GERD": ("K21",),
}

LOINC_NAMES = {
    "8480-6": "Systolic blood pressure",
    "8462-4": "Diastolic blood pressure",
    "39156-5": "Body mass index",
    "4548-4": "Hemoglobin A1c",
    "2093-3": "Total Cholesterol",
    "33914-3": "eGFR",
    "8867-4": "Heart rate",
    "59408-5": "Oxygen saturation",
    "29463-7": "Body Weight",
    "6299-2": "BUN",
    "1751-7": "Albumin",
    "14937-7": "ESR",
    "11572-5": "Rheumatoid factor",
    "2823-3": "Potassium",
    "8310-5": "Body temperature",
}
ICD10_NAMES = {
    "E11.9": "Type 2 diabetes mellitus without complications",
    "I10": "Essential hypertension",
    "E78.5": "Hyperlipidemia unspecified",
    "I50.9": "Heart failure unspecified",
    "I48.91": "Unspecified atrial fibrillation",
    "N18.3": "Chronic kidney disease stage 3",
    "M06.9": "Rheumatoid arthritis unspecified",
    "M81.0": "Age-related osteoporosis",
    "F32.1": "Major depressive disorder moderate",
    "K21.0": "GERD with esophagitis",
    "I69.30": "Sequelae of cerebral infarction",
}

CLASS_LABELS = {"AMB": "Ambulatory", "IMP": "Inpatient", "EMER": "Emergency"}
CATEGORY_LABELS = {"vital-signs": "Vital Signs", "laboratory": "Laboratory"}

QUALITY_WEIGHTS = {
    "completeness": 0.35,
    "conformity": 0.25,
    "consistency": 0.20,
    "uniqueness": 0.20,
}
MIN_QUALITY_SCORE = 70.0
EPOCH = "1970-01-01 00:00:00"
