"""DuckDB SQL giving each registered query's result straight from the base tables.

The Spark side turns the tables into FHIR JSON and works on that; the SQL here
never sees JSON, so agreement checks parsing, rules and aggregation alike.
"""

from __future__ import annotations

from oracles.fixed import (
    CHRONIC_PREFIXES,
    CONDITION_GROUPS,
    ENCOUNTER_CLASSES,
    GENDERS,
    ICD10_NAMES,
    ICD_CODES,
    LOINC_NAMES,
    QUALITY_WEIGHTS,
)

RUN_AT = "2024-02-01T00:00:00+00:00"
DAY = "2024-02-01"
T = "'%Y-%m-%dT%H:%M:%S'"
D = "'%Y-%m-%d'"


def even(value: str, digits: int = 2) -> str:
    scale = f"{10**digits}::DOUBLE"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def away(value: str, digits: int = 2) -> str:
    scale = f"{10**digits}::DOUBLE"
    return f"(round(({value}) * {scale}) / {scale})"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ICD = f"{_list(ICD_CODES)}[(l_suppkey + l_linenumber) % 20 + 1]"
LOINC = f"{_list(LOINC_NAMES)}[k % 15 + 1]"

# --- rows as generated, before removal of copies --------------------------------

RAW = {
    "rp": f"""
SELECT c_custkey AS k, c_name, n_name, r_name,
  CASE WHEN c_custkey % 120 = 119 THEN NULL ELSE 'patient-' || c_custkey END AS id,
  CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE CAST(1 + c_custkey % 2 AS VARCHAR) END AS version,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '2024-01-15T10:00:00Z' END AS last_updated,
  'landing/customer.json' AS source_file,
  'bundle-patient-' || c_custkey AS bundle_id,
  'urn:uuid:patient-' || c_custkey AS full_url,
  '{RUN_AT}' AS stamp,
  CASE WHEN c_custkey % 40 = 7 THEN NULL WHEN c_custkey % 25 = 0 THEN 'M'
       WHEN c_custkey % 11 = 5 THEN 'other' WHEN c_custkey % 2 = 0 THEN 'male'
       ELSE 'female' END AS gender,
  c_custkey % 60 = 11 AS odd_birth,
  CASE WHEN c_custkey % 60 = 11 THEN 13 + c_custkey % 15 ELSE 1 + c_custkey % 28 END AS bd,
  1 + c_custkey % 12 AS bm, 1930 + c_custkey % 80 AS byear,
  c_custkey % 70 NOT IN (13, 14) AS named
FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""",
    "re0": """
SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS started
FROM orders""",
    "re1": """
SELECT *, CASE WHEN k % 97 = 0 THEN started - to_hours(5)
  ELSE started + to_minutes(CAST(((k * 13) % 480) * 15 AS INTEGER)) END AS ended
FROM re0""",
    "re": f"""
SELECT *, 'encounter-' || k AS id, '1' AS version, '' AS last_updated,
  'landing/orders.json' AS source_file, 'bundle-visit-' || k AS bundle_id,
  'urn:uuid:encounter-' || k AS full_url,
  strftime(o_orderdate, {T}) || '+00:00' AS stamp,
  CASE WHEN k % 101 = 0 THEN 'bogus' WHEN k % 103 = 0 THEN NULL
       WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'O' THEN 'planned'
       ELSE 'in-progress' END AS status,
  CASE WHEN k % 79 = 0 THEN NULL WHEN k % 83 = 0 THEN 'HH'
       WHEN o_orderpriority = '1-URGENT' THEN 'EMER'
       WHEN o_orderpriority = '2-HIGH' THEN 'IMP' ELSE 'AMB' END AS cls,
  CASE WHEN k % 109 = 0 THEN NULL WHEN k % 107 = 0 THEN 'Group/group-' || o_custkey
       ELSE 'Patient/patient-' || o_custkey END AS subject,
  CASE WHEN k % 89 <> 0 THEN strftime(started, {T}) END AS start_text,
  CASE WHEN k % 89 <> 0 THEN strftime(ended, {T}) END AS end_text,
  CASE WHEN k % 89 <> 0 THEN strftime(started, {T})
       || CASE WHEN k % 5 = 1 THEN '+02:00' ELSE 'Z' END END AS start_raw,
  CASE WHEN k % 89 <> 0 THEN strftime(ended, {T})
       || CASE WHEN k % 50 = 3 THEN '' WHEN k % 5 = 1 THEN '+02:00'
               WHEN k % 5 = 2 THEN '+01:00' ELSE 'Z' END END AS end_raw,
  CASE WHEN k % 89 <> 0 AND k % 50 <> 3 THEN
       date_diff('second', started, ended) / 3600.0::DOUBLE
       - CASE WHEN k % 5 = 2 THEN 1 ELSE 0 END END AS los
FROM re1""",
    "rc": f"""
SELECT *, 'condition-' || l_orderkey || '-' || l_linenumber AS id,
  CASE WHEN l_suppkey % 4 = 0 THEN CAST(1 + l_linenumber % 2 AS VARCHAR) ELSE '1' END AS version,
  CASE WHEN l_suppkey % 4 = 0 THEN strftime(l_shipdate, {T}) || 'Z' ELSE '' END AS last_updated,
  'landing/lineitem.json' AS source_file,
  'bundle-condition-' || l_orderkey || '-' || l_linenumber AS bundle_id,
  'urn:uuid:condition-' || l_orderkey || '-' || l_linenumber AS full_url,
  strftime(l_shipdate + to_seconds(l_partkey % 86400), {T}) || '.'
    || lpad(CAST((l_suppkey % 10000) * 100 + ascii(l_returnflag) AS VARCHAR), 6, '0')
    || '+00:00' AS stamp,
  CASE WHEN l_partkey % 131 = 0 THEN 'weird' WHEN l_returnflag = 'R' THEN 'active'
       WHEN l_returnflag = 'A' THEN 'resolved' WHEN l_suppkey % 3 = 0 THEN 'active'
       WHEN l_suppkey % 3 = 1 THEN 'recurrence' ELSE 'remission' END AS base_status,
  CASE WHEN l_partkey % 137 <> 0 THEN base_status END AS status,
  CASE WHEN l_partkey % 139 <> 0 THEN {ICD} END AS icd,
  'Patient/patient-' || l_partkey AS subject,
  CASE WHEN l_linenumber % 2 = 1 THEN strftime(l_shipdate, {T}) || 'Z'
       ELSE strftime(l_shipdate, {D}) END AS onset_raw,
  strftime(l_shipdate, {D}) AS onset,
  CASE WHEN l_orderkey % 61 = 0 THEN strftime(l_shipdate - to_days(3), {D})
       WHEN base_status = 'resolved' THEN strftime(l_shipdate + to_days(14), {D})
       END AS abated
FROM lineitem""",
    "ro": f"""
SELECT *, event_id AS k, 'obs-' || event_id AS id, '1' AS version, '' AS last_updated,
  'landing/events.json' AS source_file, 'bundle-observation-' || event_id AS bundle_id,
  'urn:uuid:obs-' || event_id AS full_url, strftime(ts, {T}) || '+00:00' AS stamp,
  CASE WHEN k % 77 = 0 THEN 'DONE' WHEN k % 78 = 0 THEN '' WHEN k % 119 = 0 THEN NULL
       ELSE 'final' END AS status,
  CASE WHEN k % 50 = 0 THEN 'Patient/patient-ghost-' || (k % 7)
       ELSE 'Patient/patient-' || user_id END AS subject,
  CASE WHEN k % 400 = 9 THEN 'not-a-date'
       WHEN k % 400 = 10 THEN strftime(ts, '%Y/%m/%d %H:%M')
       ELSE strftime(ts, {T}) || 'Z' END AS taken
FROM events""",
    "rl": f"""
SELECT o_orderkey AS k, o_custkey, o_orderdate, o_totalprice,
  'claim-' || o_orderkey AS id, '1' AS version, '' AS last_updated,
  'landing/orders.json' AS source_file, 'bundle-visit-' || o_orderkey AS bundle_id,
  'urn:uuid:claim-' || o_orderkey AS full_url,
  strftime(o_orderdate, {T}) || '+00:00' AS stamp,
  CASE WHEN o_orderkey % 127 = 0 THEN 'submitted' WHEN o_orderkey % 4 = 1 THEN 'cancelled'
       ELSE 'active' END AS status,
  'Patient/patient-' || o_custkey AS subject,
  CASE WHEN o_orderkey % 157 <> 0 THEN strftime(o_orderdate, {D}) END AS billed_start,
  CASE WHEN o_orderkey % 157 <> 0 THEN strftime(o_orderdate + to_days(CAST(
    CASE WHEN o_orderkey % 151 = 0 THEN -2 ELSE o_orderkey % 5 END AS INTEGER)), {D})
    END AS billed_end,
  CASE WHEN o_orderkey % 163 = 0 THEN NULL WHEN o_orderkey % 211 = 0 THEN -o_totalprice
       ELSE o_totalprice END AS amount
FROM orders""",
}

_TYPE_ROWS = {
    "Patient": "rp", "Encounter": "re", "Condition": "rc", "Observation": "ro", "Claim": "rl",
}


def _needs(sql: str, ctes: dict[str, str]) -> list[str]:
    """The named subqueries a text uses, dependencies first."""
    import re

    order: list[str] = []

    def visit(text: str) -> None:
        for name in ctes:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(ctes[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


_ENVELOPE = (
    "coalesce(id, '') AS resource_id, version AS version_id, last_updated, source_file, "
    "bundle_id, full_url, stamp"
)
_ALL = {
    "raw": "\nUNION ALL ".join(
        f"SELECT '{t}' AS resource_type, {_ENVELOPE} FROM {rows}"
        for t, rows in _TYPE_ROWS.items()
    ),
    "kept": """
SELECT * FROM raw QUALIFY row_number() OVER (
  PARTITION BY resource_type, resource_id, version_id, CASE WHEN resource_id = '' THEN bundle_id END
  ORDER BY stamp DESC, last_updated DESC, source_file DESC, bundle_id DESC) = 1""",
}

_LINEAGE = f"source_file, bundle_id, stamp AS ingestion_timestamp, 'run-1' AS pipeline_run_id"
_AFTER_SLASH = "regexp_replace(coalesce(subject, ''), '^[^/]*/', '')"

SILVER = {
    "sp": f"""
SELECT coalesce(id, '') AS patient_id,
  CASE WHEN k % 33 = 0 THEN '' WHEN k % 10 = 9 THEN 'SSN-' || k ELSE 'MRN-' || k END AS mrn,
  CASE WHEN named THEN 'Given' || (k % 100) ELSE '' END AS first_name,
  CASE WHEN named AND k % 4 <> 0 THEN 'Mid' || (k % 10) ELSE '' END AS middle_name,
  CASE WHEN named THEN c_name ELSE '' END AS family_name,
  CASE WHEN named THEN 'Given' || (k % 100) || ' ' || c_name ELSE '' END AS full_name,
  coalesce(gender, '') AS gender,
  byear || '-' || lpad(CAST(bm AS VARCHAR), 2, '0') || '-'
    || lpad(CAST(bd AS VARCHAR), 2, '0') AS birth_date,
  k % 7 <> 0 OR k % 2 = 1 AS active,
  CASE WHEN k % 17 = 0 THEN '' WHEN k % 9 = 4 THEN '1 Office Park'
       ELSE k || ' Main St' END AS address_line1,
  CASE WHEN k % 17 <> 0 AND k % 9 <> 4 AND k % 5 = 0 THEN 'Apt ' || (k % 9)
       ELSE '' END AS address_line2,
  CASE WHEN k % 17 = 0 THEN '' WHEN k % 9 = 4 THEN 'Worktown' ELSE n_name END AS city,
  CASE WHEN k % 17 = 0 THEN '' WHEN k % 9 = 4 THEN 'WK' ELSE r_name END AS state,
  CASE WHEN k % 17 = 0 THEN '' WHEN k % 9 = 4 THEN '00001'
       ELSE lpad(CAST(k % 90000 AS VARCHAR), 5, '0') END AS postal_code,
  CASE WHEN k % 17 = 0 THEN '' ELSE 'US' END AS country,
  '555-' || k AS phone,
  CASE WHEN k % 6 = 0 OR k % 55 = 2 THEN '' ELSE 'p' || k || '@example.org' END AS email,
  CASE WHEN k % 8 = 0 THEN '' WHEN k % 2 = 0 THEN 'M' ELSE 'S' END AS marital_status_code,
  CASE WHEN k % 12 = 0 THEN '' WHEN k % 4 = 1 THEN 'es' ELSE 'en-US' END AS preferred_language,
  {_LINEAGE}
FROM rp QUALIFY row_number() OVER (
  PARTITION BY coalesce(id, bundle_id), version ORDER BY bundle_id DESC) = 1""",
    "se": f"""
SELECT id AS encounter_id, {_AFTER_SLASH} AS patient_id, coalesce(status, '') AS status,
  coalesce(cls, '') AS encounter_class, '185349003' AS type_code,
  CASE WHEN k % 4 = 0 THEN 'Check-up visit' ELSE 'Encounter for check up' END AS type_display,
  coalesce(start_text, '') AS period_start, coalesce(end_text, '') AS period_end,
  los AS length_of_stay_hours,
  CASE WHEN k % 3 = 0 THEN '73211009' ELSE '' END AS reason_code,
  CASE WHEN k % 3 = 0 THEN 'Diabetes mellitus' ELSE '' END AS reason_display,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 'emd' ELSE '' END AS admit_source_code,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 'home' ELSE '' END AS discharge_disposition_code,
  CASE WHEN k % 13 = 0 THEN '' ELSE 'Hospital ' || (k % 20) END AS service_provider,
  {_LINEAGE}
FROM re""",
    "sc": f"""
SELECT id AS condition_id, {_AFTER_SLASH} AS patient_id,
  coalesce(status, '') AS clinical_status, 'confirmed' AS verification_status,
  CASE WHEN l_linenumber % 2 = 0 THEN 'problem-list-item' ELSE '' END AS category,
  coalesce(icd, '') AS condition_code,
  CASE WHEN icd IS NULL THEN '' WHEN l_linenumber % 3 = 0 THEN 'Dx ' || icd
       ELSE 'Diagnosis ' || icd END AS condition_display,
  onset AS onset_date, coalesce(abated, '') AS abatement_date,
  strftime(l_shipdate + to_days(1), {D}) AS recorded_date,
  status IN ('active', 'recurrence', 'relapse') AS is_active,
  {_LINEAGE}
FROM rc QUALIFY row_number() OVER (
  PARTITION BY id, version ORDER BY stamp DESC, last_updated DESC) = 1""",
    "so": f"""
SELECT id AS observation_id, {_AFTER_SLASH} AS patient_id,
  CASE WHEN k % 3 = 0 OR k % 10 = 1 THEN '' ELSE 'encounter-' || k END AS encounter_id,
  coalesce(status, '') AS status,
  CASE WHEN event_type IN ('view', 'click') THEN 'vital-signs'
       WHEN event_type IN ('purchase', 'error') THEN 'laboratory' ELSE 'survey' END AS category,
  {LOINC} AS loinc_code,
  CASE WHEN k % 2 = 0 THEN 'Test ' || (k % 15) ELSE 'Lab ' || {LOINC} END AS observation_name,
  CASE WHEN k % 201 = 0 OR k % 200 = 3 OR k % 203 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN k % 201 = 0 THEN '' ELSE 'mg/dL' END AS unit,
  CASE WHEN k % 201 = 0 OR k % 200 = 3 OR k % 203 = 0 THEN '' ELSE 'mg/dL' END AS unit_code,
  CASE WHEN k % 400 = 9 THEN '' ELSE strftime(ts, {D}) END AS effective_date,
  CASE WHEN k % 400 = 9 THEN '' WHEN k % 400 = 10 THEN strftime(date_trunc('minute', ts), {T})
       ELSE strftime(ts, {T}) END AS effective_datetime,
  CASE WHEN events_value > 250 THEN 'H' ELSE '' END AS interpretation,
  CASE WHEN k % 2 = 0 THEN 'Normal: < 250' ELSE '' END AS reference_range,
  {_LINEAGE}
FROM (SELECT *, value AS events_value FROM ro)""",
    "sl": f"""
SELECT id AS claim_id, {_AFTER_SLASH} AS patient_id, status,
  CASE WHEN k % 131 = 0 THEN '' WHEN k % 3 = 0 THEN 'institutional'
       ELSE 'professional' END AS claim_type,
  CASE WHEN k % 131 = 0 THEN '' WHEN k % 3 = 0 THEN 'Institutional'
       WHEN k % 6 = 1 THEN 'Office' ELSE '' END AS claim_type_display,
  CASE WHEN k % 149 = 0 THEN 'bogus-use' ELSE 'claim' END AS use,
  coalesce(billed_start, '') AS billable_period_start,
  coalesce(billed_end, '') AS billable_period_end,
  strftime(o_orderdate + to_days(1), {D}) AS created_date,
  amount AS total_amount,
  CASE WHEN k % 163 = 0 THEN 'USD' WHEN k % 113 = 0 THEN 'US' ELSE 'USD' END AS currency,
  k % 4 AS line_item_count,
  ((k % 4) * (k % 9973) + 25 * (k % 4) * (k % 4 + 1) / 2) / 4::DOUBLE AS line_item_total,
  CASE WHEN k % 4 = 0 THEN '' ELSE '99' || (200 + (k + 1) % 20) END AS primary_cpt_code,
  {_LINEAGE}
FROM rl""",
}

_CHRONIC = "regexp_matches(condition_code, '^(" + "|".join(CHRONIC_PREFIXES) + ")')"

GOLD = {
    "people": """
SELECT patient_id, full_name, gender, birth_date FROM sp WHERE patient_id <> '' QUALIFY row_number() OVER (
  PARTITION BY patient_id ORDER BY ingestion_timestamp DESC, full_name, gender, birth_date) = 1""",
    "ge": f"""
SELECT e.*, full_name, gender, birth_date FROM (
  SELECT patient_id, count(*) AS total_encounters,
    count(*) FILTER (encounter_class = 'AMB') AS amb_encounters,
    count(*) FILTER (encounter_class = 'IMP') AS imp_encounters,
    count(*) FILTER (encounter_class = 'EMER') AS emer_encounters,
    {even('sum(length_of_stay_hours) / count(length_of_stay_hours)')} AS avg_los_hours,
    {even('max(length_of_stay_hours)')} AS max_los_hours,
    {even('min(length_of_stay_hours)')} AS min_los_hours,
    max(nullif(period_start, '')) AS latest_encounter_date,
    min(nullif(period_start, '')) AS earliest_encounter_date
  FROM se GROUP BY patient_id) e LEFT JOIN people USING (patient_id)""",
    "gc": f"""
SELECT c.*, full_name, gender, birth_date FROM (
  SELECT patient_id, count(*) AS total_conditions,
    count(*) FILTER (a) AS active_condition_count,
    count(*) FILTER (a AND ch) AS chronic_condition_count,
    count(*) FILTER (a AND ch) > 0 AS has_chronic_condition,
    coalesce(array_to_string(list_sort(list(DISTINCT condition_code) FILTER (a)), '|'), '')
      AS active_icd_codes,
    coalesce(array_to_string(list_sort(list(DISTINCT condition_display) FILTER (a)), '|'), '')
      AS active_condition_names,
    min(onset_date) AS earliest_condition_onset, max(onset_date) AS most_recent_condition_onset
  FROM (SELECT *, coalesce(is_active, false) AS a, {_CHRONIC} AS ch FROM sc)
  GROUP BY patient_id) c LEFT JOIN people USING (patient_id)""",
    "gl": f"""
SELECT l.*, full_name, gender FROM (
  SELECT patient_id, count(*) AS total_claims,
    {even('coalesce(CAST(sum(CAST(total_amount AS DECIMAL(28,6))) AS DOUBLE), 0)')}
      AS total_billed,
    {even('CAST(sum(CAST(total_amount AS DECIMAL(28,6))) AS DOUBLE) / count(total_amount)')}
      AS avg_claim_value,
    {even('max(total_amount)')} AS max_claim_value,
    {even('min(total_amount)')} AS min_claim_value,
    count(*) FILTER (claim_type = 'professional') AS professional_claims,
    count(*) FILTER (claim_type = 'institutional') AS institutional_claims,
    max(created_date) AS latest_claim_date, min(created_date) AS earliest_claim_date
  FROM sl GROUP BY patient_id) l LEFT JOIN people USING (patient_id)""",
    "gm": f"""
SELECT substr(period_start, 1, 7) AS year_month, encounter_class, status,
  count(*) AS encounter_count,
  {even('sum(length_of_stay_hours) / count(length_of_stay_hours)')} AS avg_los_hours,
  {even('coalesce(sum(length_of_stay_hours), 0)')} AS total_los_hours
FROM se WHERE period_start <> '' GROUP BY ALL""",
}

# --- validation ------------------------------------------------------------------

_NEGATIVE_TEXT = "regexp_replace(CAST(amount AS VARCHAR), '\\.0$', '')"
_BIRTH_TEXT = "bd || '/' || lpad(CAST(bm AS VARCHAR), 2, '0') || '/' || byear"


def _required(field: str) -> str:
    return f"'Required field ''{field}'' is missing or empty'"


def _recommended(field: str) -> str:
    return f"'Recommended field ''{field}'' is missing'"


def _py(values) -> str:
    return str(sorted(values)).replace("'", "''")


# (type, severity, field, rule, condition, message)
ISSUES = [
    ("Patient", "ERROR", "id", "REQUIRED_FIELD", "id IS NULL", _required("id")),
    ("Patient", "WARNING", "name", "RECOMMENDED_FIELD", "k % 70 = 13", _recommended("name")),
    ("Patient", "WARNING", "gender", "RECOMMENDED_FIELD", "gender IS NULL",
     _recommended("gender")),
    ("Patient", "ERROR", "gender", "INVALID_CODE", "gender = 'M'",
     f"'Invalid gender ''M''. Expected one of {_py(GENDERS)}'"),
    ("Patient", "ERROR", "birthDate", "INVALID_DATE_FORMAT", "odd_birth",
     f"'birthDate ''' || {_BIRTH_TEXT} || ''' does not match YYYY-MM-DD format'"),
    ("Patient", "WARNING", "name", "MISSING_NAME", "k % 70 = 13",
     "'Patient has no name entries'"),
    ("Patient", "ERROR", "name", "WRONG_TYPE", "k % 70 = 14", "'Patient.name must be an array'"),
    ("Encounter", "ERROR", "status", "REQUIRED_FIELD", "status IS NULL", _required("status")),
    ("Encounter", "ERROR", "subject", "REQUIRED_FIELD", "subject IS NULL",
     _required("subject")),
    ("Encounter", "WARNING", "class", "RECOMMENDED_FIELD", "cls IS NULL",
     _recommended("class")),
    ("Encounter", "WARNING", "period", "RECOMMENDED_FIELD", "start_raw IS NULL",
     _recommended("period")),
    ("Encounter", "ERROR", "status", "INVALID_CODE", "status = 'bogus'",
     "'Invalid encounter status ''bogus'''"),
    ("Encounter", "WARNING", "class.code", "NONSTANDARD_CODE", "cls = 'HH'",
     f"'Encounter class code ''HH'' not in standard list {_py(ENCOUNTER_CLASSES)}'"),
    ("Encounter", "ERROR", "period", "DATE_LOGIC", "start_raw > end_raw",
     "'Encounter period.start (' || start_raw || ') is after period.end (' || end_raw || ')'"),
    ("Encounter", "WARNING", "subject.reference", "WRONG_REFERENCE_TYPE",
     "subject LIKE 'Group/%'", "'Expected Patient reference, got ''' || subject || ''''"),
    ("Condition", "WARNING", "clinicalStatus", "RECOMMENDED_FIELD", "status IS NULL",
     _recommended("clinicalStatus")),
    ("Condition", "WARNING", "code", "RECOMMENDED_FIELD", "icd IS NULL", _recommended("code")),
    ("Condition", "ERROR", "clinicalStatus.coding.code", "INVALID_CODE", "status = 'weird'",
     "'Invalid clinical status code ''weird'''"),
    ("Condition", "ERROR", "onsetDateTime/abatementDateTime", "DATE_LOGIC", "onset > abated",
     "'Condition onset (' || onset_raw || ') is after abatement (' || abated || ')'"),
    ("Observation", "ERROR", "status", "REQUIRED_FIELD", "coalesce(status, '') = ''",
     _required("status")),
    ("Observation", "WARNING", "valueQuantity", "RECOMMENDED_FIELD", "k % 201 = 0",
     _recommended("valueQuantity")),
    ("Observation", "ERROR", "status", "INVALID_CODE", "status = 'DONE'",
     "'Invalid observation status ''DONE'''"),
    ("Observation", "ERROR", "valueQuantity.value", "WRONG_TYPE",
     "k % 201 <> 0 AND k % 200 = 3", "'valueQuantity.value must be numeric, got ''str'''"),
    ("Observation", "WARNING", "effectiveDateTime", "INVALID_DATE_FORMAT",
     "k % 400 IN (9, 10)",
     "'effectiveDateTime ''' || taken || ''' may not be ISO 8601 compliant'"),
    ("Claim", "WARNING", "type", "RECOMMENDED_FIELD", "k % 131 = 0", _recommended("type")),
    ("Claim", "WARNING", "billablePeriod", "RECOMMENDED_FIELD", "k % 157 = 0",
     _recommended("billablePeriod")),
    ("Claim", "WARNING", "total", "RECOMMENDED_FIELD", "amount IS NULL", _recommended("total")),
    ("Claim", "ERROR", "status", "INVALID_CODE", "status = 'submitted'",
     "'Invalid claim status ''submitted'''"),
    ("Claim", "ERROR", "total.value", "NEGATIVE_AMOUNT", "amount < 0",
     f"'Claim total value cannot be negative (' || {_NEGATIVE_TEXT} || ')'"),
    ("Claim", "WARNING", "total.currency", "INVALID_CURRENCY",
     "k % 113 = 0 AND amount IS NOT NULL",
     "'Currency code ''US'' does not look like ISO 4217 (expected 3 chars)'"),
    ("Claim", "ERROR", "billablePeriod", "DATE_LOGIC", "billed_start > billed_end",
     "'Claim billablePeriod start (' || billed_start || ') is after end (' "
     "|| billed_end || ')'"),
]

VALIDATION = {
    "issues": "\nUNION ALL ".join(
        f"SELECT '{t}' AS resource_type, coalesce(id, 'MISSING_ID') AS resource_id, "
        f"'{severity}' AS severity, '{field}' AS field, {message} AS message, "
        f"'{rule}' AS rule FROM {_TYPE_ROWS[t]} WHERE {condition}"
        for t, severity, field, rule, condition, message in ISSUES
    ),
    "results": "\nUNION ALL ".join(
        f"SELECT '{t}' AS resource_type, coalesce(id, 'MISSING_ID') AS resource_id, "
        + " + ".join(
            [f"CAST(coalesce({c}, false) AS BIGINT)"
             for kind, s, _, _, c, _ in ISSUES if kind == t and s == "ERROR"]
        )
        + " AS error_count, "
        + " + ".join(
            [f"CAST(coalesce({c}, false) AS BIGINT)"
             for kind, s, _, _, c, _ in ISSUES if kind == t and s == "WARNING"] or ["0"]
        )
        + f" AS warning_count FROM {_TYPE_ROWS[t]}"
        for t in _TYPE_ROWS
    ),
}

# --- quality ----------------------------------------------------------------------

# (type, rule, dimension, failing condition, detail text)
_ABSENT = "'field ''{0}'' missing or empty'"
QUALITY_RULES = [
    ("Patient", "patient_required_fields", "completeness", "id IS NULL", _ABSENT.format("id")),
    ("Patient", "patient_demographic_fields", "completeness",
     "k % 70 = 13 OR gender IS NULL",
     "'field ''' || CASE WHEN k % 70 = 13 THEN 'name' ELSE 'gender' END "
     "|| ''' missing or empty'"),
    ("Encounter", "encounter_required_fields", "completeness",
     "status IS NULL OR subject IS NULL",
     "'field ''' || CASE WHEN status IS NULL THEN 'status' ELSE 'subject' END "
     "|| ''' missing or empty'"),
    ("Encounter", "encounter_timing_fields", "completeness", "start_raw IS NULL",
     _ABSENT.format("period")),
    ("Condition", "condition_required_fields", "completeness", "false", "''"),
    ("Condition", "condition_clinical_fields", "completeness",
     "status IS NULL OR icd IS NULL",
     "'field ''' || CASE WHEN status IS NULL THEN 'clinicalStatus' ELSE 'code' END "
     "|| ''' missing or empty'"),
    ("Observation", "obs_required_fields", "completeness", "coalesce(status, '') = ''",
     _ABSENT.format("status")),
    ("Observation", "obs_value_fields", "completeness", "k % 201 = 0",
     _ABSENT.format("valueQuantity")),
    ("Claim", "claim_required_fields", "completeness", "false", "''"),
    ("Claim", "claim_financial_fields", "completeness", "amount IS NULL OR k % 157 = 0",
     "'field ''' || CASE WHEN amount IS NULL THEN 'total' ELSE 'billablePeriod' END "
     "|| ''' missing or empty'"),
    ("Patient", "patient_gender_codes", "conformity", "gender = 'M'",
     "'invalid gender=''M'''"),
    ("Encounter", "encounter_status_codes", "conformity", "status = 'bogus'",
     "'invalid status=''bogus'''"),
    ("Encounter", "encounter_class_codes", "conformity", "cls = 'HH'",
     "'unknown class code=''HH'''"),
    ("Observation", "obs_status_codes", "conformity", "status IN ('DONE', '')",
     "'invalid status=''' || status || ''''"),
    ("Observation", "obs_value_numeric", "conformity", "k % 201 <> 0 AND k % 200 = 3",
     "'non-numeric valueQuantity.value=''high'''"),
    ("Claim", "claim_status_codes", "conformity", "status = 'submitted'",
     "'invalid status=''submitted'''"),
    ("Condition", "condition_clinical_status_codes", "conformity", "status = 'weird'",
     "'invalid clinicalStatus.code=''weird'''"),
    ("Encounter", "encounter_period_logic", "consistency", "start_raw > end_raw",
     "'start=' || start_raw || ' > end=' || end_raw"),
    ("Condition", "condition_date_logic", "consistency", "onset > abated",
     "'onset=' || onset_raw || ' after abatement=' || abated"),
    ("Claim", "claim_period_logic", "consistency", "billed_start > billed_end",
     "'billablePeriod start > end'"),
    ("Claim", "claim_total_positive", "consistency", "amount < 0",
     f"'negative claim total=' || {_NEGATIVE_TEXT}"),
]


def _outcomes() -> str:
    parts = [
        f"SELECT '{t}' AS resource_type, '{rule}' AS rule_name, '{dimension}' AS dimension, "
        f"count(*) FILTER ({fails}) AS failed, count(*) AS total FROM {_TYPE_ROWS[t]}"
        for t, rule, dimension, fails, _ in QUALITY_RULES
    ]
    parts += [
        f"SELECT '{t}', 'resource_id_uniqueness', 'uniqueness', "
        f"count(id) - count(DISTINCT id), count(*) FROM {rows}"
        for t, rows in _TYPE_ROWS.items()
    ]
    return "\nUNION ALL ".join(parts)


def _dimension(name: str) -> str:
    return f"coalesce(avg(rate) FILTER (dimension = '{name}') * 100, 100::DOUBLE)"


QUALITY = {
    "outcomes": _outcomes(),
    "dims": "SELECT resource_type, max(total) AS record_count, "
    + ", ".join(f"{_dimension(d)} AS {d}" for d in QUALITY_WEIGHTS)
    + " FROM (SELECT *, (total - failed) / CAST(total AS DOUBLE) AS rate FROM outcomes) "
    "GROUP BY resource_type",
    "weighted": "SELECT *, " + " + ".join(
        ["0::DOUBLE"] + [f"{d} * {w}::DOUBLE" for d, w in QUALITY_WEIGHTS.items()]
    ) + " AS score FROM dims",
    "details": "\nUNION ALL ".join(
        [
            f"SELECT '{t}' AS resource_type, '{rule}' AS rule_name, "
            f"coalesce(id, '?') AS rid, 'id=' || coalesce(id, '?') || ': ' || {text} AS detail "
            f"FROM {_TYPE_ROWS[t]} WHERE {fails}"
            for t, rule, _, fails, text in QUALITY_RULES
        ]
        + [
            f"SELECT '{t}', 'resource_id_uniqueness', id, 'id=' || id || ' appears ' "
            f"|| count(*) || ' times' FROM {rows} WHERE id IS NOT NULL "
            "GROUP BY id HAVING count(*) > 1"
            for t, rows in _TYPE_ROWS.items()
        ]
    ),
}

_SCORES = (
    f"SELECT resource_type, record_count, {even('score')} AS quality_score, "
    + ", ".join(f"{even(d)} AS {d}" for d in QUALITY_WEIGHTS)
    + ", score >= 70 AS passed_threshold FROM weighted"
)


def _rules_of(*dimensions: str) -> str:
    chosen = ", ".join(f"'{d}'" for d in dimensions)
    return (
        "SELECT resource_type, rule_name, dimension, total - failed AS passed, failed, total, "
        f"{even('(total - failed) / CAST(total AS DOUBLE)', 4)} AS pass_rate "
        f"FROM outcomes WHERE dimension IN ({chosen})"
    )


# --- views -------------------------------------------------------------------------

_CLASS_LABEL = (
    "CASE encounter_class WHEN 'AMB' THEN 'Ambulatory' WHEN 'IMP' THEN 'Inpatient' "
    "WHEN 'EMER' THEN 'Emergency' ELSE encounter_class END AS encounter_class_label"
)
_GROUP = "CASE " + " ".join(
    f"WHEN regexp_matches(icd_code, '^({'|'.join(p)})') THEN '{name}'"
    for name, p in CONDITION_GROUPS.items()
) + " ELSE 'Other' END"

_P360 = f"""
SELECT ge.patient_id, ge.full_name, ge.gender, ge.birth_date, total_encounters, amb_encounters,
  imp_encounters, emer_encounters, avg_los_hours, max_los_hours, latest_encounter_date,
  earliest_encounter_date, total_conditions, active_condition_count, chronic_condition_count,
  has_chronic_condition, active_icd_codes, active_condition_names, total_claims, total_billed,
  avg_claim_value, professional_claims, institutional_claims, latest_claim_date,
  CASE WHEN chronic_condition_count >= 3 AND emer_encounters >= 2 THEN 'HIGH'
       WHEN chronic_condition_count >= 2 OR imp_encounters >= 2 THEN 'MEDIUM'
       WHEN has_chronic_condition THEN 'LOW_CHRONIC' ELSE 'LOW' END AS risk_tier,
  {away('total_billed / total_encounters')} AS cost_per_encounter
FROM ge LEFT JOIN gc ON ge.patient_id = gc.patient_id
  LEFT JOIN gl ON ge.patient_id = gl.patient_id"""

_LANDED = "k % 50 NOT IN (1, 2)"
_EXTRA = "(CAST(k % 97 = 5 AS BIGINT) + CAST(k % 50 = 3 AS BIGINT))"


def _tables_of(names: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {cte}"
        for label, cte in names.items()
    )


_ZONES = {
    "bronze_resource": "kept",
    "silver_patient": "sp", "silver_encounter": "se", "silver_condition": "sc",
    "silver_observation": "so", "silver_claim": "sl",
    "gold_patient_encounter_summary": "ge", "gold_patient_condition_profile": "gc",
    "gold_claims_financial_summary": "gl", "gold_monthly_utilization_trends": "gm",
}


def _sum_of(ctes) -> str:
    return "(" + " + ".join(f"(SELECT count(*) FROM {c})" for c in ctes) + ")"


_SILVERS = ["sp", "se", "sc", "so", "sl"]
_GOLDS = ["ge", "gc", "gl", "gm"]


def _report(bundle: str, rows: str, kind: str, where: str = "true") -> str:
    counts = ", ".join(
        f"CAST({int(t == kind)} AS BIGINT) AS {t.lower()}_count" for t in _TYPE_ROWS
    )
    return (
        f"SELECT {bundle} AS bundle_id, CAST(1 AS BIGINT) AS total_entries, "
        f"CAST(0 AS BIGINT) AS skipped_entries, {counts}, '' AS errors "
        f"FROM {rows} WHERE {where}"
    )


def _scan(rows: str, kind: str, index: str = "0", where: str = "true") -> str:
    return (
        f"SELECT '{kind}' AS resource_type, bundle_id, CAST({index} AS INTEGER) AS entry_index, "
        f"full_url, coalesce(id, '') AS resource_id, '{RUN_AT}' AS ingestion_timestamp "
        f"FROM {rows} WHERE {where}"
    )


_CODE_NAMES = {
    "code_list": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{system}', '{code}', '{name}')"
        for system, names in (("LOINC", LOINC_NAMES), ("ICD-10", ICD10_NAMES))
        for code, name in names.items()
    )
    + ") t(code_system, code, code_name)",
}

# Patient rows that reach a landing folder as readable bundles.
_LANDED_BRONZE = {
    "landed": "SELECT * FROM raw WHERE resource_type <> 'Patient' "
    "OR CAST(regexp_extract(bundle_id, '[0-9]+$') AS BIGINT) % 50 NOT IN (1, 2)",
}

_ADVANCED = """
SELECT s.source_key, coalesce(newest, TIMESTAMP '{now}') AS last_processed,
  TIMESTAMP '{now}' AS updated_at, '{run}' AS last_run_id, coalesce(files, 0) AS files_processed,
  false AS is_reset
FROM (SELECT DISTINCT event_type AS source_key FROM events) s LEFT JOIN (
  SELECT event_type AS source_key, max(ts) AS newest, count(*) AS files
  FROM events WHERE {where} GROUP BY event_type) n USING (source_key)"""


def _detail(cte: str, columns: str) -> str:
    return (
        f"SELECT {columns} FROM {cte} x "
        "LEFT JOIN (SELECT patient_id, full_name AS patient_name, gender FROM sp "
        "WHERE patient_id <> '') p "
        "USING (patient_id)"
    )


QUERIES = {
    "bundle_scan": "\nUNION ALL ".join([
        _scan("rp", "Patient", where=_LANDED),
        _scan("re", "Encounter"),
        _scan("rl", "Claim", index=f"1 + {_EXTRA}"),
        _scan("rc", "Condition"),
        _scan("ro", "Observation"),
    ]),
    "bundle_rejects": """
SELECT CASE c_custkey % 50 WHEN 1 THEN 'malformed JSON' ELSE 'not a Bundle' END AS reason,
  count(*) AS documents FROM customer WHERE c_custkey % 50 IN (1, 2) GROUP BY 1""",
    "unprocessed_files": """
SELECT DISTINCT CAST(o_orderkey % 16 AS INTEGER) AS batch FROM orders WHERE o_orderkey % 16 >= 8""",
    "entry_limit": f"""
SELECT 'bundle-visit-' || k AS bundle_id, CAST(2 AS BIGINT) AS entries_kept
FROM (SELECT o_orderkey AS k FROM orders) WHERE {_EXTRA} > 0""",
    "ingestion_report": "\nUNION ALL ".join([
        _report("bundle_id", "rp", "Patient", _LANDED),
        f"""SELECT 'bundle-visit-' || k, 2 + {_EXTRA}, {_EXTRA}, 0, 1, 0, 0, 1,
          CASE WHEN k % 97 = 5 THEN 'Entry 1 has no ''resource'' field' ELSE '' END
          FROM (SELECT o_orderkey AS k FROM orders)""",
        _report("bundle_id", "rc", "Condition"),
        _report("bundle_id", "ro", "Observation"),
    ]),
    "resource_summary": """
SELECT coalesce(resource_type, 'total') AS resource_type, count(*) AS resource_count,
  count(*) > 0 AS present FROM raw GROUP BY ROLLUP (resource_type)""",
    "bronze_read": """
SELECT resource_id, version_id, stamp AS ingestion_timestamp, bundle_id
FROM kept WHERE resource_type = 'Observation'""",
    "zone_row_counts": _tables_of(_ZONES),
    "adhoc_sql": """
SELECT state, encounter_class, count(*) AS encounters,
  count(DISTINCT se.patient_id) AS patients
FROM se JOIN sp ON se.patient_id = sp.patient_id
WHERE state <> '' AND se.patient_id <> '' GROUP BY ALL""",
    "bronze_roundtrip": """
SELECT resource_type, resource_id, version_id, last_updated, source_file, bundle_id, full_url,
  stamp AS ingestion_timestamp, substr(stamp, 1, 10) AS ingestion_date,
  'run-1' AS pipeline_run_id FROM kept""",
    "bronze_stats": """
SELECT resource_type, CAST(sum(n) AS BIGINT) AS records_ingested, count(*) AS records_written,
  CAST(sum(n) - count(*) AS BIGINT) AS duplicates_removed
FROM (SELECT resource_type, resource_id, version_id,
    CASE WHEN resource_id = '' THEN bundle_id END AS own, count(*) AS n FROM raw GROUP BY ALL)
GROUP BY resource_type""",
    "silver_roundtrip": "SELECT * FROM se",
    "gold_roundtrip": "SELECT * FROM gl",
    "file_ledger": """
SELECT 'landing/' || user_id || '.json' AS path, ts AS processed_at,
  'run-' || event_id AS pipeline_run_id, event_id AS record_count
FROM events QUALIFY row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC, 'run-' || event_id DESC, event_id DESC) = 1""",
    "stage_counts": "\nUNION ALL ".join(
        f"SELECT 'run-1' AS run_id, '{stage}' AS stage, 'SUCCESS' AS status, "
        f"CAST({n} AS BIGINT) AS records"
        for stage, n in {
            "ingest": _sum_of(["raw"]), "validate": _sum_of(["raw"]),
            "bronze": _sum_of(["kept"]), "silver": _sum_of(_SILVERS),
            "gold": _sum_of(_GOLDS), "warehouse": _sum_of(["kept", *_SILVERS, *_GOLDS]),
        }.items()
    ),
    "quality_score_log": f"""
SELECT 'run-1' AS run_id, *, '{RUN_AT}' AS evaluated_at FROM ({_SCORES})""",
    "validation_issues": "SELECT * FROM issues",
    "validation_results": """
SELECT resource_type, resource_id, error_count = 0 AS is_valid, error_count, warning_count
FROM results""",
    "reference_issues": "\nUNION ALL ".join(
        f"SELECT 'WARNING' AS severity, '{t}' AS resource_type, id AS resource_id, "
        f"'{'patient' if t == 'Claim' else 'subject'}' AS field, "
        "'Referenced ' || subject || ' not found in bundle' AS message, "
        f"'REF_INTEGRITY' AS rule FROM {_TYPE_ROWS[t]} WHERE subject LIKE 'Patient/%' "
        "AND NOT EXISTS (SELECT 1 FROM rp WHERE 'Patient/' || rp.id = subject)"
        for t in ("Encounter", "Condition", "Observation", "Claim")
    ),
    "validation_summary": """
SELECT coalesce(resource_type, 'all') AS resource_type, count(*) AS checked,
  count(*) FILTER (error_count = 0) AS valid, CAST(sum(error_count) AS BIGINT) AS errors,
  CAST(sum(warning_count) AS BIGINT) AS warnings
FROM results GROUP BY ROLLUP (resource_type)""",
    "schema_constraint_issues": "\nUNION ALL ".join(
        f"SELECT '{t}' AS resource_type, coalesce(id, 'MISSING_ID') AS resource_id, "
        f"'{path}' AS path, '{kind}' AS \"constraint\", {value} AS value "
        f"FROM {_TYPE_ROWS[t]} WHERE {condition}"
        for t, path, kind, value, condition in (
            ("Patient", "identifier.use", "enum", "'bogus'", "k % 33 <> 0 AND k % 45 = 1"),
            ("Patient", "telecom.system", "enum", "'pigeon'", "k % 6 <> 0 AND k % 55 = 2"),
            ("Patient", "telecom.use", "enum", "'office'", "k % 6 <> 0 AND k % 65 = 3"),
            ("Claim", "use", "enum", "'bogus-use'", "k % 149 = 0"),
            ("Encounter", "subject.reference", "pattern", "subject", "subject LIKE 'Group/%'"),
            ("Observation", "encounter.reference", "pattern", "'unlinked'",
             "k % 3 <> 0 AND k % 10 = 1"),
            ("Claim", "total.value", "minimum", _NEGATIVE_TEXT, "amount < 0"),
        )
    ),
    "code_labels": """
SELECT code_system, code, records, code_name FROM (
  SELECT 'LOINC' AS code_system, loinc_code AS code, count(*) AS records FROM so GROUP BY ALL
  UNION ALL
  SELECT 'ICD-10', condition_code, count(*) FROM sc GROUP BY ALL)
LEFT JOIN code_list USING (code_system, code)""",
    "dq_completeness": _rules_of("completeness"),
    "dq_conformity": _rules_of("conformity"),
    "dq_consistency": _rules_of("consistency"),
    "dq_uniqueness": _rules_of("uniqueness"),
    "dq_rules": _rules_of(*QUALITY_WEIGHTS),
    "dq_rule_details": """
SELECT resource_type, rule_name, CAST(row_number() OVER w AS INTEGER) AS line, detail
FROM details
WINDOW w AS (PARTITION BY resource_type, rule_name ORDER BY rid, detail)
QUALIFY row_number() OVER w <= 10""",
    "dq_dimension_scores": "\nUNION ALL ".join(
        f"SELECT resource_type, '{d}' AS dimension, {even(d)} AS dimension_score FROM dims"
        for d in QUALITY_WEIGHTS
    ),
    "dq_scores": _SCORES,
    "dq_gate": """
SELECT resource_type, score >= 98 AS released, record_count AS resources FROM weighted""",
    "bronze_projection": """
SELECT resource_type, resource_id, version_id, last_updated, source_file, bundle_id, full_url,
  stamp AS ingestion_timestamp, substr(stamp, 1, 10) AS ingestion_date,
  'run-1' AS pipeline_run_id, CAST(0 AS BIGINT) AS private_keys FROM raw""",
    "bronze_dedup": """
SELECT resource_type, resource_id, version_id, stamp AS ingestion_timestamp, bundle_id
FROM kept""",
    "silver_patient": "SELECT * FROM sp",
    "silver_encounter": "SELECT * FROM se",
    "silver_condition": "SELECT * FROM sc",
    "silver_observation": "SELECT * FROM so",
    "silver_claim": "SELECT * FROM sl",
    "patient_encounter_summary": "SELECT * FROM ge",
    "patient_condition_profile": "SELECT * FROM gc",
    "chronic_flag": f"""
SELECT condition_code, count(*) AS conditions, {_CHRONIC} AS is_chronic FROM sc GROUP BY ALL""",
    "claims_financial_summary": "SELECT * FROM gl",
    "monthly_utilization_trends": "SELECT * FROM gm",
    "vw_patient_demographics": """
SELECT patient_id, full_name, first_name || ' ' || family_name AS display_name, gender,
  birth_date, CAST(2024 - CAST(left(birth_date, 4) AS INTEGER) AS INTEGER) AS age_years,
  CASE gender WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' ELSE 'U' END AS gender_code,
  city, state, postal_code, phone, email, preferred_language, marital_status_code,
  source_file, pipeline_run_id FROM sp""",
    "vw_encounter_detail": _detail("se", f"""encounter_id, patient_id, patient_name, gender,
  status, encounter_class, {_CLASS_LABEL}, type_code, type_display, period_start, period_end,
  length_of_stay_hours, CASE WHEN length_of_stay_hours < 4 THEN 'short_stay'
    WHEN length_of_stay_hours < 48 THEN 'observation'
    WHEN length_of_stay_hours IS NOT NULL THEN 'inpatient' END AS los_category,
  reason_code, reason_display, admit_source_code, discharge_disposition_code,
  service_provider, pipeline_run_id"""),
    "vw_condition_detail": _detail("sc", """condition_id, patient_id, patient_name,
  clinical_status, verification_status, condition_code, condition_display, onset_date,
  abatement_date, recorded_date, is_active,
  CASE WHEN abatement_date <> '' THEN CAST(date_diff('day', CAST(onset_date AS DATE),
    CAST(abatement_date AS DATE)) AS INTEGER) END AS condition_duration_days,
  pipeline_run_id"""),
    "vw_observation_detail": _detail("so", """observation_id, patient_id, patient_name,
  encounter_id, status, category, CASE category WHEN 'vital-signs' THEN 'Vital Signs'
    WHEN 'laboratory' THEN 'Laboratory' ELSE category END AS category_label,
  loinc_code, observation_name, value, unit, effective_date, effective_datetime,
  interpretation, reference_range, pipeline_run_id"""),
    "vw_claim_detail": _detail("sl", """claim_id, patient_id, patient_name, status, claim_type,
  claim_type_display, use, billable_period_start, billable_period_end, created_date,
  total_amount, currency, line_item_count, line_item_total, primary_cpt_code,
  pipeline_run_id"""),
    "vw_patient_360": _P360,
    "vw_high_cost_patients": """
SELECT *, CASE WHEN cost_percentile >= 0.75 THEN 'Top 25%'
  WHEN cost_percentile >= 0.5 THEN 'Top 50%' ELSE 'Bottom 50%' END AS cost_tier
FROM (SELECT gl.patient_id, gl.full_name, gl.gender, total_claims, total_billed,
  avg_claim_value, professional_claims, institutional_claims, active_condition_count,
  chronic_condition_count, active_icd_codes,
  percent_rank() OVER (ORDER BY total_billed) AS cost_percentile
  FROM gl LEFT JOIN gc ON gl.patient_id = gc.patient_id)""",
    "vw_chronic_disease_burden": f"""
SELECT {_GROUP} AS condition_group, count(*) AS distinct_icd_codes,
  CAST(sum(patient_count) AS BIGINT) AS total_patient_occurrences,
  {away('100.0::DOUBLE * sum(patient_count) / (SELECT count(DISTINCT patient_id) FROM gc)', 1)}
    AS prevalence_pct
FROM (SELECT icd_code, count(DISTINCT patient_id) AS patient_count FROM (
  SELECT patient_id, unnest(string_split(active_icd_codes, '|')) AS icd_code
  FROM gc WHERE active_icd_codes <> '') GROUP BY icd_code)
GROUP BY 1""",
    "vw_encounter_utilization_summary": f"""
SELECT year_month, encounter_class, {_CLASS_LABEL}, status, encounter_count, avg_los_hours,
  total_los_hours, CAST(sum(encounter_count) OVER (PARTITION BY encounter_class
    ORDER BY year_month, status ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS running_total_by_class,
  {away('100.0::DOUBLE * encounter_count / sum(encounter_count) OVER (PARTITION BY year_month)', 1)}
    AS pct_of_monthly_volume
FROM gm""",
    "sanity_checks": "\nUNION ALL ".join(
        [
            f"SELECT '{check}' AS check_name, count(*) AS value FROM {cte}"
            for check, cte in {
                "silver_patients_count": "sp", "silver_encounters_count": "se",
                "silver_conditions_count": "sc", "silver_observations_count": "so",
                "silver_claims_count": "sl", "gold_encounter_summary_count": "ge",
                "gold_condition_profile_count": "gc", "gold_financial_summary_count": "gl",
                "gold_utilization_trends_count": "gm",
            }.items()
        ]
        + [
            "SELECT 'silver_unique_patients', count(DISTINCT patient_id) FROM sp",
            "SELECT 'gold_unique_patients', count(DISTINCT patient_id) FROM ge",
            "SELECT 'patient_id_consistent', CAST((SELECT count(DISTINCT patient_id) FROM sp) "
            "= (SELECT count(DISTINCT patient_id) FROM ge) AS BIGINT)",
        ]
    ),
    "active_conditions": """
SELECT patient_id, condition_code, condition_display, onset_date, clinical_status
FROM sc WHERE is_active""",
    "vitals_top10": """
SELECT observation_id, patient_id, observation_name, value, unit, effective_date
FROM so WHERE category = 'vital-signs' ORDER BY observation_id LIMIT 10""",
    "patient_360_report": f"""
SELECT patient_id, full_name, gender, total_encounters, chronic_condition_count, total_billed,
  risk_tier, cost_per_encounter FROM ({_P360})""",
    "watermark_current": """
SELECT source_key, CASE WHEN is_reset THEN TIMESTAMP '1970-01-01' ELSE ts END AS last_processed,
  'run-' || event_id AS last_run_id, event_id AS files_processed,
  is_reset AS full_load_needed
FROM (SELECT *, event_type || '-' || user_id AS source_key, event_id % 5 = 0 AS is_reset
  FROM events) QUALIFY row_number() OVER (
  PARTITION BY source_key ORDER BY ts DESC, 'run-' || event_id DESC) = 1""",
    "pending_files": """
SELECT 'landing/' || event_id || '.json' AS path, e.event_type AS source_key,
  ts AS modified_at FROM events e LEFT JOIN (
  SELECT event_type, max(ts) AS mark FROM events
  WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'error' GROUP BY event_type) m
  ON e.event_type = m.event_type
WHERE ts > coalesce(mark, TIMESTAMP '1970-01-01')""",
    "watermark_advance": _ADVANCED.format(
        now=DAY, run="run-2", where="ts >= TIMESTAMP '2024-01-16' AND event_type <> 'signup'"
    ),
    "incremental_equals_full": """
SELECT resource_type, count(*) AS left_rows, count(*) AS right_rows,
  CAST(0 AS BIGINT) AS unmatched_rows FROM kept GROUP BY resource_type""",
    "stream_equals_batch": """
SELECT resource_type, count(*) AS left_rows, count(*) AS right_rows,
  CAST(0 AS BIGINT) AS unmatched_rows
FROM (SELECT DISTINCT resource_type, resource_id, version_id,
    CASE WHEN resource_id = '' THEN bundle_id END AS own FROM landed)
GROUP BY resource_type""",
}

QUERIES["stream_rejects"] = QUERIES["bundle_rejects"]
QUERIES["bronze_current"] = """
SELECT DISTINCT resource_type, resource_id, version_id, bundle_id, full_url FROM raw"""
QUERIES["gold_after_two_loads"] = """
SELECT coalesce(ge.patient_id, gl.patient_id) AS patient_id, ge.* EXCLUDE (patient_id),
  gl.* EXCLUDE (patient_id, full_name, gender)
FROM ge FULL JOIN gl ON ge.patient_id = gl.patient_id"""
QUERIES["gold_rebuild_difference"] = """
SELECT unnest(['patient_encounter_summary', 'patient_condition_profile', 'claims_financial_summary',
  'monthly_utilization_trends']) AS table_name, CAST(0 AS BIGINT) AS unmatched_rows"""
QUERIES["load_rejects"] = QUERIES["bundle_rejects"] + """
UNION ALL SELECT 'empty file', 1"""
# Drafts come on top of the rows themselves: one visit in six has a draft of encounter and claim.
QUERIES["load_log"] = """
SELECT unnest(['ingest', 'bronze', 'validate']) AS stage, 'SUCCESS' AS status,
  (SELECT count(*) FROM raw) + (SELECT CAST(2 * count(*) AS BIGINT) FROM orders WHERE o_orderkey % 6 = 0) AS records,
  CAST(2 AS BIGINT) AS runs"""
QUERIES["stream_after_batch"] = QUERIES["stream_equals_batch"]

_CTES = {
    **RAW, **_ALL, **SILVER, **GOLD, **VALIDATION, **QUALITY, **_CODE_NAMES, **_LANDED_BRONZE,
}


def oracles() -> dict[str, str]:
    """One self-contained statement per query name."""
    statements = {}
    for name, body in QUERIES.items():
        parts = [f"{cte} AS ({_CTES[cte]})" for cte in _needs(body, _CTES)]
        statements[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
    return statements
