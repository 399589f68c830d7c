"""Hand-written DuckDB text of the quality checks, scores, gate, samples and expectations.

Written out check by check, so that a wrong rule, threshold or order in
``operators.quality`` shows up as a difference.
"""
from __future__ import annotations

_EARLY, _LATE = "TIMESTAMP '2000-01-01'", "TIMESTAMP '2026-11-30'"  # as_of 2026-09-01 plus 90 days


def _check(source: str, name: str, kind: str, bad: str, total: str, passes: str) -> str:
    return (f"SELECT '{source}' AS source, '{name}' AS \"check\", '{kind}' AS kind, CAST({bad} AS BIGINT) AS violations, "
            f"CAST({total} AS BIGINT) AS total, {passes} AS passed_if FROM {source} x")


def _null(source: str, column: str) -> str:
    return _check(source, f"not_null::{column}", "not_null", f'count(*) FILTER (x."{column}" IS NULL)', "count(*)", "0.01")


def _twice(source: str, column: str) -> str:
    bad = f"count(*) - count(DISTINCT {column}) - least(count(*) FILTER ({column} IS NULL), 1)"
    return _check(source, f"unique::{column}", "unique", bad, "count(*)", "0.0")


def _outside(source: str, column: str, low: int, high: int) -> str:
    return _check(source, f"range::{column}[{low},{high}]", "range",
                  f"count(*) FILTER ({column} NOT BETWEEN {low} AND {high})", f"count({column})", "0.005")


def _date(source: str, column: str, low: str = _EARLY) -> str:
    t = f"CAST({column} AS TIMESTAMP)"
    return _check(source, f"date_range::{column}", "date_range",
                  f"count(*) FILTER ({t} IS NULL OR {t} < {low} OR {t} > {_LATE})", "count(*)", "0.01")


CHECKS = " UNION ALL ".join([
    _null("patients", "patient_id"), _null("patients", "mrn"), _twice("patients", "patient_id"), _twice("patients", "mrn"),
    _check("patients", "in_set::gender", "in_set",
           "count(*) FILTER (gender IS NULL OR gender NOT IN ('MALE', 'FEMALE', 'OTHER', 'UNKNOWN'))", "count(*)", "0.001"),
    _null("patients", "zip_code"), _null("patients", "insurance_type"), _date("patients", "dob", "TIMESTAMP '1900-01-01'"),
    _outside("patients", "age_years", 0, 130),
    _null("encounters", "encounter_id"), _null("encounters", "patient_id"), _twice("encounters", "encounter_id"),
    _check("encounters", "referential_integrity::patient_id", "foreign_key",
           "count(*) FILTER (patient_id IS NULL OR NOT EXISTS (FROM patients p WHERE p.patient_id = x.patient_id))", "count(*)", "0.005"),
    _check("encounters", "in_set::encounter_type", "in_set",
           "count(*) FILTER (encounter_type IS NULL OR encounter_type NOT IN ('INPATIENT', 'OUTPATIENT', 'ED', 'TELEHEALTH'))",
           "count(*)", "0.001"),
    _date("encounters", "admit_datetime"), _null("encounters", "primary_diagnosis_icd10"), _outside("encounters", "los_days", 0, 365),
    _null("labs", "lab_result_id"), _null("labs", "patient_id"), _null("labs", "loinc_code"),
    _check("labs", "referential_integrity::patient_id", "foreign_key",
           "count(*) FILTER (patient_id IS NOT NULL AND NOT EXISTS (FROM patients p WHERE p.patient_id = x.patient_id))",
           "count(patient_id)", "0.005"),
    _check("labs", "in_set::abnormal_flag", "in_set",
           "count(*) FILTER (abnormal_flag NOT IN ('N', 'H', 'L', 'HH', 'LL', 'None'))", "count(*)", "0.001"),
    _date("labs", "collected_datetime"), _date("labs", "resulted_datetime"), _outside("labs", "tat_hours", 0, 168),
    _null("billing", "claim_id"), _null("billing", "patient_id"), _null("billing", "cpt_code"),
    _outside("billing", "charge_amount", 0, 1000000),
    _check("billing", "in_set::claim_status", "in_set",
           "count(*) FILTER (claim_status IS NULL OR claim_status NOT IN ('PAID', 'PENDING', 'DENIED', 'SUBMITTED'))", "count(*)", "0.001"),
    _null("billing", "payer_name"),
    _null("icu_vitals", "vital_id"), _null("icu_vitals", "patient_id"), _null("icu_vitals", "timestamp"),
    _outside("icu_vitals", "heart_rate", 20, 250), _outside("icu_vitals", "systolic_bp", 40, 280),
    _outside("icu_vitals", "spo2", 50, 100), _outside("icu_vitals", "temperature_celsius", 28, 44),
])

RESULTS = f"""SELECT source, "check", kind, violations, total, violations / greatest(total, 1) AS pct,
  CASE kind WHEN 'unique' THEN violations = 0 ELSE violations / greatest(total, 1) < passed_if END AS passed
FROM ({CHECKS}) c"""

COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS source, count(*) AS record_count FROM {n}"
                            for n in ("patients", "encounters", "labs", "billing", "icu_vitals"))

SCORES = f"""SELECT source, checks_passed, checks_total, record_count, score, score >= 0.95 AS gate_passed FROM (
  SELECT c.source, count(*) FILTER (passed) AS checks_passed, count(*) AS checks_total, n.record_count,
    count(*) FILTER (passed) / count(*) AS score
  FROM ({RESULTS}) c JOIN ({COUNTS}) n USING (source) WHERE n.record_count > 0 GROUP BY c.source, n.record_count) s"""


def overall(where: str = "TRUE") -> str:
    """The mean of the source scores, 0 without any; the gate looks at the unrounded mean."""
    return (f"SELECT coalesce(avg(score), 0.0) AS overall_score, count(*) AS sources, "
            f"coalesce(avg(score), 0.0) >= 0.95 AS gate_passed FROM ({SCORES}) s WHERE {where}")


def _samples(source: str, column: str, bad: str) -> str:
    return (f"SELECT * FROM (SELECT DISTINCT '{source}' AS source, 'in_set::{column}' AS \"check\", {column} AS value "
            f"FROM {source} WHERE {bad} ORDER BY value NULLS FIRST LIMIT 3) s")


#: the first three invalid values of each closed value list
SAMPLES = " UNION ALL ".join([
    _samples("patients", "gender", "gender IS NULL OR gender NOT IN ('MALE', 'FEMALE', 'OTHER', 'UNKNOWN')"),
    _samples("encounters", "encounter_type",
             "encounter_type IS NULL OR encounter_type NOT IN ('INPATIENT', 'OUTPATIENT', 'ED', 'TELEHEALTH')"),
    _samples("labs", "abnormal_flag", "abnormal_flag NOT IN ('N', 'H', 'L', 'HH', 'LL', 'None')"),
    _samples("billing", "claim_status", "claim_status IS NULL OR claim_status NOT IN ('PAID', 'PENDING', 'DENIED', 'SUBMITTED')"),
])

EXPECTATIONS = """
SELECT 'patients' AS suite, idx, expectation, "column", unexpected::BIGINT AS unexpected, element_count::BIGINT AS element_count,
  1.0 - unexpected / greatest(element_count, 1) >= mostly AS success
FROM (
  SELECT 0 AS idx, 'column_to_exist' AS expectation, 'patient_id' AS "column", 0 AS unexpected, 1 AS element_count, 1.0 AS mostly
  UNION ALL SELECT 1, 'not_null', 'patient_id', count(*) - count(patient_id), count(*), 1.0 FROM patients
  UNION ALL SELECT 2, 'unique', 'patient_id', count(*) FILTER (n > 1), count(*), 1.0
    FROM (SELECT count(*) OVER (PARTITION BY patient_id) AS n FROM patients WHERE patient_id IS NOT NULL) t
  UNION ALL SELECT 3, 'not_null', 'mrn', count(*) - count(mrn), count(*), 1.0 FROM patients
  UNION ALL SELECT 4, 'unique', 'mrn', count(*) FILTER (n > 1), count(*), 1.0
    FROM (SELECT count(*) OVER (PARTITION BY mrn) AS n FROM patients WHERE mrn IS NOT NULL) t
  UNION ALL SELECT 5, 'in_set', 'gender', count(*) FILTER (gender NOT IN ('MALE', 'FEMALE', 'OTHER', 'UNKNOWN')), count(gender), 0.999 FROM patients
  UNION ALL SELECT 6, 'not_null', 'dob', count(*) - count(dob), count(*), 0.99 FROM patients
  UNION ALL SELECT 7, 'between', 'age_years', count(*) FILTER (age_years NOT BETWEEN 0 AND 130), count(age_years), 0.999 FROM patients
  UNION ALL SELECT 8, 'not_null', 'insurance_type', count(*) - count(insurance_type), count(*), 0.99 FROM patients
  UNION ALL SELECT 9, 'in_set', 'insurance_type', count(*) FILTER (insurance_type NOT IN
    ('MEDICARE', 'MEDICAID', 'BCBS', 'AETNA', 'UNITED', 'CIGNA', 'HUMANA', 'SELF_PAY')), count(insurance_type), 0.99 FROM patients
) e"""
