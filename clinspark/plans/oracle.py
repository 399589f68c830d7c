"""DuckDB text of the clinical views and models, for the correctness oracle.

An independent re-expression in SQL of ``sources.testdata`` (bronze),
``operators.silver`` and ``operators.gold``: the driver runs it against the
same parquet tables and compares with the Spark results. Output doubles are
rounded half-up through DECIMAL on both sides (``rnd``), which makes results
independent of summation order and binary representation.
"""
from __future__ import annotations

from .. import config as C

AS_OF = C.AS_OF_SQL
AS_OF_DATE = f"CAST({AS_OF} AS DATE)"


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v)) if isinstance(v, float) else str(v)


def pick(values, idx: str, typ: str = "VARCHAR") -> str:
    return f"(CAST([{', '.join(_lit(v) for v in values)}] AS {typ}[]))[({idx}) + 1]"


def inlist(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def ts_add(unit: str, amount: str, ts: str) -> str:
    fn = {"SECOND": "to_seconds", "MINUTE": "to_minutes", "HOUR": "to_hours", "DAY": "to_days"}[unit]
    return f"(({ts}) + {fn}(CAST(({amount}) AS BIGINT)))"


def shift(ts: str) -> str:
    return f"(({ts}) + INTERVAL {C.YEAR_SHIFT} YEAR)"


def mask(expr: str) -> str:
    return f"('{C.PHI_PREFIX}' || substr(sha256({expr}), 1, {C.MASK_HEX_CHARS}))"


EXTRACTED = ts_add("DAY", "-1", AS_OF)

# ---------------------------------------------------------------- functions --


def age_years(dob: str) -> str:
    return f"CAST(trunc(date_diff('day', {dob}, {AS_OF_DATE}) / CAST(365.25 AS DOUBLE)) AS INTEGER)"


def age_group(a: str) -> str:
    return (f"CASE WHEN {a} BETWEEN 0 AND 17 THEN '0-17' WHEN {a} BETWEEN 18 AND 34 THEN '18-34' "
            f"WHEN {a} BETWEEN 35 AND 49 THEN '35-49' WHEN {a} BETWEEN 50 AND 64 THEN '50-64' "
            f"WHEN {a} BETWEEN 65 AND 79 THEN '65-79' WHEN {a} >= 80 THEN '80+' ELSE 'UNKNOWN' END")


def age_bucket(a: str) -> str:
    return (f"CASE WHEN {a} BETWEEN 0 AND 17 THEN '0-17' WHEN {a} > 17 AND {a} <= 34 THEN '18-34' "
            f"WHEN {a} > 34 AND {a} <= 49 THEN '35-49' WHEN {a} > 49 AND {a} <= 64 THEN '50-64' "
            f"WHEN {a} > 64 AND {a} <= 79 THEN '65-79' WHEN {a} > 79 AND {a} <= 200 THEN '80+' "
            f"ELSE 'UNKNOWN' END")


def extract_age_group(a: str) -> str:
    return (f"CASE WHEN {a} < 18 THEN '0-17' WHEN {a} < 35 THEN '18-34' WHEN {a} < 50 THEN '35-49' "
            f"WHEN {a} < 65 THEN '50-64' WHEN {a} < 80 THEN '65-79' ELSE '80+' END")


def lab_flag(v: str, lo: str, hi: str) -> str:
    return (f"CASE WHEN {v} IS NULL THEN 'N' "
            f"WHEN {lo} IS NOT NULL AND {lo} <> 0 AND {v} < {lo} THEN "
            f"CASE WHEN {v} < {lo} * {C.LAB_LOW_CRITICAL_FACTOR} THEN 'LL' ELSE 'L' END "
            f"WHEN {hi} IS NOT NULL AND {hi} <> 0 AND {v} > {hi} THEN "
            f"CASE WHEN {v} > {hi} * {C.LAB_HIGH_CRITICAL_FACTOR} THEN 'HH' ELSE 'H' END ELSE 'N' END")


def elapsed_hours(a: str, b: str) -> str:
    return rnd(f"date_diff('microsecond', {a}, {b}) / 3600000000.0", 2)


def elapsed_days(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 86400000000.0)"


def alert_type(hr: str, spo2: str, sbp: str) -> str:
    return (f"CASE WHEN {hr} < {C.HR_LOW} OR {hr} > {C.HR_HIGH} THEN "
            f"CASE WHEN {hr} > {C.HR_HIGH} THEN 'TACHYCARDIA' ELSE 'BRADYCARDIA' END "
            f"WHEN {spo2} < {C.SPO2_LOW} THEN 'HYPOXIA' "
            f"WHEN {sbp} < {C.SBP_LOW} OR {sbp} > {C.SBP_HIGH} THEN 'BP_CRITICAL' END")


def clamp(name: str, v: str) -> str:
    lo, hi = C.VITAL_LIMITS[name]
    return f"CASE WHEN ({v}) IS NULL THEN NULL ELSE greatest({float(lo)}, least({float(hi)}, {v})) END"


def los_risk(v: str) -> str:
    return f"CASE WHEN {v} > 14 THEN 'CRITICAL' WHEN {v} > 7 THEN 'EXTENDED' ELSE 'NORMAL' END"


def collection_rate(paid: str, charge: str) -> str:
    return f"CASE WHEN {charge} > 0 THEN {rnd(f'{paid} / {charge} * 100', 2)} END"


def risk_score(los: str, crit: str, abn: str) -> str:
    return (f"CASE WHEN {los} > 14 AND {crit} > 0 THEN 'HIGH' "
            f"WHEN {los} > 7 OR {abn} > 3 THEN 'MEDIUM' ELSE 'LOW' END")


def dose(name: str) -> str:
    toks = f"regexp_split_to_array(trim({name}), '\\s+')"
    return f"CASE WHEN len({toks}) > 1 THEN {toks}[-1] ELSE 'N/A' END"


# ------------------------------------------------------------------- bronze --

def _patient_rows(insurance: str, extracted: str, where: str = "") -> str:
    dob = "(DATE '1920-01-01' + CAST((c_custkey * 7919) % 38990 AS INTEGER))"
    age = f"(year({AS_OF}) - year({dob}))"
    return f"""SELECT c_custkey AS patient_id,
  {mask("'MRN' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')")} AS mrn,
  {pick(['M', 'F', 'M', 'F', 'm', 'f', 'O', 'U', 'X', None], 'c_custkey % 10')} AS gender,
  {dob} AS dob,
  CAST(10000 + (c_custkey * 7) % 90000 AS VARCHAR) AS zip_code,
  {insurance} AS insurance_type,
  'PHYS_' || CAST(1000 + (c_custkey * 13) % 9000 AS VARCHAR) AS primary_physician_id,
  CAST({age} AS INTEGER) AS age_years,
  {extract_age_group(age)} AS age_group,
  CAST(NULL AS VARCHAR) AS race,
  CAST(NULL AS VARCHAR) AS ethnicity, 'EHR' AS source_system, {extracted} AS extracted_at
FROM customer {where}"""


RAW_PATIENTS = (_patient_rows("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AETNA' WHEN 'BUILDING' THEN 'MEDICARE' "
                              "WHEN 'FURNITURE' THEN 'BCBS' WHEN 'HOUSEHOLD' THEN 'MEDICAID' "
                              "WHEN 'MACHINERY' THEN 'CIGNA' END", EXTRACTED)
                + "\nUNION ALL\n"
                + _patient_rows("'SELF_PAY'", ts_add("HOUR", "-1", AS_OF), "WHERE c_acctbal < 0"))

_ETYPE = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'ED' WHEN '2-HIGH' THEN 'INPATIENT' "
          "WHEN '3-MEDIUM' THEN 'OUTPATIENT' WHEN '4-NOT SPECIFIED' THEN 'TELEHEALTH' "
          "WHEN '5-LOW' THEN 'Inpatient' END")
_ADMIT = ts_add("MINUTE", "(o_orderkey * 37) % 1440", shift("o_orderdate"))

RAW_ENCOUNTERS = f"""SELECT encounter_id, patient_id, encounter_type, admit_datetime,
  CASE WHEN NOT still_in THEN {ts_add('SECOND', 'units * 864', 'admit_datetime')} END AS discharge_datetime,
  primary_diagnosis_icd10, attending_physician_id, department, facility_id,
  CASE WHEN still_in THEN CAST(encounter_id % 30 AS DOUBLE) + 0.5
       WHEN inpatient THEN CAST(units AS DOUBLE) / 100 END AS los_days,
  CASE WHEN inpatient THEN 'DRG_' || CAST(100 + encounter_id % 900 AS VARCHAR) END AS drg_code,
  'EHR' AS source_system, {EXTRACTED} AS extracted_at
FROM (
  SELECT *, CASE WHEN inpatient THEN 100 + (encounter_id * 7919) % 2401
                 ELSE 2 + (encounter_id * 31) % 15 END AS units,
         inpatient AND o_orderstatus = 'O' AS still_in
  FROM (
    SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_orderstatus,
      {_ETYPE} AS encounter_type, upper({_ETYPE}) = 'INPATIENT' AS inpatient,
      {_ADMIT} AS admit_datetime,
      o_orderpriority AS primary_diagnosis_icd10,
      'PHYS_' || CAST(1000 + (o_orderkey * 7) % 9000 AS VARCHAR) AS attending_physician_id,
      substr(o_orderpriority, 3, 20) AS department,
      o_orderstatus AS facility_id
    FROM orders) a) b"""

_LOW = "CASE WHEN l_linenumber > 1 THEN CAST(8 + l_linenumber AS DOUBLE) END"
_HIGH = "CASE WHEN l_linenumber < 7 THEN CAST(42 - l_linenumber AS DOUBLE) END"
_LINE_ID = ("'{p}-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' "
            "|| CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)")
_COLLECTED = ts_add("MINUTE", "(l_orderkey * 17 + l_linenumber * 131) % 1440", shift("l_shipdate"))

RAW_LABS = f"""SELECT lab_result_id, patient_id, encounter_id, loinc_code, test_name, result_value,
  result_text, result_unit, reference_range_low, reference_range_high,
  {lab_flag('result_value', 'reference_range_low', 'reference_range_high')} AS abnormal_flag,
  collected_datetime, resulted_datetime, ordering_physician_id, lab_id, source_system, extracted_at
FROM (
  SELECT {_LINE_ID.format(p='LAB')} AS lab_result_id,
    l_suppkey AS patient_id,
    CASE WHEN l_discount >= 0.03 THEN l_orderkey END AS encounter_id,
    CAST(l_linenumber AS VARCHAR) || '-' || l_linestatus AS loinc_code,
    'LINE ' || CAST(l_linenumber AS VARCHAR) || l_returnflag AS test_name,
    l_quantity AS result_value,
    CAST(NULL AS VARCHAR) AS result_text,
    'pieces' AS result_unit,
    {_LOW} AS reference_range_low, {_HIGH} AS reference_range_high,
    {_COLLECTED} AS collected_datetime,
    {ts_add('SECOND', '(100 + (l_partkey * 7 + l_linenumber) % 501) * 36', _COLLECTED)} AS resulted_datetime,
    'PHYS_' || CAST(1000 + (l_partkey * 11) % 9000 AS VARCHAR) AS ordering_physician_id,
    'LAB_' || l_linestatus AS lab_id,
    'LAB' AS source_system, {EXTRACTED} AS extracted_at
  FROM lineitem) t"""

_STATUS = ("CASE WHEN l_returnflag = 'R' THEN 'DENIED' WHEN l_linestatus = 'F' THEN 'PAID' "
           "WHEN l_returnflag = 'A' THEN 'PENDING' ELSE 'SUBMITTED' END")
_SERVICE = f"CAST({shift('l_shipdate')} AS DATE)"

RAW_BILLING = f"""SELECT {_LINE_ID.format(p='CLM')} AS claim_id,
  l_partkey AS patient_id, l_orderkey AS encounter_id,
  'LINE ' || CAST(l_linenumber AS VARCHAR) AS cpt_code,
  l_returnflag AS icd10_code,
  l_extendedprice AS charge_amount,
  floor(l_extendedprice * 80) / 100 AS allowed_amount,
  CASE WHEN {_STATUS} = 'PAID' THEN floor(l_extendedprice * (1 - l_discount) * 100) / 100 END AS paid_amount,
  'PAYER_' || l_returnflag || l_linestatus AS payer_name,
  {_STATUS} AS claim_status,
  {_SERVICE} AS service_date,
  {_SERVICE} + CAST(1 + l_linenumber % 5 AS INTEGER) AS billing_date,
  'NPI' || CAST(1000000000 + (l_suppkey * 7919) % 1000000000 AS VARCHAR) AS provider_npi,
  l_linestatus AS facility_id,
  'BILLING' AS source_system, {EXTRACTED} AS extracted_at
FROM lineitem"""


def _reading(base: int, modulus: int, mix: str) -> str:
    return f"(CAST({base} + ({mix}) % {modulus} AS DOUBLE) / 10)"


_V100 = "CAST(round(value * 100) AS BIGINT)"
_HR = _reading(480, 870, f"{_V100} * 7 + event_id * 13")
_SBP = _reading(750, 1100, f"{_V100} * 11 + event_id * 3")
_DBP = _reading(450, 800, f"{_V100} * 5 + event_id * 7")
_SPO2 = _reading(890, 115, f"{_V100} + event_id")
_RR = _reading(50, 300, f"{_V100} * 3 + event_id")
_TEMP = _reading(345, 70, f"{_V100} + event_id * 3")
RAW_ICU = f"""SELECT event_id AS vital_id, user_id AS patient_id,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS encounter_id,
  'BED_' || lpad(CAST(1 + event_id % 30 AS VARCHAR), 2, '0') AS bed_id,
  upper(event_type) AS icu_unit, ts AS "timestamp",
  {clamp('heart_rate', _HR)} AS heart_rate,
  {clamp('systolic_bp', _SBP)} AS systolic_bp,
  {clamp('diastolic_bp', _DBP)} AS diastolic_bp,
  {rnd(f'({_SBP} + 2 * {_DBP}) / 3', 1)} AS mean_arterial_pressure,
  {clamp('spo2', _SPO2)} AS spo2,
  {clamp('respiratory_rate', _RR)} AS respiratory_rate,
  {clamp('temperature_celsius', _TEMP)} AS temperature_celsius,
  CAST(NULL AS DOUBLE) AS etco2,
  ({alert_type(_HR, _SPO2, _SBP)}) IS NOT NULL AS alert_triggered,
  {alert_type(_HR, _SPO2, _SBP)} AS alert_type,
  'ICU_MONITOR' AS source_system, {EXTRACTED} AS extracted_at
FROM events"""

_PRESCRIBED = "(DATE '2026-08-01' + CAST(p_size % 31 AS INTEGER))"

RAW_MEDICATIONS = f"""SELECT p_partkey AS medication_id, p_partkey AS patient_id,
  CASE WHEN p_size <= 30 THEN p_partkey END AS encounter_id,
  p_brand AS rxnorm_code, p_name AS drug_name, {dose('p_name')} AS dose,
  p_type AS route, CAST(NULL AS VARCHAR) AS frequency,
  CAST(p_size AS DOUBLE) * 5 + 7 AS quantity_dispensed, p_size AS days_supply,
  CAST(NULL AS VARCHAR) AS prescriber_npi, CAST(NULL AS VARCHAR) AS dispensing_pharmacy_id,
  {_PRESCRIBED} AS prescribed_date,
  CASE WHEN p_size NOT IN (1, 50) THEN {_PRESCRIBED} END AS dispensed_date,
  p_type AS status, 'PHARMACY' AS source_system, {EXTRACTED} AS extracted_at
FROM part"""

RAW_RADIOLOGY = f"""SELECT {_LINE_ID.format(p='RAD')} AS study_id, o_custkey AS patient_id, l_orderkey AS encounter_id,
  {_LINE_ID.format(p='ACC')} AS accession_number, l_returnflag AS modality, l_linestatus AS body_part,
  'LINE ' || CAST(l_linenumber AS VARCHAR) AS cpt_code,
  {shift('o_orderdate')} AS study_datetime, {shift('l_shipdate')} AS read_datetime,
  CAST(NULL AS VARCHAR) AS radiologist_id, CAST(NULL AS VARCHAR) AS ordering_physician_id,
  CAST(NULL AS VARCHAR) AS impression, o_orderstatus AS finding_category,
  {elapsed_hours(shift('o_orderdate'), shift('l_shipdate'))} AS tat_hours,
  'RADIOLOGY' AS source_system, {EXTRACTED} AS extracted_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_ROLE = ("CASE r_name WHEN 'AFRICA' THEN 'RN' WHEN 'AMERICA' THEN 'PHYSICIAN' WHEN 'ASIA' THEN 'PHARMACIST' "
         "WHEN 'EUROPE' THEN 'CLERK' WHEN 'MIDDLE EAST' THEN 'PORTER' END")
_LICENSED = "coalesce(r_name IN ('AFRICA', 'AMERICA', 'ASIA'), false)"

RAW_STAFF = f"""SELECT s_suppkey AS staff_id, s_name AS employee_id, {_ROLE} AS role,
  n_name AS department, r_name AS facility_id,
  CASE WHEN {_LICENSED} THEN 'NPI' || CAST(1000000000 + s_suppkey AS VARCHAR) END AS npi,
  CASE WHEN {_LICENSED} THEN {_ROLE} || '_LICENSE' END AS license_type,
  CAST(NULL AS DATE) AS license_expiry, CAST(NULL AS DATE) AS hire_date,
  CASE WHEN s_acctbal < 0 THEN 'ON_LEAVE' ELSE 'ACTIVE' END AS employment_status,
  CAST(NULL AS VARCHAR) AS shift_type, 'HR' AS source_system, {EXTRACTED} AS extracted_at
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

_SCHED = ts_add("DAY", "7", _ADMIT)
_APPT_STATUS = (f"CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'SCHEDULED' "
                "ELSE 'CANCELLED' END")
_START = f"CASE WHEN {_APPT_STATUS} = 'COMPLETED' THEN {ts_add('MINUTE', 'o_orderkey % 61 - 15', _SCHED)} END"

RAW_APPOINTMENTS = f"""SELECT o_orderkey AS appointment_id, o_custkey AS patient_id,
  'PHYS_' || CAST(1000 + o_orderkey % 100 AS VARCHAR) AS provider_id,
  o_orderpriority AS appointment_type,
  {_SCHED} AS scheduled_datetime,
  {_START} AS actual_start_datetime,
  {ts_add('MINUTE', '15 + o_orderkey % 46', _START)} AS actual_end_datetime,
  {_APPT_STATUS} AS status,
  substr(o_orderpriority, 3, 20) AS department,
  o_orderstatus AS facility_id,
  CAST(o_orderkey % 31 AS INTEGER) AS wait_time_days,
  CAST(NULL AS VARCHAR) AS referral_source,
  'SCHEDULING' AS source_system, {EXTRACTED} AS extracted_at
FROM orders"""

# ------------------------------------------------------------------- silver --

SILVER_PATIENTS = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY mrn ORDER BY extracted_at DESC, patient_id DESC) AS rn
  FROM (
    SELECT patient_id, mrn,
      coalesce(CASE upper(gender) WHEN 'M' THEN 'MALE' WHEN 'F' THEN 'FEMALE' WHEN 'O' THEN 'OTHER'
               WHEN 'U' THEN 'UNKNOWN' END, 'UNKNOWN') AS gender,
      dob, zip_code, insurance_type, primary_physician_id,
      {age_years('dob')} AS age_years,
      {age_bucket(age_years('dob'))} AS age_group,
      race, ethnicity, source_system, extracted_at,
      {AS_OF} AS transformed_at, 'SILVER' AS data_layer
    FROM raw_patients) x) y WHERE rn = 1"""

_LOS = (f"CASE WHEN discharge_datetime IS NOT NULL THEN "
        f"{rnd(elapsed_days('admit_datetime', 'discharge_datetime'), 2)} ELSE los_days END")

SILVER_ENCOUNTERS = f"""SELECT * EXCLUDE (los_days, new_los), new_los AS los_days,
  {los_risk('new_los')} AS los_risk,
  strftime(admit_datetime, '%Y-%m') AS year_month,
  {elapsed_hours('admit_datetime', 'discharge_datetime')} AS encounter_hours,
  {AS_OF} AS transformed_at, 'SILVER' AS data_layer
FROM (SELECT *, {_LOS} AS new_los FROM raw_encounters) e"""

_CLIP = ("CASE WHEN v1 IS NOT NULL AND reference_range_high IS NOT NULL AND v1 > reference_range_high * 10 "
         "THEN reference_range_high * 10 ELSE v1 END")

SILVER_LABS = f"""SELECT * EXCLUDE (result_value, v1), {_CLIP} AS result_value,
  {elapsed_hours('collected_datetime', 'resulted_datetime')} AS tat_hours,
  coalesce(abnormal_flag IN ('HH', 'LL'), false) AS is_critical,
  CASE WHEN abnormal_flag IN ('HH', 'LL') THEN 'CRITICAL' WHEN abnormal_flag IN ('H', 'L') THEN 'ABNORMAL'
       ELSE 'NORMAL' END AS result_category,
  {AS_OF} AS transformed_at, 'SILVER' AS data_layer
FROM (SELECT *, CASE WHEN reference_range_low IS NOT NULL AND result_value < reference_range_low * 0.1
                     THEN reference_range_low * 0.1 ELSE result_value END AS v1
      FROM raw_labs) l"""

SILVER_ICU = f"""SELECT *,
  CASE WHEN patient_id IS NOT NULL THEN {rnd('avg(heart_rate) OVER (PARTITION BY patient_id ORDER BY "timestamp", vital_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)', 1)} END AS hr_rolling_avg,
  {rnd('(systolic_bp + 2 * diastolic_bp) / 3', 1)} AS map_calculated,
  CASE WHEN spo2 < 94 THEN 'WATCH' WHEN coalesce(alert_triggered, false) THEN 'ALERT' ELSE 'STABLE' END AS vitals_status,
  {AS_OF} AS transformed_at, 'SILVER' AS data_layer
FROM raw_icu_vitals"""

BRONZE = {
    "raw_patients": RAW_PATIENTS,
    "raw_encounters": RAW_ENCOUNTERS,
    "raw_labs": RAW_LABS,
    "raw_billing": RAW_BILLING,
    "raw_icu_vitals": RAW_ICU,
    "raw_medications": RAW_MEDICATIONS,
    "raw_radiology": RAW_RADIOLOGY,
    "raw_staff": RAW_STAFF,
    "raw_appointments": RAW_APPOINTMENTS,
}
SILVER = {
    "patients": SILVER_PATIENTS,
    "encounters": SILVER_ENCOUNTERS,
    "labs": SILVER_LABS,
    "icu_vitals": SILVER_ICU,
    "billing": f"SELECT *, {AS_OF} AS transformed_at, 'SILVER' AS data_layer FROM raw_billing",
    "medications": f"SELECT *, {AS_OF} AS transformed_at, 'SILVER' AS data_layer FROM raw_medications",
    "radiology": f"SELECT *, {AS_OF} AS transformed_at, 'SILVER' AS data_layer FROM raw_radiology",
    "staff": f"SELECT *, {AS_OF} AS transformed_at, 'SILVER' AS data_layer FROM raw_staff",
    "appointments": f"SELECT *, {AS_OF} AS transformed_at, 'SILVER' AS data_layer FROM raw_appointments",
}

# ------------------------------------------------------------------- models --

STG_PATIENTS = f"""SELECT patient_id, mrn, gender, CAST(dob AS DATE) AS date_of_birth,
  CAST(age_years AS INTEGER) AS age_years, age_group, zip_code, upper(insurance_type) AS insurance_type,
  primary_physician_id, source_system, extracted_at, transformed_at, data_layer,
  {AS_OF} AS dbt_loaded_at, 'manual' AS dbt_run_id
FROM patients"""

STG_ENCOUNTERS = f"""SELECT encounter_id, patient_id, upper(encounter_type) AS encounter_type,
  admit_datetime, discharge_datetime, primary_diagnosis_icd10 AS icd10_code, attending_physician_id,
  upper(department) AS department, facility_id, CAST(los_days AS DOUBLE) AS los_days,
  upper(los_risk) AS los_risk, drg_code, year_month, CAST(encounter_hours AS DOUBLE) AS encounter_hours,
  source_system, data_layer,
  CASE WHEN los_days > 14 THEN TRUE ELSE FALSE END AS is_extended_stay,
  CASE WHEN encounter_type = 'ED' THEN TRUE ELSE FALSE END AS is_ed_visit,
  {AS_OF} AS dbt_loaded_at
FROM encounters WHERE encounter_id IS NOT NULL"""

LABS_AGG = """SELECT encounter_id, COUNT(*) AS total_lab_orders,
  CAST(SUM(CASE WHEN is_critical THEN 1 ELSE 0 END) AS BIGINT) AS critical_lab_count,
  CAST(SUM(CASE WHEN result_category = 'ABNORMAL' THEN 1 ELSE 0 END) AS BIGINT) AS abnormal_lab_count,
  AVG(tat_hours) AS avg_lab_tat_hours
FROM labs GROUP BY 1"""

BILLING_AGG = """SELECT encounter_id, SUM(charge_amount) AS total_charges,
  SUM(COALESCE(paid_amount, 0)) AS total_paid, COUNT(*) AS claim_count,
  CAST(SUM(CASE WHEN claim_status = 'DENIED' THEN 1 ELSE 0 END) AS BIGINT) AS denied_claims
FROM billing GROUP BY 1"""

INT_PATIENT_ENCOUNTERS = f"""SELECT e.encounter_id, e.patient_id, e.encounter_type, e.admit_datetime,
  e.discharge_datetime, e.icd10_code, e.department, e.facility_id, e.los_days, e.los_risk,
  e.is_extended_stay, e.is_ed_visit, e.year_month,
  p.gender, p.age_years, p.age_group, p.insurance_type, p.zip_code,
  COALESCE(l.total_lab_orders, 0) AS total_lab_orders,
  COALESCE(l.critical_lab_count, 0) AS critical_lab_count,
  COALESCE(l.abnormal_lab_count, 0) AS abnormal_lab_count,
  l.avg_lab_tat_hours,
  COALESCE(b.total_charges, 0) AS total_charges,
  COALESCE(b.total_paid, 0) AS total_paid,
  COALESCE(b.claim_count, 0) AS claim_count,
  COALESCE(b.denied_claims, 0) AS denied_claims,
  {collection_rate('b.total_paid', 'b.total_charges')} AS collection_rate_pct,
  {risk_score('e.los_days', 'l.critical_lab_count', 'l.abnormal_lab_count')} AS encounter_risk_score,
  {AS_OF} AS dbt_loaded_at
FROM stg_encounters e
LEFT JOIN stg_patients p ON e.patient_id = p.patient_id
LEFT JOIN labs_agg l ON e.encounter_id = l.encounter_id
LEFT JOIN billing_agg b ON e.encounter_id = b.encounter_id"""

MART_DAILY_CENSUS = f"""SELECT CAST(admit_datetime AS DATE) AS census_date, facility_id, department, encounter_type,
  COUNT(DISTINCT encounter_id) AS encounter_count,
  COUNT(DISTINCT patient_id) AS unique_patients,
  AVG(los_days) AS avg_los_days,
  quantile_cont(los_days, 0.5) AS median_los_days,
  MAX(los_days) AS max_los_days,
  CAST(SUM(CASE WHEN is_extended_stay THEN 1 ELSE 0 END) AS BIGINT) AS extended_stay_count,
  CAST(SUM(CASE WHEN encounter_risk_score = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_count,
  CAST(SUM(CASE WHEN encounter_risk_score = 'MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS medium_risk_count,
  CAST(SUM(CASE WHEN encounter_risk_score = 'LOW' THEN 1 ELSE 0 END) AS BIGINT) AS low_risk_count,
  SUM(total_charges) AS total_charges, SUM(total_paid) AS total_paid,
  AVG(collection_rate_pct) AS avg_collection_rate,
  COUNT(CASE WHEN insurance_type = 'MEDICARE' THEN 1 END) AS medicare_count,
  COUNT(CASE WHEN insurance_type = 'MEDICAID' THEN 1 END) AS medicaid_count,
  COUNT(CASE WHEN insurance_type = 'SELF_PAY' THEN 1 END) AS self_pay_count,
  AVG(age_years) AS avg_patient_age,
  COUNT(CASE WHEN age_years >= 65 THEN 1 END) AS senior_patient_count,
  {AS_OF} AS dbt_loaded_at
FROM int_patient_encounters GROUP BY 1, 2, 3, 4"""

MODELS = {
    "stg_patients": STG_PATIENTS,
    "stg_encounters": STG_ENCOUNTERS,
    "labs_agg": LABS_AGG,
    "billing_agg": BILLING_AGG,
    "int_patient_encounters": INT_PATIENT_ENCOUNTERS,
    "mart_daily_census": MART_DAILY_CENSUS,
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies resolved in order)."""
    deps = {
        "patients": ["raw_patients"], "encounters": ["raw_encounters"], "labs": ["raw_labs"],
        "billing": ["raw_billing"], "icu_vitals": ["raw_icu_vitals"], "medications": ["raw_medications"],
        "radiology": ["raw_radiology"], "staff": ["raw_staff"], "appointments": ["raw_appointments"],
        "stg_patients": ["patients"], "stg_encounters": ["encounters"], "labs_agg": ["labs"],
        "billing_agg": ["billing"],
        "int_patient_encounters": ["stg_patients", "stg_encounters", "labs_agg", "billing_agg"],
        "mart_daily_census": ["int_patient_encounters"],
    }
    order: list[str] = []

    def visit(n: str) -> None:
        for d in deps.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    texts = {**BRONZE, **SILVER, **MODELS}
    ctes = ",\n".join(f"{n} AS (\n{texts[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def stable(sql: str, doubles: dict[str, int] | list[str], digits: int = 6) -> str:
    """Round the named double columns of ``sql``'s result (half-up through DECIMAL)."""
    if isinstance(doubles, list):
        doubles = {c: digits for c in doubles}
    if not doubles:
        return sql
    repl = ", ".join(f"{rnd(f'q.{c}', d)} AS {c}" for c, d in doubles.items())
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) q"
