"""Declared warehouse target schemas and ``conform``."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

_T = {"TEXT": StringType(), "REAL": DoubleType(), "INTEGER": IntegerType(), "BIGINT": LongType(),
      "BOOLEAN": BooleanType()}


def _schema(spec: str) -> StructType:
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _T[typ], True))
    return StructType(fields)


# Column lists and types of the target tables (fixed values of the warehouse DDL).
TARGETS: dict[str, StructType] = {
    "raw_patients": _schema(
        "patient_id TEXT, mrn TEXT, gender TEXT, dob TEXT, age_years INTEGER, age_group TEXT, zip_code TEXT, "
        "insurance_type TEXT, primary_physician_id TEXT, source_system TEXT, extracted_at TEXT, "
        "transformed_at TEXT, data_layer TEXT"),
    "raw_encounters": _schema(
        "encounter_id TEXT, patient_id TEXT, encounter_type TEXT, admit_datetime TEXT, discharge_datetime TEXT, "
        "primary_diagnosis_icd10 TEXT, attending_physician_id TEXT, department TEXT, facility_id TEXT, "
        "los_days REAL, los_risk TEXT, drg_code TEXT, year_month TEXT, encounter_hours REAL, "
        "source_system TEXT, data_layer TEXT"),
    "raw_labs": _schema(
        "lab_result_id TEXT, patient_id TEXT, encounter_id TEXT, loinc_code TEXT, test_name TEXT, "
        "result_value REAL, result_unit TEXT, abnormal_flag TEXT, result_category TEXT, is_critical INTEGER, "
        "tat_hours REAL, collected_datetime TEXT, resulted_datetime TEXT, ordering_physician_id TEXT, "
        "lab_id TEXT, source_system TEXT, data_layer TEXT"),
    "raw_billing": _schema(
        "claim_id TEXT, patient_id TEXT, encounter_id TEXT, cpt_code TEXT, icd10_code TEXT, charge_amount REAL, "
        "allowed_amount REAL, paid_amount REAL, payer_name TEXT, claim_status TEXT, service_date TEXT, "
        "billing_date TEXT, provider_npi TEXT, facility_id TEXT, source_system TEXT"),
    "raw_appointments": _schema(
        "appointment_id TEXT, patient_id TEXT, provider_id TEXT, appointment_type TEXT, status TEXT, "
        "department TEXT, scheduled_datetime TEXT, actual_start_datetime TEXT, actual_end_datetime TEXT, "
        "facility_id TEXT, wait_time_days INTEGER, source_system TEXT"),
    "raw_medications": _schema(
        "medication_id TEXT, patient_id TEXT, encounter_id TEXT, rxnorm_code TEXT, drug_name TEXT, dose TEXT, "
        "route TEXT, frequency TEXT, quantity_dispensed REAL, days_supply INTEGER, prescriber_npi TEXT, "
        "dispensing_pharmacy_id TEXT, prescribed_date TEXT, dispensed_date TEXT, status TEXT, source_system TEXT"),
    "raw_radiology": _schema(
        "study_id TEXT, patient_id TEXT, encounter_id TEXT, accession_number TEXT, modality TEXT, "
        "body_part TEXT, cpt_code TEXT, study_datetime TEXT, read_datetime TEXT, radiologist_id TEXT, "
        "ordering_physician_id TEXT, finding_category TEXT, tat_hours REAL, source_system TEXT"),
    "raw_icu_vitals": _schema(
        "vital_id TEXT, patient_id TEXT, encounter_id TEXT, bed_id TEXT, icu_unit TEXT, timestamp TEXT, "
        "heart_rate REAL, systolic_bp REAL, diastolic_bp REAL, mean_arterial_pressure REAL, spo2 REAL, "
        "respiratory_rate REAL, temperature_celsius REAL, map_calculated REAL, hr_rolling_avg REAL, "
        "vitals_status TEXT, alert_triggered INTEGER, alert_type TEXT, source_system TEXT, data_layer TEXT"),
    "raw_staff": _schema(
        "staff_id TEXT, employee_id TEXT, role TEXT, department TEXT, facility_id TEXT, npi TEXT, "
        "hire_date TEXT, employment_status TEXT, shift_type TEXT, source_system TEXT"),
    "mart_patient_encounters": _schema(
        "encounter_id TEXT, patient_id TEXT, encounter_type TEXT, admit_datetime TEXT, discharge_datetime TEXT, "
        "los_days REAL, los_risk TEXT, department TEXT, facility_id TEXT, gender TEXT, age_years INTEGER, "
        "age_group TEXT, insurance_type TEXT, zip_code TEXT, lab_count REAL, critical_lab_count REAL, "
        "total_charges REAL, data_layer TEXT, mart_created_at TEXT"),
    "pipeline_runs": _schema(
        "run_id TEXT, started_at TEXT, completed_at TEXT, status TEXT, total_records INTEGER, "
        "quality_score REAL, duration_minutes REAL, metrics_json TEXT"),
}


def _cast(col, target: DataType):
    if isinstance(target, IntegerType):
        # booleans load as 0/1 (A5)
        return col.cast("int")
    return col.cast(target)


def conform(df: DataFrame, schema: StructType, keep_extra: bool = False) -> DataFrame:
    """Select the declared columns in order, cast to the declared types, add missing as NULL."""
    present = set(df.columns)
    cols = [(_cast(F.col(f.name), f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]
    if keep_extra:
        declared = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in declared]
    return df.select(*cols)
