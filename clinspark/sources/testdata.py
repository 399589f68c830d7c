"""Bronze clinical tables derived from the driver's TPC-H-like parquet tables.

Each clinical source is a fixed expression over whole input tables (no
filters, no row caps; radiology and staff join their parents), so the clinical
tables grow linearly with the input and every scan keeps column pruning and
predicate pushdown. Categories are columns of the input.

| clinical      | from      | key                        |
|---------------|-----------|----------------------------|
| patients      | customer  | c_custkey (+ re-extract of debit accounts) |
| encounters    | orders    | o_orderkey                 |
| labs, billing | lineitem  | l_orderkey = encounter     |
| icu_vitals    | events    | event_id                   |
| medications   | part      | p_partkey                  |
| radiology     | lineitem, orders | line of the order   |
| staff         | supplier, nation, region | s_suppkey   |
| appointments  | orders    | o_orderkey                 |

The DuckDB text of the same views lives in ``clinspark.plans.oracle``.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import clinical as H

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Rules of this mapping: an accepted payer for each market segment, a role for each region.
SEGMENT_PAYERS = {"AUTOMOBILE": "AETNA", "BUILDING": "MEDICARE", "FURNITURE": "BCBS", "HOUSEHOLD": "MEDICAID",
                  "MACHINERY": "CIGNA"}
REGION_ROLES = {"AFRICA": "RN", "AMERICA": "PHYSICIAN", "ASIA": "PHARMACIST", "EUROPE": "CLERK", "MIDDLE EAST": "PORTER"}


# Declared input schemas (A1: read with a schema, no inference job per read).
INPUT_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = INPUT_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _shift(ts_col):
    return ts_col + F.expr(f"INTERVAL {C.YEAR_SHIFT} YEARS")


def _add(unit: str, amount, ts_col):
    return F.timestamp_add(unit, amount, ts_col)


def _as_of():
    return H.ts_lit(C.AS_OF)


def _str(c):
    return c.cast("string")


def _mapped(mapping: dict, c):
    """The value of a fixed map, NULL for others."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), c)


# ------------------------------------------------------------------ EHR --

def _patient_rows(c: DataFrame, insurance, extracted_at) -> DataFrame:
    key = F.col("c_custkey")
    dob = F.date_add(H.date_lit("1920-01-01"), ((key * 7919) % 38990).cast("int"))
    age = H.extract_age(dob, _as_of())
    return c.select(
        key.alias("patient_id"),
        H.mask_identifier(F.concat(F.lit("MRN"), F.lpad(_str(key), 7, "0"))).alias("mrn"),
        H.pick(["M", "F", "M", "F", "m", "f", "O", "U", "X", None], key % 10).alias("gender"),
        dob.alias("dob"),
        _str(F.lit(10000) + (key * 7) % 90000).alias("zip_code"),
        insurance.alias("insurance_type"),
        F.concat(F.lit("PHYS_"), _str(F.lit(1000) + (key * 13) % 9000)).alias("primary_physician_id"),
        age.alias("age_years"),
        H.extract_age_group(age).alias("age_group"),
        F.lit(None).cast("string").alias("race"),
        F.lit(None).cast("string").alias("ethnicity"),
        F.lit("EHR").alias("source_system"),
        extracted_at.alias("extracted_at"),
        F.sha2(F.concat(F.lit("MRN"), F.lpad(_str(key), 7, "0")), 256).alias("mrn_digest"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw patients: one extract of every customer, plus a later re-extract of
    accounts in debit whose payer changed to SELF_PAY (so MRN dedup keeps it)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    first = _patient_rows(c, _mapped(SEGMENT_PAYERS, F.col("c_mktsegment")),
                          F.timestamp_add("DAY", F.lit(-1), _as_of()))
    again = _patient_rows(c.where(F.col("c_acctbal") < 0), F.lit("SELF_PAY"),
                          F.timestamp_add("HOUR", F.lit(-1), _as_of()))
    return first.unionByName(again)


def _admit(o_key, o_date):
    return _add("MINUTE", (o_key * 37) % 1440, _shift(o_date))


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    key = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    etype = (F.when(prio == "1-URGENT", "ED").when(prio == "2-HIGH", "INPATIENT")
             .when(prio == "3-MEDIUM", "OUTPATIENT").when(prio == "4-NOT SPECIFIED", "TELEHEALTH")
             .when(prio == "5-LOW", "Inpatient"))
    inpatient = F.upper(etype) == "INPATIENT"
    admit = _admit(key, F.col("o_orderdate"))
    stay_units = F.when(inpatient, F.lit(100) + (key * 7919) % 2401).otherwise(F.lit(2) + (key * 31) % 15)
    still_in = inpatient & (F.col("o_orderstatus") == "O")
    discharge = F.when(~still_in, _add("SECOND", stay_units * 864, admit))
    raw_los = (F.when(still_in, (key % 30).cast("double") + F.lit(0.5))
               .when(inpatient, stay_units.cast("double") / F.lit(100)))
    return o.select(
        key.alias("encounter_id"),
        F.col("o_custkey").alias("patient_id"),
        etype.alias("encounter_type"),
        admit.alias("admit_datetime"),
        discharge.alias("discharge_datetime"),
        prio.alias("primary_diagnosis_icd10"),
        F.concat(F.lit("PHYS_"), _str(F.lit(1000) + (key * 7) % 9000)).alias("attending_physician_id"),
        F.substring(prio, 3, 20).alias("department"),
        F.col("o_orderstatus").alias("facility_id"),
        raw_los.alias("los_days"),
        F.when(inpatient, F.concat(F.lit("DRG_"), _str(F.lit(100) + key % 900))).alias("drg_code"),
        F.lit("EHR").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                                      "o_orderpriority")
    key = F.col("o_orderkey")
    sched = _add("DAY", F.lit(7), _admit(key, F.col("o_orderdate")))
    st = F.col("o_orderstatus")
    status = F.when(st == "F", "COMPLETED").when(st == "O", "SCHEDULED").otherwise("CANCELLED")
    start = F.when(status == "COMPLETED", _add("MINUTE", key % 61 - 15, sched))
    return o.select(
        key.alias("appointment_id"),
        F.col("o_custkey").alias("patient_id"),
        F.concat(F.lit("PHYS_"), _str(F.lit(1000) + key % 100)).alias("provider_id"),
        F.col("o_orderpriority").alias("appointment_type"),
        sched.alias("scheduled_datetime"),
        start.alias("actual_start_datetime"),
        _add("MINUTE", F.lit(15) + key % 46, start).alias("actual_end_datetime"),
        status.alias("status"),
        F.substring("o_orderpriority", 3, 20).alias("department"),
        st.alias("facility_id"),
        (key % 31).cast("int").alias("wait_time_days"),
        F.lit(None).cast("string").alias("referral_source"),
        F.lit("SCHEDULING").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


# ------------------------------------------------------------- lineitem --

def _line_id(prefix: str):
    return F.concat_ws("-", F.lit(prefix), _str(F.col("l_orderkey")), _str(F.col("l_linenumber")),
                       _str(F.col("l_partkey")), _str(F.col("l_suppkey")))


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate",
        "l_returnflag", "l_linestatus")
    line = F.col("l_linenumber")
    # own rule: bounds narrow with the line number; the first line has no lower, the last no upper bound
    low = F.when(line > 1, (F.lit(8) + line).cast("double"))
    high = F.when(line < 7, (F.lit(42) - line).cast("double"))
    value = F.col("l_quantity")
    collected = _add("MINUTE", (F.col("l_orderkey") * 17 + F.col("l_linenumber") * 131) % 1440,
                     _shift(F.col("l_shipdate")))
    resulted = _add("SECOND", (F.lit(100) + (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 501) * 36,
                    collected)
    return li.select(
        _line_id("LAB").alias("lab_result_id"),
        F.col("l_suppkey").alias("patient_id"),
        F.when(F.col("l_discount") >= 0.03, F.col("l_orderkey")).alias("encounter_id"),
        F.concat_ws("-", _str(line), "l_linestatus").alias("loinc_code"),
        F.concat(F.lit("LINE "), _str(line), F.col("l_returnflag")).alias("test_name"),
        value.alias("result_value"),
        F.lit(None).cast("string").alias("result_text"),
        F.lit("pieces").alias("result_unit"),
        low.alias("reference_range_low"),
        high.alias("reference_range_high"),
        H.lab_flag(value, low, high).alias("abnormal_flag"),
        collected.alias("collected_datetime"),
        resulted.alias("resulted_datetime"),
        F.concat(F.lit("PHYS_"), _str(F.lit(1000) + (F.col("l_partkey") * 11) % 9000)).alias("ordering_physician_id"),
        F.concat(F.lit("LAB_"), F.col("l_linestatus")).alias("lab_id"),
        F.lit("LAB").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    status = (F.when(rf == "R", "DENIED").when(ls == "F", "PAID")
              .when(rf == "A", "PENDING").otherwise("SUBMITTED"))
    price = F.col("l_extendedprice")
    service = F.to_date(_shift(F.col("l_shipdate")))
    return li.select(
        _line_id("CLM").alias("claim_id"),
        F.col("l_partkey").alias("patient_id"),
        F.col("l_orderkey").alias("encounter_id"),
        F.concat(F.lit("LINE "), _str(F.col("l_linenumber"))).alias("cpt_code"),
        rf.alias("icd10_code"),
        price.alias("charge_amount"),
        (F.floor(price * 80) / 100).alias("allowed_amount"),
        F.when(status == "PAID", F.floor(price * (F.lit(1) - F.col("l_discount")) * 100) / 100).alias("paid_amount"),
        F.concat(F.lit("PAYER_"), rf, ls).alias("payer_name"),
        status.alias("claim_status"),
        service.alias("service_date"),
        F.date_add(service, (F.lit(1) + F.col("l_linenumber") % 5).cast("int")).alias("billing_date"),
        F.concat(F.lit("NPI"), _str(F.lit(1000000000) + (F.col("l_suppkey") * 7919) % 1000000000)).alias("provider_npi"),
        ls.alias("facility_id"),
        F.lit("BILLING").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


# ------------------------------------------------------------------- ICU --

def _reading(base: int, modulus: int, mix):
    return (F.lit(base) + mix % modulus).cast("double") / F.lit(10)


def icu_vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ICU monitor rows: device readings derived from ``events.value``,
    alert rules on the unclamped readings, stored readings clamped (H17, H18)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return icu_from_events(ev)


def icu_from_events(ev: DataFrame) -> DataFrame:
    v100 = F.round(F.col("value") * 100).cast("long")
    eid = F.col("event_id")
    hr = _reading(480, 870, v100 * 7 + eid * 13)
    sbp = _reading(750, 1100, v100 * 11 + eid * 3)
    dbp = _reading(450, 800, v100 * 5 + eid * 7)
    spo2 = _reading(890, 115, v100 + eid)
    rr = _reading(50, 300, v100 * 3 + eid)
    temp = _reading(345, 70, v100 + eid * 3)
    unit = F.upper(F.col("event_type"))
    alert_type = H.icu_alert_type(hr, spo2, sbp)
    return ev.select(
        eid.alias("vital_id"),
        F.col("user_id").alias("patient_id"),
        F.get_json_object("props", "$.k").cast("long").alias("encounter_id"),
        F.concat(F.lit("BED_"), F.lpad(_str(F.lit(1) + eid % 30), 2, "0")).alias("bed_id"),
        unit.alias("icu_unit"),
        F.col("ts").alias("timestamp"),
        H.clamp_vital("heart_rate", hr).alias("heart_rate"),
        H.clamp_vital("systolic_bp", sbp).alias("systolic_bp"),
        H.clamp_vital("diastolic_bp", dbp).alias("diastolic_bp"),
        H.mean_arterial_pressure(sbp, dbp).alias("mean_arterial_pressure"),
        H.clamp_vital("spo2", spo2).alias("spo2"),
        H.clamp_vital("respiratory_rate", rr).alias("respiratory_rate"),
        H.clamp_vital("temperature_celsius", temp).alias("temperature_celsius"),
        F.lit(None).cast("double").alias("etco2"),
        alert_type.isNotNull().alias("alert_triggered"),
        alert_type.alias("alert_type"),
        F.lit("ICU_MONITOR").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


# ------------------------------------------- part, lineitem x orders, supplier --

def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is a drug: the last word of its name is taken for the dose."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    key, size = F.col("p_partkey"), F.col("p_size")
    prescribed = F.date_add(H.date_lit("2026-08-01"), (size % 31).cast("int"))
    return p.select(
        key.alias("medication_id"),
        key.alias("patient_id"),
        F.when(size <= 30, key).alias("encounter_id"),
        F.col("p_brand").alias("rxnorm_code"),
        F.col("p_name").alias("drug_name"),
        H.dose_from_name(F.col("p_name")).alias("dose"),
        F.col("p_type").alias("route"),
        F.lit(None).cast("string").alias("frequency"),
        (size.cast("double") * 5 + 7).alias("quantity_dispensed"),
        size.alias("days_supply"),
        F.lit(None).cast("string").alias("prescriber_npi"),
        F.lit(None).cast("string").alias("dispensing_pharmacy_id"),
        prescribed.alias("prescribed_date"),
        F.when(~size.isin(1, 50), prescribed).alias("dispensed_date"),
        F.col("p_type").alias("status"),
        F.lit("PHARMACY").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


def radiology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of an order is a study: ordered at the order date, read at the ship date (H9, negatives kept)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    both = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    study, read = _shift(F.col("o_orderdate")), _shift(F.col("l_shipdate"))
    return both.select(
        _line_id("RAD").alias("study_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("l_orderkey").alias("encounter_id"),
        _line_id("ACC").alias("accession_number"),
        F.col("l_returnflag").alias("modality"),
        F.col("l_linestatus").alias("body_part"),
        F.concat(F.lit("LINE "), _str(F.col("l_linenumber"))).alias("cpt_code"),
        study.alias("study_datetime"),
        read.alias("read_datetime"),
        F.lit(None).cast("string").alias("radiologist_id"),
        F.lit(None).cast("string").alias("ordering_physician_id"),
        F.lit(None).cast("string").alias("impression"),
        F.col("o_orderstatus").alias("finding_category"),
        H.elapsed_hours(study, read).alias("tat_hours"),
        F.lit("RADIOLOGY").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier is a member of staff whose role follows from the region."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    both = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left")
             .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    key, role = F.col("s_suppkey"), _mapped(REGION_ROLES, F.col("r_name"))
    return both.select(
        key.alias("staff_id"),
        F.col("s_name").alias("employee_id"),
        role.alias("role"),
        F.col("n_name").alias("department"),
        F.col("r_name").alias("facility_id"),
        F.when(H.licence_required(role), F.concat(F.lit("NPI"), _str(F.lit(1000000000) + key))).alias("npi"),
        H.licence_type(role).alias("license_type"),
        F.lit(None).cast("date").alias("license_expiry"),
        F.lit(None).cast("date").alias("hire_date"),
        F.when(F.col("s_acctbal") < 0, "ON_LEAVE").otherwise("ACTIVE").alias("employment_status"),
        F.lit(None).cast("string").alias("shift_type"),
        F.lit("HR").alias("source_system"),
        F.timestamp_add("DAY", F.lit(-1), _as_of()).alias("extracted_at"),
    )


SOURCES = {
    "patients": patients,
    "encounters": encounters,
    "labs": labs,
    "billing": billing,
    "appointments": appointments,
    "medications": medications,
    "radiology": radiology,
    "icu_vitals": icu_vitals,
    "staff": staff,
}


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return SOURCES[name](spark, sf_dir)
