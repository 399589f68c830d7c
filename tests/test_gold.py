"""Gold mart and models on hand-made rows (left joins, zero fill, empty facts)."""
import datetime as dt

from clinspark.operators import gold, silver

ENC = "encounter_id long, patient_id long, encounter_type string, admit_datetime timestamp_ntz, " \
      "discharge_datetime timestamp_ntz, primary_diagnosis_icd10 string, attending_physician_id string, " \
      "department string, facility_id string, los_days double, drg_code string, source_system string, " \
      "extracted_at timestamp_ntz"
PAT = "patient_id long, mrn string, gender string, dob date, zip_code string, insurance_type string, " \
      "primary_physician_id string, age_years int, age_group string, race string, ethnicity string, " \
      "source_system string, extracted_at timestamp_ntz"
LAB = "lab_result_id string, patient_id long, encounter_id long, abnormal_flag string, " \
      "collected_datetime timestamp_ntz, resulted_datetime timestamp_ntz, result_value double, " \
      "reference_range_low double, reference_range_high double"
BILL = "claim_id string, encounter_id long, charge_amount double, paid_amount double, claim_status string"

T0 = dt.datetime(2026, 1, 1, 8)


def frames(spark, labs=True, bills=True):
    enc = spark.createDataFrame([
        (1, 10, "INPATIENT", T0, T0 + dt.timedelta(days=15), "I10", "P", "CARDIOLOGY", "MAIN", None, "DRG_1", "EHR", T0),
        (2, 10, "ED", T0, T0 + dt.timedelta(hours=2), "I10", "P", "EMERGENCY", "MAIN", None, None, "EHR", T0),
        (3, 99, "Inpatient", T0, None, "I10", "P", "CARDIOLOGY", "MAIN", 8.5, "DRG_2", "EHR", T0),
    ], ENC)
    pat = spark.createDataFrame([(10, "PHI_a", "M", dt.date(1950, 1, 1), "10000", "MEDICARE", "P", 0, "x", None,
                                  None, "EHR", T0)], PAT)
    lab_rows = [("L1", 10, 1, "HH", T0, T0 + dt.timedelta(hours=2), 1.0, 0.5, 1.2),
                ("L2", 10, 1, "H", T0, T0 + dt.timedelta(hours=4), 1.0, 0.5, 1.2),
                ("L3", 10, None, "LL", T0, T0 + dt.timedelta(hours=1), 1.0, 0.5, 1.2)] if labs else []
    bill_rows = [("C1", 1, 100.0, None, "PENDING"), ("C2", 1, 50.0, None, "DENIED"),
                 ("C3", 2, 0.0, None, "PENDING")] if bills else []
    return (silver.transform_patients(pat), silver.transform_encounters(enc),
            silver.transform_labs(spark.createDataFrame(lab_rows, LAB)),
            spark.createDataFrame(bill_rows, BILL))


def test_mart_left_joins_without_zero_fill(spark):
    p, e, l, b = frames(spark)
    m = {r.encounter_id: r for r in gold.patient_encounter_mart(p, e, l, b).collect()}
    assert m[1].lab_count == 2 and m[1].critical_lab_count == 1 and m[1].abnormal_lab_count == 1
    assert m[2].lab_count is None                      # no labs: NULL, not 0
    assert m[1].total_paid == 0.0 and m[1].claim_count == 2   # all paid NULL -> 0
    assert m[3].gender is None and m[3].total_charges is None  # unknown patient, no claims
    assert m[1].data_layer == "GOLD"


def test_mart_with_empty_fact_tables(spark):
    p, e, l, b = frames(spark, labs=False, bills=False)
    m = gold.patient_encounter_mart(p, e, l, b).collect()
    assert {r.lab_count for r in m} == {0} and {r.critical_lab_count for r in m} == {0}
    assert {r.total_charges for r in m} == {0.0}
    assert "abnormal_lab_count" in gold.patient_encounter_mart(p, e, l, b).columns


def test_int_model_zero_fill_and_risk(spark):
    p, e, l, b = frames(spark)
    i = {r.encounter_id: r for r in gold.int_patient_encounters(gold.stg_patients(p), gold.stg_encounters(e),
                                                                   l, b).collect()}
    assert i[1].encounter_risk_score == "HIGH"           # los 15 > 14 and a critical lab
    assert i[1].collection_rate_pct == 0.0 and i[1].denied_claims == 1
    assert i[2].total_lab_orders == 0 and i[2].encounter_risk_score == "LOW"
    assert i[2].collection_rate_pct is None              # charge 0 -> NULL
    assert i[3].encounter_risk_score == "MEDIUM"         # open stay keeps input LOS 8.5
    assert i[3].encounter_type == "INPATIENT" and i[3].is_ed_visit is False
    assert i[2].is_ed_visit is True


def test_census_groups(spark):
    p, e, l, b = frames(spark)
    i = gold.int_patient_encounters(gold.stg_patients(p), gold.stg_encounters(e), l, b)
    rows = {(r.department, r.encounter_type): r for r in gold.mart_daily_census(i).collect()}
    c = rows[("CARDIOLOGY", "INPATIENT")]
    assert c.encounter_count == 2 and c.unique_patients == 2
    assert c.median_los_days == (15.0 + 8.5) / 2 and c.max_los_days == 15.0
    assert c.extended_stay_count == 1 and c.medicare_count == 1
    assert rows[("EMERGENCY", "ED")].low_risk_count == 1


def test_census_null_group_keys_survive(spark):
    """Groups with a NULL key are kept (the two aggregations join NULL-safely)."""
    from pyspark.sql import functions as F
    p, e, l, b = frames(spark)
    i = gold.int_patient_encounters(gold.stg_patients(p), gold.stg_encounters(e), l, b)
    i = i.withColumn("facility_id", F.lit(None).cast("string"))
    out = gold.mart_daily_census(i).collect()
    assert sum(r.encounter_count for r in out) == 3 and all(r.facility_id is None for r in out)


def test_census_counts_distinct_ids(spark):
    """Ids on several rows, of several groups and patients, and NULL ids, against a count in Python."""
    from pyspark.sql import functions as F
    p, e, l, b = frames(spark)
    i = gold.int_patient_encounters(gold.stg_patients(p), gold.stg_encounters(e), l, b)
    cols = ["encounter_id", "patient_id", "department", "los_days"]
    rows = [(n % 7 if n % 5 else None, n % 4 if n % 6 else None, "ABC"[n % 3] if n % 11 else None, float(n % 8) if n % 9 else None) for n in range(200)]
    made = spark.createDataFrame(rows, "encounter_id long, patient_id long, department string, los_days double")
    enc = i.limit(1).drop(*cols).crossJoin(made).withColumn("admit_datetime", F.lit("2024-05-01").cast("timestamp_ntz"))
    got = {r.department: r for r in gold.mart_daily_census(enc).collect()}
    for d in ("A", "B", "C", None):
        own = [r for r in rows if r[2] == d]
        los = sorted(r[3] for r in own if r[3] is not None)
        assert got[d].encounter_count == len({r[0] for r in own} - {None}) and got[d].unique_patients == len({r[1] for r in own} - {None})
        assert got[d].median_los_days == (los[(len(los) - 1) // 2] + los[len(los) // 2]) / 2 and got[d].max_los_days == max(los)
    assert len(got) == 4
