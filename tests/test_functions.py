"""Column functions on hand-made rows: each boundary quirk of the rules."""
import datetime as dt

from pyspark.sql import functions as F

from clinspark.functions import clinical as H


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_age_groups_boundaries(spark):
    df = rows(spark, [(a,) for a in [-1, 0, 17, 18, 34, 35, 79, 80, 200, 201, None]], "age int")
    assert col_values(df, H.age_group("age")) == [
        "UNKNOWN", "0-17", "0-17", "18-34", "18-34", "35-49", "65-79", "80+", "80+", "80+", "UNKNOWN"]
    # silver bins: right-closed up to 200, age 0 in the first bin, beyond 200 unknown
    assert col_values(df, H.age_bucket("age")) == [
        "UNKNOWN", "0-17", "0-17", "18-34", "18-34", "35-49", "65-79", "80+", "80+", "UNKNOWN", "UNKNOWN"]
    assert col_values(df, H.extract_age_group("age"))[:3] == ["0-17", "0-17", "0-17"]


def test_age_years_truncates(spark):
    df = rows(spark, [(dt.date(2000, 9, 2),), (dt.date(2000, 9, 1),), (dt.date(2026, 9, 2),)], "dob date")
    as_of = H.ts_lit("2026-09-01 00:00:00")
    # 9496 days / 365.25 = 25.998 -> 25 (days/365.25 truncated, not calendar years); -1 day -> 0
    assert col_values(df, H.age_years("dob", as_of)) == [25, 25, 0]


def test_los_risk_and_extended_stay(spark):
    df = rows(spark, [(None,), (7.0,), (7.01,), (14.0,), (14.01,)], "los double")
    assert col_values(df, H.los_risk("los")) == ["NORMAL", "NORMAL", "EXTENDED", "EXTENDED", "CRITICAL"]
    assert col_values(df, H.is_extended_stay("los")) == [False, False, False, False, True]


def test_los_recomputed_only_when_discharged(spark):
    df = rows(spark, [(dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 8, 0, 14, 24), 1.0),
                      (dt.datetime(2026, 1, 1), None, 3.5)],
              "a timestamp_ntz, d timestamp_ntz, los double")
    assert col_values(df, H.los_days("a", "d", "los")) == [7.01, 3.5]
    assert col_values(df, H.elapsed_hours("a", "d")) == [168.24, None]


def test_lab_flag_rules(spark):
    df = rows(spark, [(None, 1.0, 2.0), (0.6, 1.0, 2.0), (0.8, 1.0, 2.0), (1.5, 1.0, 2.0), (2.5, 1.0, 2.0),
                      (2.7, 1.0, 2.0), (0.1, None, 2.0), (9.0, 1.0, None), (0.1, 0.0, 2.0), (1.0, 1.0, 2.0)],
              "v double, lo double, hi double")
    assert col_values(df, H.lab_flag("v", "lo", "hi")) == ["N", "LL", "L", "N", "H", "HH", "N", "N", "N", "N"]


def test_critical_and_category(spark):
    df = rows(spark, [("HH",), ("LL",), ("H",), ("L",), ("N",), (None,)], "f string")
    assert col_values(df, H.is_critical_lab("f")) == [True, True, False, False, False, False]
    assert col_values(df, H.result_category("f")) == ["CRITICAL", "CRITICAL", "ABNORMAL", "ABNORMAL", "NORMAL", "NORMAL"]


def test_clip_outlier_missing_bounds(spark):
    df = rows(spark, [(0.01, 1.0, 2.0), (50.0, 1.0, 2.0), (0.01, None, 2.0), (50.0, 1.0, None), (None, 1.0, 2.0)],
              "v double, lo double, hi double")
    assert col_values(df, H.clip_outlier("v", "lo", "hi")) == [0.1, 20.0, 0.01, 50.0, None]


def test_vitals_status_watch_overrides_alert(spark):
    df = rows(spark, [(93.0, True), (94.0, True), (99.0, False), (None, None)], "spo2 double, alert boolean")
    assert col_values(df, H.vitals_status("spo2", "alert")) == ["WATCH", "ALERT", "STABLE", "STABLE"]


def test_icu_alert_first_match(spark):
    df = rows(spark, [(131.0, 85.0, 70.0), (49.0, 99.0, 120.0), (80.0, 85.0, 190.0), (80.0, 95.0, 79.0),
                      (80.0, 95.0, 120.0)], "hr double, spo2 double, sbp double")
    assert col_values(df, H.icu_alert_type("hr", "spo2", "sbp")) == [
        "TACHYCARDIA", "BRADYCARDIA", "HYPOXIA", "BP_CRITICAL", None]


def test_clamp_keeps_null(spark):
    df = rows(spark, [(250.0,), (10.0,), (None,)], "hr double")
    assert col_values(df, H.clamp_vital("heart_rate", F.col("hr"))) == [200.0, 30.0, None]


def test_map_and_rounding(spark):
    df = rows(spark, [(120.0, 80.0), (121.0, 80.0)], "s double, d double")
    assert col_values(df, H.mean_arterial_pressure("s", "d")) == [93.3, 93.7]
    one = spark.range(1)
    assert one.select(H.round_half_up(F.lit(1.005), 2)).first()[0] == 1.01
    assert one.select(H.round_half_up(F.lit(-2.5), 0)).first()[0] == -3.0


def test_collection_rate_and_risk(spark):
    df = rows(spark, [(50.0, 200.0), (10.0, 0.0), (None, 100.0)], "paid double, charge double")
    assert col_values(df, H.collection_rate("paid", "charge")) == [25.0, None, None]
    r = rows(spark, [(15.0, 1, 0), (15.0, 0, 0), (8.0, None, None), (None, None, 4), (None, None, None)],
             "los double, c long, a long")
    assert col_values(r, H.encounter_risk_score("los", "c", "a")) == ["HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "LOW"]


def test_gender_recode(spark):
    df = rows(spark, [("m",), ("F",), ("o",), ("U",), ("MALE",), ("X",), (None,)], "g string")
    assert col_values(df, H.recode_gender("g")) == ["MALE", "FEMALE", "OTHER", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_identity_functions(spark):
    import hashlib
    df = rows(spark, [("MRN0000001", "a", None)], "m string, x string, y string")
    masked = col_values(df, H.mask_identifier("m"))[0]
    assert masked == "PHI_" + hashlib.sha256(b"MRN0000001").hexdigest()[:12]
    assert col_values(df, H.mask_phi())[0] == "***PHI_MASKED***"
    key = col_values(df, H.surrogate_key("x", "y"))[0]
    assert key == hashlib.md5(b"a|_null_").hexdigest()
    assert key != col_values(df, H.surrogate_key("x"))[0]


def test_hour_boundaries(spark):
    df = rows(spark, [(dt.datetime(2026, 1, 1, 0, 59), dt.datetime(2026, 1, 1, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert col_values(df, H.date_diff_hours("a", "b")) == [1]
    assert col_values(df, H.year_month("a")) == ["2026-01"]


def test_medication_and_staff_rules(spark):
    df = rows(spark, [("Metformin 500mg",), ("Insulin Glargine 100U/mL",), ("Aspirin",)], "d string")
    assert col_values(df, H.dose_from_name("d")) == ["500mg", "100U/mL", "N/A"]
    r = rows(spark, [("RN",), ("ADMIN",)], "role string")
    assert col_values(r, H.licence_type("role")) == ["RN_LICENSE", None]


def test_format_pct_and_blank(spark):
    df = rows(spark, [(0.1234,), (None,)], "x double")
    assert col_values(df, H.format_pct("x")) == ["12.34%", None]
    assert col_values(df, H.blank_nulls("x")) == ["0.1234", ""]


def test_strict_and_lenient_casts(spark):
    """H2: strict casts raise on bad input (ANSI); H3: the lenient parse gives NULL."""
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql.types import StringType

    from clinspark.operators.quality import lenient_timestamp
    df = rows(spark, [("2026-01-01T10:00:00+02:00",), ("garbage",)], "s string")
    got = col_values(df, lenient_timestamp(F.col("s"), StringType()))
    assert got == [dt.datetime(2026, 1, 1, 10, 0), None]
    with pytest.raises(PySparkException):
        df.select(F.col("s").cast("date")).collect()


def test_metrics_json(spark):
    df = rows(spark, [(1, 0.5)], "n long, score double")
    assert col_values(df, H.metrics_json("n", "score")) == ['{"n":1,"score":0.5}']


def test_fhir_patient_and_encounter_resources(spark):
    import json
    from clinspark.functions.fhir import encounter_resource, patient_resource
    p = rows(spark, [(7, "PHI_abc", "FEMALE", dt.date(1980, 5, 1), "10001")],
             "patient_id long, mrn string, gender string, dob date, zip_code string")
    res = json.loads(col_values(p, patient_resource(p))[0])
    assert res == {"resourceType": "Patient", "id": "7", "identifier": [{"type": "MR", "value": "PHI_abc"}],
                   "gender": "female", "birthDate": "1980-05-01", "address": [{"postalCode": "10001"}]}
    e = rows(spark, [(3, 7, "ed", dt.datetime(2026, 1, 1, 8), None)],
             "encounter_id long, patient_id long, encounter_type string, admit_datetime timestamp_ntz, "
             "discharge_datetime timestamp_ntz")
    enc = json.loads(col_values(e, encounter_resource(e))[0])
    assert enc["class"] == "ED" and enc["subject"] == {"reference": "Patient/7"}
    assert enc["period"] == {"start": "2026-01-01 08:00:00"}          # NULL end is omitted


def test_round_half_up_keeps_special_values(spark):
    import math
    rows = [(1.005,), (2.675,), (-2.675,), (86.94999999999999,), (1e30,), (float("inf"),), (float("nan"),), (None,)]
    df = spark.createDataFrame(rows, "v double").select(H.round_half_up("v", 2).alias("r"), H.round_half_up("v", 1).alias("s"))
    r = [x.r for x in df.collect()]
    assert r[:3] == [1.01, 2.68, -2.68] and df.collect()[3].s == 87.0
    assert r[4] == 1e30 and r[5] == float("inf") and math.isnan(r[6]) and r[7] is None


def test_sql_macros_leave_the_session_as_it_was(spark):
    from clinspark.plans import registry
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION mask_phi(x STRING) RETURNS STRING RETURN 'own'")
    names = lambda: ({f.name for f in spark.catalog.listFunctions() if f.isTemporary}, {t.name for t in spark.catalog.listTables()})
    before = names()
    df = registry.queries()["sql_macros"](spark, "/root/testdata/sf0.001")
    assert names() == before and spark.sql("SELECT mask_phi('a')").first()[0] == "own"
    assert df.count() == 1500
    spark.sql("DROP TEMPORARY FUNCTION mask_phi")
