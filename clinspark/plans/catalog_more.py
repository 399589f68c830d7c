"""Registered queries, part two: insights, quality, scalar functions, FHIR, load formats."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import config as C
from ..functions import clinical as H
from ..functions.fhir import observation_resource, parse_observations
from ..functions.macros import drop_sql_macros, register_sql_macros
from ..operators import gold, insights, quality, silver
from ..schemas import TARGETS, conform
from ..sources.sinks import load_format, table_counts
from . import oracle as O
from . import quality_oracle as QO
from .catalog import Tables, _doubles_sql, register, stable

V = O.with_views

# ------------------------------------------------------------------ D7 KPIs --

_KPI_SQL = V(f"""
SELECT 'total_patients' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM patients
UNION ALL SELECT 'total_encounters', COUNT(*) FROM encounters
UNION ALL SELECT 'avg_inpatient_los', {O.rnd("AVG(CASE WHEN encounter_type = 'INPATIENT' THEN los_days END)", 1)} FROM encounters
UNION ALL SELECT 'total_labs', COUNT(*) FROM labs
UNION ALL SELECT 'critical_labs', COUNT(*) FILTER (WHERE result_category = 'CRITICAL') FROM labs
UNION ALL SELECT 'total_billing', COUNT(*) FROM billing
UNION ALL SELECT 'total_charges', {O.rnd('COALESCE(SUM(charge_amount), 0.0)', 2)} FROM billing
UNION ALL SELECT 'total_paid', {O.rnd('COALESCE(SUM(paid_amount), 0.0)', 2)} FROM billing
UNION ALL SELECT 'collection_rate', {O.rnd('COALESCE(SUM(paid_amount), 0.0) / greatest(COALESCE(SUM(charge_amount), 0.0), 1.0) * 100', 1)} FROM billing
UNION ALL SELECT 'icu_readings', COUNT(*) FROM icu_vitals
UNION ALL SELECT 'alerts', COUNT(*) FILTER (WHERE alert_triggered) FROM icu_vitals
UNION ALL SELECT 'alert_rate', {O.rnd('COUNT(*) FILTER (WHERE alert_triggered) / greatest(COUNT(*), 1) * 100', 2)} FROM icu_vitals
""", "patients", "encounters", "labs", "billing", "icu_vitals")


@register("kpi_summary", _doubles_sql(_KPI_SQL, ["value"]))
def kpi_summary(spark, sf_dir):
    """Dashboard KPI tiles over all rows."""
    t = Tables(spark, sf_dir)
    return stable(insights.kpi_summary(t.silver("patients"), t.silver("encounters"), t.silver("labs"),
                                       t.silver("billing"), t.silver("icu_vitals")))


# -------------------------------------------------------- D8/F3 breakdowns --

_BREAKDOWNS = [  # (chart, table, column, top-k)
    ("payer_mix", "billing", "payer_name", 5),
    ("encounter_types", "encounters", "encounter_type", None),
    ("departments", "encounters", "department", 6),
    ("lab_categories", "labs", "result_category", None),
    ("modalities", "radiology", "modality", None),
    ("top_drugs", "medications", "drug_name", 5),
    ("top_lab_tests", "labs", "test_name", 10),          # lab chart: 10 most ordered tests
    ("top_departments", "encounters", "department", 8),  # encounter chart: 8 busiest departments
]


def _breakdown_sql(chart, table, col, top):
    lim = f"WHERE rank <= {top}" if top else ""
    return (f"SELECT * FROM (SELECT '{chart}' AS chart, category, count, row_number() OVER "
            f"(ORDER BY count DESC, category) AS rank FROM (SELECT CAST({col} AS VARCHAR) AS category, "
            f"COUNT(*) AS count FROM {table} WHERE {col} IS NOT NULL GROUP BY 1) c) r {lim}")


@register("dashboard_breakdowns", V(" UNION ALL ".join(_breakdown_sql(*b) for b in _BREAKDOWNS),
                                    "billing", "encounters", "labs", "radiology", "medications"))
def dashboard_breakdowns(spark, sf_dir):
    """D8 + F3: category frequencies and top-k lists of the dashboard."""
    t = Tables(spark, sf_dir)
    parts = [insights.breakdown(t.silver(table), col, top, chart) for chart, table, col, top in _BREAKDOWNS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("rank", F.col("rank").cast("long"))


@register("category_shares", _doubles_sql(V("""
SELECT chart, category, count, count * 100.0 / SUM(count) OVER (PARTITION BY chart) AS share_pct FROM (
  SELECT 'lab_categories' AS chart, result_category AS category, COUNT(*) AS count
  FROM labs WHERE result_category IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'payer_mix', p.insurance_type, COUNT(*) FROM encounters e
  LEFT JOIN patients p ON e.patient_id = p.patient_id WHERE p.insurance_type IS NOT NULL GROUP BY 2) c""",
                                            "labs", "encounters", "patients"), ["share_pct"], 2))
def category_shares(spark, sf_dir):
    """Pie percentages (share of total) of lab categories and the mart's payer mix."""
    t = Tables(spark, sf_dir)
    mart = gold.patient_encounter_mart(t.silver("patients"), t.silver("encounters"), t.silver("labs"),
                                       t.silver("billing"))
    counts = (insights.breakdown(t.silver("labs"), "result_category", chart="lab_categories")
              .unionByName(insights.breakdown(mart, "insurance_type", chart="payer_mix")).drop("rank"))
    return insights.share_of_total(counts)


@register("icu_alert_rate_by_unit", _doubles_sql(V(
    f"SELECT icu_unit, {O.rnd('AVG(CAST(alert_triggered AS DOUBLE))', 4)} * 100 AS alert_triggered_pct "
    "FROM icu_vitals GROUP BY 1", "icu_vitals"), ["alert_triggered_pct"]))
def icu_alert_rate_by_unit(spark, sf_dir):
    """Alert rate per ICU unit (mean, round 4, times 100), over all readings."""
    return stable(insights.rate_by(Tables(spark, sf_dir).silver("icu_vitals"), "icu_unit", "alert_triggered"))


# --------------------------------------------------------------- D11 hists --

_SERIES = [  # (series, source, column, lo, hi, bins)
    ("heart_rate", "icu_vitals", "heart_rate", 30, 200, 50),
    ("systolic_bp", "icu_vitals", "systolic_bp", 60, 220, 50),
    ("spo2", "icu_vitals", "spo2", 70, 100, 50),
    ("temperature_celsius", "icu_vitals", "temperature_celsius", 35, 41, 50),
    ("lab_tat_hours", "labs", "tat_hours", 0, 24, 40),
    ("inpatient_los_days", "inpatient", "los_days", 0, 30, 30),
]


def _long_spark(t: Tables):
    icu, labs = t.silver("icu_vitals"), t.silver("labs")
    inpatient = t.silver("encounters").where(F.col("encounter_type") == "INPATIENT")
    src = {"icu_vitals": icu, "labs": labs, "inpatient": inpatient}
    by_src = {}
    for name, s, col, lo, hi, _ in _SERIES:
        by_src.setdefault(s, []).append((name, col, lo, hi))
    parts = [insights.clipped_series(src[s], specs) for s, specs in by_src.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _long_sql():
    tbl = {"icu_vitals": "icu_vitals", "labs": "labs",
           "inpatient": "(SELECT * FROM encounters WHERE encounter_type = 'INPATIENT')"}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS series, greatest({float(lo)}, least({float(hi)}, {col})) AS value "
        f"FROM {tbl[s]} x WHERE {col} IS NOT NULL" for name, s, col, lo, hi, _ in _SERIES)


_SPEC_SQL = "(VALUES " + ", ".join(f"('{n}', {b})" for n, *_, b in _SERIES) + ") AS spec(series, bins)"

_HIST_SQL = V(f"""SELECT series, CAST(bin AS INTEGER) AS bin,
  lo + bin * (hi - lo) / bins AS bin_low, lo + (bin + 1) * (hi - lo) / bins AS bin_high, COUNT(*) AS count
FROM (SELECT l.series, l.value, s.lo, s.hi, spec.bins,
        CASE WHEN s.hi - s.lo > 0 THEN least(floor((l.value - s.lo) * (spec.bins / (s.hi - s.lo))), spec.bins - 1)
             ELSE 0 END AS bin
      FROM ({_long_sql()}) l
      JOIN (SELECT series, min(value) AS lo, max(value) AS hi FROM ({_long_sql()}) z GROUP BY 1) s ON l.series = s.series
      JOIN {_SPEC_SQL} ON l.series = spec.series) b
GROUP BY series, bin, lo, hi, bins""", "icu_vitals", "labs", "encounters")


@register("vitals_histogram", _doubles_sql(_HIST_SQL, ["bin_low", "bin_high"]))
def vitals_histogram(spark, sf_dir):
    """Clipped equal-width histograms (ICU vitals 50 bins, lab TAT 40, inpatient LOS 30)."""
    long = _long_spark(Tables(spark, sf_dir))
    return stable(insights.histogram(long, {n: b for n, *_, b in _SERIES}))


@register("series_summary", _doubles_sql(V(
    f"SELECT series, COUNT(*) AS n, AVG(value) AS mean, median(value) AS median FROM ({_long_sql()}) l GROUP BY 1",
    "icu_vitals", "labs", "encounters"), ["mean", "median"]))
def series_summary(spark, sf_dir):
    """D11 + D6: count, mean and exact median of each clipped series."""
    return stable(insights.series_summary(_long_spark(Tables(spark, sf_dir))))


@register("icu_alert_windows", _doubles_sql(V(
    "SELECT time_bucket(INTERVAL 5 MINUTE, \"timestamp\") AS window_start, "
    "time_bucket(INTERVAL 5 MINUTE, \"timestamp\") + INTERVAL 5 MINUTE AS window_end, icu_unit, "
    "COUNT(*) AS readings, COUNT(*) FILTER (WHERE alert_triggered) AS alerts, AVG(heart_rate) AS mean_hr "
    "FROM icu_vitals GROUP BY 1, 2, 3", "icu_vitals"), ["mean_hr"]))
def icu_alert_windows(spark, sf_dir):
    """S2 (batch form): 5-minute tumbling windows per ICU unit."""
    return stable(insights.alert_windows(Tables(spark, sf_dir).silver("icu_vitals")))


# ------------------------------------------------------------- D12 stats --

_STATS_SQL = V(f"""
SELECT 'patients' AS "table", 'input' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM raw_patients
UNION ALL SELECT 'patients', 'output', COUNT(*) FROM patients
UNION ALL SELECT 'patients', 'dupes_removed', (SELECT COUNT(*) FROM raw_patients) - (SELECT COUNT(*) FROM patients)
UNION ALL SELECT 'encounters', 'input', COUNT(*) FROM raw_encounters
UNION ALL SELECT 'encounters', 'output', COUNT(*) FROM encounters
UNION ALL SELECT 'labs', 'input', COUNT(*) FROM raw_labs
UNION ALL SELECT 'labs', 'output', COUNT(*) FROM labs
UNION ALL SELECT 'labs', 'critical_values', COUNT(*) FILTER (WHERE is_critical) FROM labs
UNION ALL SELECT 'labs', 'abnormal_pct', {O.rnd("AVG(CASE WHEN result_category = 'ABNORMAL' THEN 1.0 ELSE 0.0 END) * 100", 1)} FROM labs
UNION ALL SELECT 'icu_vitals', 'input', COUNT(*) FROM raw_icu_vitals
UNION ALL SELECT 'icu_vitals', 'output', COUNT(*) FROM icu_vitals
UNION ALL SELECT 'icu_vitals', 'alerts_triggered', COUNT(*) FILTER (WHERE alert_triggered) FROM icu_vitals
UNION ALL SELECT 'icu_vitals', 'alert_rate_pct', {O.rnd('AVG(CAST(alert_triggered AS DOUBLE)) * 100', 2)} FROM icu_vitals
""", "patients", "encounters", "labs", "icu_vitals")


@register("transform_stats", _doubles_sql(_STATS_SQL, ["value"]))
def transform_stats(spark, sf_dir):
    """Per-table transform statistics."""
    t = Tables(spark, sf_dir)
    parts = [silver.transform_stats("patients", silver.transform_patients(t.raw("patients"), copies="_copies"), "_copies"),
             *(silver.transform_stats(n, t.silver(n)) for n in ["encounters", "labs", "icu_vitals"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return stable(out)


# ---------------------------------------------------------------- quality --

_QSRC = ("patients", "encounters", "labs", "billing", "icu_vitals")


def _checks_spark(t: Tables, with_count: bool = False):
    data = {n: t.silver(n) for n in quality.SUITE_ORDER}
    return quality.run_checks(data, data["patients"], with_count=with_count)


@register("quality_checks", _doubles_sql(V(
    f"SELECT *, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM ({QO.RESULTS}) q", *_QSRC), ["pct"]))
def quality_checks(spark, sf_dir):
    """Q1-Q7 (+G1): every check of the five source suites, one row each."""
    return stable(_checks_spark(Tables(spark, sf_dir)))


def _scores_spark(t: Tables):
    return quality.score_sources(_checks_spark(t, with_count=True))


@register("quality_source_scores", _doubles_sql(V(QO.SCORES, *_QSRC), ["score"]))
def quality_source_scores(spark, sf_dir):
    """Q8: per-source score and source gate."""
    return stable(_scores_spark(Tables(spark, sf_dir)))


@register("quality_overall", _doubles_sql(V(QO.overall(), *_QSRC), ["overall_score"]))
def quality_overall(spark, sf_dir):
    """Q9: overall score = mean of source scores, gate >= 0.95."""
    return stable(quality.overall(_scores_spark(Tables(spark, sf_dir))))


@register("quality_overall_empty", _doubles_sql(V(QO.overall("record_count < 0"), *_QSRC), ["overall_score"]))
def quality_overall_empty(spark, sf_dir):
    """Q9 with no source left: score 0.0, gate not passed."""
    return stable(quality.overall(_scores_spark(Tables(spark, sf_dir)).where("record_count < 0")))


@register("gate_decision", _doubles_sql(V(
    f"SELECT o.*, CASE WHEN gate_passed THEN 'LOAD' ELSE 'HALT' END AS decision, "
    f"coalesce((SELECT string_agg(source, ',' ORDER BY source) FROM ({QO.SCORES}) f WHERE NOT gate_passed), '') AS failing_sources "
    f"FROM ({QO.overall()}) o", *_QSRC), ["overall_score"]))
def gate_decision(spark, sf_dir):
    """Q10: whether a run goes on to load, and which sources fail on their own."""
    return stable(quality.gate_decision(_scores_spark(Tables(spark, sf_dir))))


@register("quality_record_estimates", V(
    "SELECT source, record_count, CAST(CASE WHEN gate_passed THEN record_count ELSE floor(record_count * score) END AS BIGINT) "
    "AS passed_records, CAST(CASE WHEN gate_passed THEN 0 ELSE floor(record_count * (1 - score)) END AS BIGINT) "
    f"AS failed_records FROM ({QO.SCORES}) s", *_QSRC))
def quality_record_estimates(spark, sf_dir):
    """Q11: passed / failed record estimates per source."""
    return quality.record_estimates(_scores_spark(Tables(spark, sf_dir)))


@register("invalid_samples", V(QO.SAMPLES, *_QSRC))
def invalid_samples(spark, sf_dir):
    """first three distinct invalid values of every in-set check, sorted."""
    t = Tables(spark, sf_dir)
    parts = [quality.invalid_samples(t.silver(n), r, 3, n) for n in quality.SUITE_ORDER
             for r in quality.suite_rules(n, t.silver(n), None) if r.kind == "in_set"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _mt(model, test, col, cond):
    return (f"SELECT '{model}' AS model, '{test}' AS test, '{col}' AS \"column\", CAST(({cond}) AS BIGINT) AS failures")


_MODEL_TESTS_SQL = " UNION ALL ".join([
    _mt("stg_patients", "unique", "patient_id", "SELECT COUNT(*) FROM (SELECT patient_id FROM stg_patients WHERE patient_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    _mt("stg_patients", "not_null", "patient_id", "SELECT COUNT(*) FROM stg_patients WHERE patient_id IS NULL"),
    _mt("stg_patients", "unique", "mrn", "SELECT COUNT(*) FROM (SELECT mrn FROM stg_patients WHERE mrn IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    _mt("stg_patients", "not_null", "mrn", "SELECT COUNT(*) FROM stg_patients WHERE mrn IS NULL"),
    _mt("stg_patients", "not_null", "gender", "SELECT COUNT(*) FROM stg_patients WHERE gender IS NULL"),
    _mt("stg_patients", "accepted_values", "gender", f"SELECT COUNT(*) FROM stg_patients WHERE gender NOT IN {O.inlist(C.GENDER_VALUES)}"),
    _mt("stg_patients", "not_null", "age_years", "SELECT COUNT(*) FROM stg_patients WHERE age_years IS NULL"),
    _mt("stg_patients", "accepted_range", "age_years", "SELECT COUNT(*) FROM stg_patients WHERE NOT (age_years >= 0 AND age_years <= 130)"),
    _mt("stg_patients", "not_null", "insurance_type", "SELECT COUNT(*) FROM stg_patients WHERE insurance_type IS NULL"),
    _mt("stg_patients", "accepted_values", "insurance_type", f"SELECT COUNT(*) FROM stg_patients WHERE insurance_type NOT IN {O.inlist(C.INSURANCE_ACCEPTED)}"),
    _mt("stg_encounters", "unique", "encounter_id", "SELECT COUNT(*) FROM (SELECT encounter_id FROM stg_encounters WHERE encounter_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    _mt("stg_encounters", "not_null", "encounter_id", "SELECT COUNT(*) FROM stg_encounters WHERE encounter_id IS NULL"),
    _mt("stg_encounters", "not_null", "patient_id", "SELECT COUNT(*) FROM stg_encounters WHERE patient_id IS NULL"),
    _mt("stg_encounters", "relationships", "patient_id", "SELECT COUNT(*) FROM stg_encounters e WHERE patient_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_patients p WHERE p.patient_id = e.patient_id)"),
    _mt("stg_encounters", "not_null", "encounter_type", "SELECT COUNT(*) FROM stg_encounters WHERE encounter_type IS NULL"),
    _mt("stg_encounters", "accepted_values", "encounter_type", f"SELECT COUNT(*) FROM stg_encounters WHERE encounter_type NOT IN {O.inlist(C.ENCOUNTER_TYPES)}"),
    _mt("stg_encounters", "accepted_range", "los_days", "SELECT COUNT(*) FROM stg_encounters WHERE los_days IS NOT NULL AND NOT (los_days >= 0 AND los_days <= 365)"),
    _mt("int_patient_encounters", "unique", "encounter_id", "SELECT COUNT(*) FROM (SELECT encounter_id FROM int_patient_encounters WHERE encounter_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"),
    _mt("int_patient_encounters", "not_null", "encounter_id", "SELECT COUNT(*) FROM int_patient_encounters WHERE encounter_id IS NULL"),
    _mt("int_patient_encounters", "accepted_values", "encounter_risk_score", "SELECT COUNT(*) FROM int_patient_encounters WHERE encounter_risk_score NOT IN ('HIGH', 'MEDIUM', 'LOW')"),
    _mt("mart_daily_census", "not_null", "census_date", "SELECT COUNT(*) FROM mart_daily_census WHERE census_date IS NULL"),
    _mt("mart_daily_census", "accepted_range", "avg_los_days", "SELECT COUNT(*) FROM mart_daily_census WHERE NOT (avg_los_days >= 0 AND avg_los_days <= 365)"),
])


@register("model_tests", V(
    f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({_MODEL_TESTS_SQL}) t",
    "mart_daily_census"))
def model_tests(spark, sf_dir):
    """Q13: declared model tests (unique, not_null, accepted_values/range, relationships)."""
    t = Tables(spark, sf_dir)
    stg_p, stg_e = gold.stg_patients(t.silver("patients")), gold.stg_encounters(t.silver("encounters"))
    int_pe = t.int_table()
    return quality.declared_model_tests(stg_p, stg_e, int_pe, gold.mart_daily_census(int_pe, ordered=False))


@register("patient_expectations", V(QO.EXPECTATIONS, "patients"))
def patient_expectations(spark, sf_dir):
    """Q14: the patient expectation suite with ``mostly`` tolerances."""
    return quality.expect(Tables(spark, sf_dir).silver("patients"), quality.PATIENT_EXPECTATIONS, "patients") \
        .withColumn("idx", F.col("idx").cast("int"))


_MISSING = [quality.Expectation("column_to_exist", "no_such_column"), quality.Expectation("not_null", "no_such_column", 0.5),
            quality.Expectation("unique", "no_such_column"), quality.Expectation("between", "no_such_column", low=0, high=1),
            quality.Expectation("column_to_exist", "mrn"), quality.Expectation("not_null", "mrn", 0.99)]


@register("expectations_missing_column", V(
    "SELECT 'patients' AS suite, * FROM (VALUES (0, 'column_to_exist', 'no_such_column', 1::BIGINT, 1::BIGINT, FALSE), "
    "(1, 'not_null', 'no_such_column', 1, 1, FALSE), (2, 'unique', 'no_such_column', 1, 1, FALSE), "
    "(3, 'between', 'no_such_column', 1, 1, FALSE), (4, 'column_to_exist', 'mrn', 0, 1, TRUE)) "
    "AS v(idx, expectation, \"column\", unexpected, element_count, success) UNION ALL "
    "SELECT 'patients', 5, 'not_null', 'mrn', count(*) FILTER (mrn IS NULL), count(*), "
    "count(*) FILTER (mrn IS NULL) <= 0.01 * count(*) FROM patients", "patients"))
def expectations_missing_column(spark, sf_dir):
    """Q14: expectations on an absent column fail as rows instead of raising."""
    return quality.expect(Tables(spark, sf_dir).silver("patients"), _MISSING, "patients") \
        .withColumn("idx", F.col("idx").cast("int"))


# -------------------------------------------------------- scalar functions --

_TEXT = ("CASE encounter_id % 3 WHEN 0 THEN replace(CAST(admit_datetime AS VARCHAR), ' ', 'T') || 'Z' "
         "WHEN 1 THEN CAST(admit_datetime AS VARCHAR) || '+02:00' ELSE 'not-a-date' END")


@register("scalar_functions", V(f"""SELECT encounter_id,
  md5(concat_ws('|', coalesce(CAST(encounter_id AS VARCHAR), '_null_'), coalesce(CAST(patient_id AS VARCHAR), '_null_'),
      coalesce(drg_code, '_null_'))) AS surrogate_key,
  date_diff('hour', date_trunc('hour', admit_datetime), date_trunc('hour', discharge_datetime)) AS boundary_hours,
  '{C.PHI_MASK}' AS masked,
  CASE WHEN los_days IS NOT NULL THEN printf('%.2f%%', {O.rnd('los_days / 100 * 100', 2)}) END AS los_pct_text,
  TRY_CAST(regexp_replace({_TEXT}, '(Z|[+-]\\d{{2}}:?\\d{{2}})$', '') AS TIMESTAMP) AS parsed_admit,
  CAST(admit_datetime AS DATE) AS admit_date,
  upper(encounter_type) AS encounter_type_upper
FROM encounters""", "encounters"))
def scalar_functions(spark, sf_dir):
    """H1, H3, H13, H21, H22, H23, H30 on the silver encounters."""
    from ..operators.quality import lenient_timestamp
    from pyspark.sql.types import StringType
    e = Tables(spark, sf_dir).silver("encounters")
    k = F.col("encounter_id") % 3
    text = (F.when(k == 0, F.concat(F.regexp_replace(F.col("admit_datetime").cast("string"), " ", "T"), F.lit("Z")))
             .when(k == 1, F.concat(F.col("admit_datetime").cast("string"), F.lit("+02:00")))
             .otherwise(F.lit("not-a-date")))
    return e.select(
        "encounter_id",
        H.surrogate_key("encounter_id", "patient_id", "drg_code").alias("surrogate_key"),
        H.date_diff_hours("admit_datetime", "discharge_datetime").alias("boundary_hours"),
        H.mask_phi().alias("masked"),
        H.format_pct(F.col("los_days") / 100).alias("los_pct_text"),
        lenient_timestamp(text, StringType()).alias("parsed_admit"),
        H.calendar_date("admit_datetime").alias("admit_date"),
        F.upper("encounter_type").alias("encounter_type_upper"))


@register("sql_macros", _doubles_sql(V(f"""SELECT encounter_id,
  {O.age_group('age_years')} AS age_group_m,
  {O.los_risk('los_days')} AS los_risk_m,
  {O.risk_score('los_days', 'critical_lab_count', 'abnormal_lab_count')} AS risk_m,
  {O.collection_rate('total_paid', 'total_charges')} AS collection_m,
  date_diff('hour', date_trunc('hour', admit_datetime), date_trunc('hour', discharge_datetime)) AS hours_m,
  '{C.PHI_MASK}' AS zip_masked,
  md5(concat_ws('|', CAST(encounter_id AS VARCHAR), CAST(patient_id AS VARCHAR), coalesce(icd10_code, '_null_'))) AS sk,
  CASE WHEN CASE WHEN critical_lab_count > 0 THEN 'HH' ELSE 'N' END IN ('HH', 'LL') THEN TRUE ELSE FALSE END AS critical_m
FROM int_patient_encounters""", "int_patient_encounters"), ["collection_m"]))
def sql_macros(spark, sf_dir):
    """The eight macros as SQL functions, called from Spark SQL; the session's own functions and views stay as they are."""
    own = f"m{uuid.uuid4().hex[:12]}_"
    names = register_sql_macros(spark, own)
    Tables(spark, sf_dir).int_patient_encounters().createOrReplaceTempView(f"{own}encounters")
    try:
        return stable(spark.sql(f"""SELECT encounter_id,
      {own}age_group(age_years) AS age_group_m, {own}los_risk(los_days) AS los_risk_m,
      {own}encounter_risk_score(los_days, critical_lab_count, abnormal_lab_count) AS risk_m,
      {own}collection_rate(total_paid, total_charges) AS collection_m,
      {own}date_diff_hours(admit_datetime, discharge_datetime) AS hours_m,
      {own}mask_phi(zip_code) AS zip_masked,
      {own}generate_surrogate_key(CAST(encounter_id AS STRING), CAST(patient_id AS STRING), icd10_code) AS sk,
      {own}is_critical_lab(CASE WHEN critical_lab_count > 0 THEN 'HH' ELSE 'N' END) AS critical_m
    FROM {own}encounters"""))
    finally:
        drop_sql_macros(spark, names)
        spark.catalog.dropTempView(f"{own}encounters")


@register("fhir_observations", _doubles_sql(V("""SELECT lab_result_id, loinc_code,
  CAST(patient_id AS VARCHAR) AS patient_ref, CAST(encounter_id AS VARCHAR) AS encounter_ref,
  result_value, result_unit, abnormal_flag, collected_datetime FROM labs""", "labs"), ["result_value"]))
def fhir_observations(spark, sf_dir):
    """Lab rows -> Observation JSON -> parsed back."""
    labs = Tables(spark, sf_dir).silver("labs")
    res = labs.select(observation_resource(labs).alias("resource"))
    out = parse_observations(res)
    return stable(out.withColumn("encounter_ref", F.when(F.col("encounter_ref") != "", F.col("encounter_ref"))))


# --------------------------------------------------------- A5/A6/A8 load --

@register("load_format_icu", V("""SELECT CAST(vital_id AS BIGINT) AS vital_id, patient_id, encounter_id, bed_id, icu_unit,
  coalesce(CAST("timestamp" AS VARCHAR), '') AS "timestamp",
  CAST(heart_rate AS VARCHAR) AS hr_text, CAST(alert_triggered AS INTEGER) AS alert_triggered,
  coalesce(alert_type, '') AS alert_type, coalesce(vitals_status, '') AS vitals_status,
  coalesce(CAST(transformed_at AS VARCHAR), '') AS transformed_at FROM icu_vitals""", "icu_vitals"))
def load_format_icu(spark, sf_dir):
    """A5 + A6: load formatting (times to text, booleans to 0/1, NULL text blank)."""
    icu = Tables(spark, sf_dir).silver("icu_vitals")
    out = load_format(icu, blank=True)
    return out.select("vital_id", "patient_id", "encounter_id", "bed_id", "icu_unit", "timestamp",
                      F.col("heart_rate").cast("string").alias("hr_text"), "alert_triggered", "alert_type",
                      "vitals_status", "transformed_at")


@register("conformed_raw_labs", _doubles_sql(V("""SELECT CAST(lab_result_id AS VARCHAR) AS lab_result_id,
  CAST(patient_id AS VARCHAR) AS patient_id, CAST(encounter_id AS VARCHAR) AS encounter_id, loinc_code, test_name,
  result_value, result_unit, abnormal_flag, result_category, CAST(is_critical AS INTEGER) AS is_critical, tat_hours,
  CAST(collected_datetime AS VARCHAR) AS collected_datetime, CAST(resulted_datetime AS VARCHAR) AS resulted_datetime,
  ordering_physician_id, lab_id, source_system, data_layer FROM labs""", "labs"), ["result_value", "tat_hours"]))
def conformed_raw_labs(spark, sf_dir):
    """Silver labs conformed to the declared warehouse schema."""
    return stable(conform(Tables(spark, sf_dir).silver("labs"), TARGETS["raw_labs"]))
