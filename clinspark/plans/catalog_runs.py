"""Registered queries that write and read back: sources, run log, batch run, streams; and single rules."""
from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from ..functions import clinical as H
from ..functions import fhir
from ..operators import insights, silver, staged
from ..operators.windows import numbered
from ..schemas import TARGETS
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from ..sources import testdata as T
from ..sources.readers import read_source
from ..sources.versions import merge_by_key
from . import oracle as O
from .batch import RunConfig, run, source_metrics as metrics_of
from .catalog import _INT_DOUBLES, _MART_SQL, _RAW_DOUBLES, Tables, _doubles_sql, register, stable

V = O.with_views


def _folder(spark, name: str) -> str:
    """A new folder on the storage that all executors share."""
    return os.path.join(ensure_checkpoint_dir(spark), "queries", f"{name}-{uuid.uuid4().hex[:12]}")


def _files(sf_dir: str, table: str) -> str:
    """A pattern for the table's files, as a stream reads folders or patterns; the table may be one file."""
    return os.path.join(sf_dir, f"{table}.parque[t]")


# ------------------------------------------------------------------ rules --

@register("dose_tokens", f"SELECT p_partkey, p_name, {O.dose('p_name')} AS dose FROM part")
def dose_tokens(spark, sf_dir):
    """The last word of a name with several."""
    return T.read_table(spark, sf_dir, "part").select("p_partkey", "p_name", H.dose_from_name("p_name").alias("dose"))


@register("licence_rules", V("SELECT role, role IN ('PHYSICIAN', 'RN', 'PHARMACIST') AS required, license_type, "
                             "count(*) AS staff FROM raw_staff GROUP BY ALL", "raw_staff"))
def licence_rules(spark, sf_dir):
    """Licences by role, the role following from the supplier's region."""
    staff = T.bronze(spark, sf_dir, "staff")
    return staff.groupBy("role", H.licence_required("role").alias("required"), "license_type").agg(F.count(F.lit(1)).alias("staff"))


@register("turnaround_hours", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
          "CAST(round(CAST(date_diff('microsecond', o_orderdate, l_shipdate) / 3600000000.0 AS DECIMAL(38,9)), 2) AS DOUBLE) AS hours "
          "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def turnaround_hours(spark, sf_dir):
    """Hours from order to shipping, negatives kept."""
    li, o = T.read_table(spark, sf_dir, "lineitem"), T.read_table(spark, sf_dir, "orders")
    both = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       H.elapsed_hours(F.col("o_orderdate"), F.col("l_shipdate")).alias("hours"))


@register("row_ids", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'LINE-' || md5("
          + " || ".join(f"length({c}) || ':' || {c}" for c in (f"CAST({k} AS VARCHAR)" for k in (
              "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))) + " || '-') AS row_id FROM lineitem")
def row_ids(spark, sf_dir):
    """Ids from key columns with their lengths, a NULL column included."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return T.read_table(spark, sf_dir, "lineitem").select(
        *keys, H.row_id("LINE", *keys, F.lit(None).cast("string")).alias("row_id"))


@register("fhir_patients", V("SELECT CAST(patient_id AS VARCHAR) AS patient_ref, mrn, gender, dob, zip_code FROM patients", "patients"))
def fhir_patients(spark, sf_dir):
    """Patients -> Patient JSON -> parsed back."""
    p = Tables(spark, sf_dir).silver("patients")
    return fhir.parse_patients(p.select(fhir.patient_resource(p).alias("resource")))


@register("fhir_encounters", V("SELECT CAST(encounter_id AS VARCHAR) AS encounter_ref, CAST(patient_id AS VARCHAR) AS patient_ref, "
                               "upper(encounter_type) AS encounter_type, admit_datetime, discharge_datetime FROM encounters", "encounters"))
def fhir_encounters(spark, sf_dir):
    """Encounters -> Encounter JSON -> parsed back."""
    e = Tables(spark, sf_dir).silver("encounters")
    return fhir.parse_encounters(e.select(fhir.encounter_resource(e).alias("resource")))


# ---------------------------------------------------------------- sources --

_CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("source_json", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def source_json(spark, sf_dir):
    """A2, A3: orders as one JSON record per customer with an array, read with a declared schema and flattened."""
    path = _folder(spark, "json")
    o = T.read_table(spark, sf_dir, "orders").select("o_custkey", F.struct("o_custkey", "o_orderkey", "o_totalprice").alias("entry"))
    # a record holds at most 1,000 orders, however many a customer has
    part = F.expr("_pos div 1000")
    (numbered(o, ["o_custkey"], "orders").groupBy("o_custkey", part.alias("part")).agg(F.collect_list("entry").alias("entry"))
      .select("entry").write.json(path))
    spec = {"format": "json", "path": path, "explode": "entry",
            "schema": "entry array<struct<o_custkey: long, o_orderkey: long, o_totalprice: double>>"}
    return read_source(spark, spec).where("_corrupt_record IS NULL").select("o_custkey", "o_orderkey", "o_totalprice")


@register("source_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def source_csv(spark, sf_dir):
    """A3: customers through CSV files with a header and a declared schema."""
    path = _folder(spark, "csv")
    cols = [c.split()[0] for c in _CUSTOMER.split(", ")]
    T.read_table(spark, sf_dir, "customer").select(*cols).write.option("header", True).csv(path)
    return read_source(spark, {"format": "csv", "path": path, "schema": _CUSTOMER}).select(*cols)


@register("source_table", "SELECT s_suppkey, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def source_table(spark, sf_dir):
    """A2: suppliers from a name in the session's catalog, cast to the declared schema."""
    name = f"clinspark_supplier_{uuid.uuid4().hex[:12]}"
    T.read_table(spark, sf_dir, "supplier").createOrReplaceTempView(name)
    try:
        return read_source(spark, {"format": "table", "table": name, "schema": "s_suppkey long, s_nationkey long, s_acctbal double"})
    finally:
        spark.catalog.dropTempView(name)


# ------------------------------------------------------- runs and run log --

_RUN_COLUMNS = [f.name for f in TARGETS["pipeline_runs"].fields]


def _run_rows(spark, sf_dir, status: str, kept: str):
    """A run log row per market segment, made of its customers."""
    c = T.read_table(spark, sf_dir, "customer").where(kept)
    return c.groupBy(F.col("c_mktsegment").alias("run_id")).agg(
        F.concat(F.lit("2026-01-01T00:00:"), F.lpad(F.length("c_mktsegment").cast("string"), 2, "0")).alias("started_at"),
        F.lit("2026-01-02").alias("completed_at"), F.lit(status).alias("status"), F.count(F.lit(1)).cast("int").alias("total_records"),
        F.lit(1.0).alias("quality_score"), F.lit(0.5).alias("duration_minutes"),
        F.to_json(F.struct(F.max("c_custkey").alias("last"))).alias("metrics_json")).select(*_RUN_COLUMNS)


_RUN_SQL = ("SELECT c_mktsegment AS run_id, '2026-01-01T00:00:' || lpad(CAST(length(c_mktsegment) AS VARCHAR), 2, '0') AS started_at, "
            "'2026-01-02' AS completed_at, '{status}' AS status, CAST(count(*) AS INTEGER) AS total_records, 1.0::DOUBLE AS quality_score, "
            "0.5::DOUBLE AS duration_minutes, '{{\"last\":' || max(c_custkey) || '}}' AS metrics_json FROM customer WHERE {kept} GROUP BY c_mktsegment")
_LOG_SQL = (_RUN_SQL.format(status="SUCCESS", kept="c_mktsegment >= 'FURNITURE'") + " UNION ALL "
            + _RUN_SQL.format(status="RUNNING", kept="c_mktsegment < 'FURNITURE'"))


def _run_log(spark, sf_dir):
    path = _folder(spark, "runs")
    sinks.upsert_by_key(spark, _run_rows(spark, sf_dir, "RUNNING", "true"), path, ["run_id"])
    return sinks.upsert_by_key(spark, _run_rows(spark, sf_dir, "SUCCESS", "c_mktsegment >= 'FURNITURE'"), path, ["run_id"])


@register("run_log_upsert", _LOG_SQL)
def run_log_upsert(spark, sf_dir):
    """Rows of runs replaced by key, others kept; metrics as JSON."""
    return _run_log(spark, sf_dir)


@register("latest_runs", f"SELECT * FROM ({_LOG_SQL}) r ORDER BY started_at DESC, run_id LIMIT 3")
def latest_runs(spark, sf_dir):
    """the most recent rows of the run log."""
    return insights.latest_runs(_run_log(spark, sf_dir), 3)


@register("source_metrics", V(" UNION ALL ".join(
    f"SELECT 'q' AS run_id, '{n}' AS source, count(*) AS records, 2.5::DOUBLE AS seconds, "
    f"round(count(*) / 2.5) AS rows_per_sec FROM raw_{n}" for n in ("patients", "encounters", "labs")),
    "raw_patients", "raw_encounters", "raw_labs"))
def source_metrics(spark, sf_dir):
    """Q12: rows per second of each source."""
    counts = sinks.table_counts({n: T.bronze(spark, sf_dir, n) for n in ("patients", "encounters", "labs")})
    return metrics_of(counts.select(F.col("table_name").alias("source"), F.col("row_count").alias("records"),
                                    F.lit(2.5).alias("seconds")), "q")


@register("batch_run_tables", V(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {v}" for t, v in (
        ("raw_patients", "patients"), ("raw_encounters", "encounters"), ("raw_labs", "labs"), ("raw_billing", "billing"),
        ("raw_icu_vitals", "icu_vitals"), ("raw_appointments", "raw_appointments"), ("raw_medications", "raw_medications"),
        ("raw_radiology", "raw_radiology"), ("raw_staff", "raw_staff"), ("mart_patient_encounters", "encounters"),
        ("mart_daily_census", "mart_daily_census"))),
    "patients", "encounters", "labs", "billing", "icu_vitals", "raw_appointments", "raw_medications", "raw_radiology", "raw_staff",
    "mart_daily_census"))
def batch_run_tables(spark, sf_dir):
    """A whole batch run; the rows of each table that it wrote, read back."""
    res = run(spark, RunConfig(sf_dir, _folder(spark, "batch")))
    names = [*(n for n in res.loaded), "mart_daily_census"]
    return sinks.table_counts({n: spark.read.parquet(res.paths[n]) for n in names})


def _staged(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = _folder(spark, "staged")
    staged.stage(t.silver("patients"), t.silver("encounters"), t.silver("labs"), t.silver("billing"), path)
    return staged.open_staged(spark, path)


@register("patient_encounter_mart_staged", _doubles_sql(_MART_SQL, ["los_days", "encounter_hours", "total_charges", "total_paid"]))
def patient_encounter_mart_staged(spark, sf_dir):
    """The mart from staged tables in buckets of the encounter, joined without an exchange."""
    return stable(staged.patient_encounter_mart(_staged(spark, sf_dir)))


@register("int_patient_encounters_staged", _doubles_sql(V("SELECT * FROM int_patient_encounters", "int_patient_encounters"), _INT_DOUBLES))
def int_patient_encounters_staged(spark, sf_dir):
    """The intermediate model from the same staged tables."""
    return stable(staged.int_patient_encounters(_staged(spark, sf_dir)))


# ---------------------------------------------------------------- streams --

@register("stream_alert_windows", _doubles_sql(V(
    "SELECT time_bucket(INTERVAL 5 MINUTE, \"timestamp\") AS window_start, "
    "time_bucket(INTERVAL 5 MINUTE, \"timestamp\") + INTERVAL 5 MINUTE AS window_end, icu_unit, "
    "count(*) AS readings, count(*) FILTER (alert_triggered) AS alerts, avg(heart_rate) AS mean_hr FROM icu_vitals "
    "GROUP BY 1, 2, 3 HAVING window_end <= (SELECT max(\"timestamp\") FROM icu_vitals) - INTERVAL 10 MINUTE", "icu_vitals"), ["mean_hr"]))
def stream_alert_windows(spark, sf_dir):
    """The stream's closed windows, deduplicated, written by the file sink and read back."""
    from ..streaming import icu
    target = _folder(spark, "alerts")
    icu.run_alert_windows(spark, _files(sf_dir, "events"), target).awaitTermination()
    return stable(spark.read.parquet(target))


def _arrivals(spark, sf_dir, times: int = 4):
    """Monitor events as they arrive at each of ``times`` deliveries: a stretch of time, but every third event of the last day of
    a stretch comes with the next one."""
    ev = T.read_table(spark, sf_dir, "events")
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return [ev]
    width = max(1, int((last - first).total_seconds() * 1e6) // times)
    passed = lambda t: F.floor(F.timestamp_diff("MICROSECOND", H.ts_lit(first), t) / F.lit(width))
    number = F.when(F.col("event_id") % 3 == 0, passed(F.timestamp_add("DAY", F.lit(1), F.col("ts")))).otherwise(passed(F.col("ts")))
    dealt = ev.withColumn("_at", F.coalesce(F.least(number, F.lit(times - 1)), F.lit(0)))
    return [dealt.where(F.col("_at") == i).drop("_at") for i in range(times)]


_ACCOUNT_SQL = """WITH b AS (SELECT min(ts) AS first, max(ts) AS last FROM events),
e AS (SELECT ts, upper(event_type) AS icu_unit, coalesce(least(date_diff('microsecond', first, CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 DAY
        ELSE ts END) // greatest(1, date_diff('microsecond', first, last) // 4), 3), 0) AS delivery FROM events, b),
m AS (SELECT delivery, max(ts) AS top FROM e GROUP BY 1),
w AS (SELECT x.delivery, max(y.top) - INTERVAL 10 MINUTE AS mark FROM m x JOIN m y ON y.delivery < x.delivery GROUP BY 1),
r AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, icu_unit, ts IS NULL OR coalesce(ts <= mark, false) AS late
      FROM e LEFT JOIN w USING (delivery)),
c AS (SELECT window_start, icu_unit, count(*) FILTER (NOT late) AS on_time_rows, count(*) FILTER (late) AS late_rows FROM r GROUP BY 1, 2)
SELECT window_start, icu_unit, on_time_rows, late_rows,
  CASE WHEN on_time_rows > 0 AND window_start + INTERVAL 5 MINUTE <= last - INTERVAL 10 MINUTE THEN on_time_rows END AS counted_readings
FROM c, b"""


@register("stream_window_account", _ACCOUNT_SQL)
def stream_window_account(spark, sf_dir):
    """Four deliveries, some rows a day late: per window the rows on time, the readings counted, the late rows."""
    from ..streaming import icu
    source, target = _folder(spark, "arriving"), _folder(spark, "accounted")
    for delivery in _arrivals(spark, sf_dir):
        delivery.write.mode("append").parquet(source)
        icu.run_accounted_windows(spark, source, target)
    return icu.window_account(spark, target)


@register("stream_silver", _doubles_sql(V("SELECT * FROM icu_vitals", "icu_vitals"),
                                        _RAW_DOUBLES["icu_vitals"] + ["hr_rolling_avg", "map_calculated"]))
def stream_silver(spark, sf_dir):
    """The silver table after four refreshes by the stream, some readings being a day late."""
    from ..streaming import icu
    source, target = _folder(spark, "arriving"), _folder(spark, "silver")
    for delivery in _arrivals(spark, sf_dir):
        delivery.write.mode("append").parquet(source)
        icu.refresh_silver(spark, source, target, lateness=dt.timedelta(days=2), parts=8).awaitTermination()
    return stable(icu.read_silver(spark, target, 8))


@register("patients_refresh", V("SELECT * FROM patients", "patients"))
def patients_refresh(spark, sf_dir):
    """Three extracts of patients merged by key into a table, then cleaned: the silver table of a full rebuild."""
    raw, path = T.bronze(spark, sf_dir, "patients"), _folder(spark, "patients")
    extract = F.pmod(F.xxhash64("patient_id", "extracted_at"), F.lit(3))
    for i in range(3):
        table = merge_by_key(spark, raw.where(extract == i), path, ["mrn_digest"], ["extracted_at", "patient_id"], 8)
    return stable(silver.transform_patients(table))
