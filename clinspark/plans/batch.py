"""P5: one batch run - bronze -> silver -> quality gate -> gold -> models -> run log.

Write-audit-publish instead of load-after-check: silver tables are written
once to the run's staging folder, and these writes also measure the row-local
quality rules and the transform statistics (D12). The suite then reads only the key
columns of the staged tables, and only a passed gate builds the models and loads the
nine source tables in their declared schemas (A4, A8). A failed gate
leaves nothing loaded (Q10); ``staged`` and ``loaded`` are counted apart. Every
write goes to shared storage, so a lost executor only re-runs its tasks.

Sources are the views over the input tables, or any declared by format
(``RunConfig.sources``: name -> spec of ``sources.readers``). A source that is not
declared is skipped; one without rows is staged empty, not checked and loaded
empty. The mart and the models need patients, encounters, labs and billing.

The models are built from staged tables in buckets of the encounter (``operators.staged``), so facts are shuffled
once however many models read them. A query's shuffle files go when it ends, and loading, which
shuffles nothing, comes last, so the disk holds little beside the run's tables. With ``database`` the loaded tables
and the models of a successful run get their names in that database of the catalog.

Every step (a source's staging, a load, a model) is noted when done. A run that was killed goes on with ``resume`` and
its run id: a source whose files and declaration are unchanged is not read again, nor is what was
built from such sources only. The gate is always decided anew, on what the staging writes measured and the staged keys.

Modes: ``full`` (everything), ``validate-only`` (stops after the gate - the
source did not stop), ``skip-validate`` (no checks; the run records the SLA
quality figure as the source did). A passed gate with duplicate patient ids
still stops before the mart (status PATIENT_ID_NOT_UNIQUE): the patient join
would multiply encounters. A run whose models fail a declared test ends as
MODEL_TESTS_FAILED.
"""
from __future__ import annotations

import datetime as _dt
import json
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import gold, quality, silver
from ..operators import staged as by_encounter
from ..schemas import TARGETS
from ..session import cut_lineage, shuffles_freed
from ..sources import sinks, testdata
from ..sources.progress import Progress, combined, input_files
from ..sources.readers import read_source


@dataclass
class RunConfig:
    sf_dir: str | None
    out_dir: str
    mode: str = "full"
    sources: dict[str, dict] | None = None
    threshold: float = C.QUALITY_THRESHOLD
    as_of: _dt.datetime = C.AS_OF
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:8])
    resume: bool = False
    database: str | None = None


@dataclass
class RunResult:
    run_id: str
    status: str
    overall_score: float | None
    gate_passed: bool | None
    records: dict
    staged: dict
    loaded: dict
    duration_minutes: float
    paths: dict
    phases: dict = field(default_factory=dict)
    skipped: list = field(default_factory=list)  # steps that an earlier run of this id had done


# Facts written partitioned by month (partition pruning for date-bounded
# reads), range-clustered on (month, key) so files stay few and large.
PARTITIONS = {"encounters": (["year_month"], ["encounter_id"])}

MODEL_SOURCES = ("patients", "encounters", "labs", "billing")

LOAD_TABLES = {  # silver source -> warehouse table
    "patients": "raw_patients", "encounters": "raw_encounters", "labs": "raw_labs", "billing": "raw_billing",
    "appointments": "raw_appointments", "medications": "raw_medications", "radiology": "raw_radiology",
    "icu_vitals": "raw_icu_vitals", "staff": "raw_staff",
}


def source_metrics(df: DataFrame, run_id: str) -> DataFrame:
    """Q12: per-source metrics (records, seconds, rows/s) of (source, records, seconds) rows."""
    return df.select(F.lit(run_id).alias("run_id"), "source", "records", "seconds",
                     F.round(F.col("records") / F.greatest(F.col("seconds"), F.lit(0.001)), 0).alias("rows_per_sec"))


def _concurrently(tasks: dict, workers: int = 8) -> dict:
    """Run independent Spark actions as concurrent jobs (the scheduler
    interleaves their tasks); returns {name: result}. Only job submission
    happens here - no data passes through the driver."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(tasks)))) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    with shuffles_freed(spark):
        return _run(spark, cfg)


def _run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    started = time.time()
    started_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    stage = os.path.join(cfg.out_dir, "runs", cfg.run_id)
    paths: dict[str, str] = {}
    staged_rows: dict[str, int] = {}
    loaded: dict[str, int] = {}
    names = [n for n in LOAD_TABLES if cfg.sources is None or n in cfg.sources]
    if not names:
        raise ValueError("no source is declared")
    source_rows = []
    phases: dict[str, float] = {}
    mark = [time.time()]

    def phase(name: str) -> None:
        now = time.time()
        phases[name] = round(now - mark[0], 2)
        mark[0] = now

    checked = cfg.mode != "skip-validate"
    progress = Progress(spark, os.path.join(stage, "_steps"), cfg.resume)

    # bronze -> silver, written once (A4); counts and measures come from the write itself.
    # The nine sources are independent: their writes run as concurrent jobs.
    def stage_one(name: str, table: str):
        t0 = time.time()
        raw = (testdata.bronze(spark, cfg.sf_dir, name) if cfg.sources is None
               else read_source(spark, cfg.sources[name]))
        path = os.path.join(stage, "silver", name)
        files = input_files(raw)
        given = None if cfg.sources is None else {k: str(v) for k, v in cfg.sources[name].items()}
        inputs = combined(name, given, raw.schema.json(), files, cfg.as_of.isoformat(), checked) if files is not None else None

        def write() -> dict:
            copies = "_copies" if name == "patients" else None
            df = silver.transform_patients(raw, cfg.as_of, copies) if copies else silver.to_silver(name, raw, cfg.as_of)
            part, cluster = PARTITIONS.get(name, (None, None))
            stats = {f"stat {k}": v for k, v in silver.stats_metrics(name, copies).items()}
            rules = quality.rule_metrics(df, quality.suite_rules(name, df), cfg.as_of) if checked and name in quality.SUITE_ORDER else {}
            return sinks.load_measured(df, table, "replace", path, part, cluster, stats | rules, [copies] if copies else [],
                                       sinks.TYPED_FILES)

        got = progress.step(f"silver-{name}", inputs, write)
        return path, got, time.time() - t0, inputs

    done = _concurrently({n: (lambda n=n: stage_one(n, LOAD_TABLES[n])) for n in names})
    for name in names:
        path, got, secs, _ = done[name]
        paths[name], staged_rows[name] = path, got["rows"]
        source_rows.append((name, got["rows"], secs))
    measured = {n: done[n][1] for n in names}
    prints = {n: done[n][3] for n in names}
    stats = [(n, k[5:], v) for n in names for k, v in measured[n].items() if k.startswith("stat ")]
    sinks.write_json_report(spark.createDataFrame(stats, "table string, metric string, value double"),               # D12
                            os.path.join(stage, "reports", "transform_stats"))
    phase("stage_silver")
    staged = {n: spark.read.parquet(p) for n, p in paths.items()}
    records = dict(staged_rows)

    def finish(status: str) -> RunResult:
        if cfg.database and status == "SUCCESS":
            sinks.publish(spark, cfg.database, {os.path.basename(p): p for n, p in paths.items() if n not in names},
                          os.path.join(cfg.out_dir, "database"))
        return _finish(spark, cfg, started, started_at, status, overall_score, gate, records, staged_rows, loaded, paths,
                       source_rows, phases, progress.skipped)

    overall_score, gate = None, None
    if checked:
        data = {n: staged[n] for n in quality.SUITE_ORDER if records.get(n)}
        # one row per check: small, so written once and read by the gate and all reports
        checks = cut_lineage(quality.run_checks(data, staged.get("patients"), cfg.as_of, True, measured), "checks")
        scores = quality.score_sources(checks, cfg.threshold)
        summary = quality.overall(scores, cfg.threshold)
        report = os.path.join(stage, "reports")
        _concurrently({                                                                  # A11
            "checks": lambda: sinks.write_json_report(checks, os.path.join(report, "quality_checks")),
            "scores": lambda: sinks.write_json_report(scores, os.path.join(report, "quality_scores")),
            "records": lambda: sinks.write_json_report(quality.record_estimates(scores),
                                                       os.path.join(report, "quality_records"))})
        row = summary.first()  # one row: the gate decision is the only value the driver needs
        overall_score, gate = float(row["overall_score"]), bool(row["gate_passed"])
        # Fan-out guard: patients are unique by MRN after dedup, not by id; the
        # mart's patient join must not multiply encounters (one row).
        dup = checks.where((F.col("source") == "patients") & (F.col("check") == "unique::patient_id")).first()
        fanout = dup is not None and dup["violations"] > 0
        phase("quality_gate")
        if fanout and gate and cfg.mode != "validate-only":
            return finish("PATIENT_ID_NOT_UNIQUE")
        if not gate:  # Q10: halt before anything is published
            return finish("QUALITY_GATE_FAILED")
        if cfg.mode == "validate-only":
            return finish("VALIDATED")
    else:
        overall_score = C.SLA_QUALITY

    # the source tables in their declared schemas (A4, A8), only now that the gate has passed
    raw_paths = {LOAD_TABLES[n]: os.path.join(stage, "raw", LOAD_TABLES[n]) for n in names}

    def load_one(n: str, t: str) -> int:
        write = lambda: {"rows": sinks.load(staged[n], t, "replace", schema=TARGETS[t], path=raw_paths[t])}
        return progress.step(f"load-{t}", prints[n], write)["rows"]

    def load_all(mart: dict) -> None:
        loaded.update(_concurrently({t: (lambda n=n, t=t: load_one(n, t)) for n, t in LOAD_TABLES.items() if n in names}) | mart)
        paths.update(raw_paths)
        phase("load")

    if not all(n in staged for n in MODEL_SOURCES):
        load_all({})
        return finish("SUCCESS")

    # gold mart and models (A10) from tables staged by encounter, which all models share; mart and the
    # intermediate model are independent, the census reads the written model
    known = [prints[n] for n in MODEL_SOURCES]
    models = combined("models", known) if all(known) else None
    at = {n: os.path.join(stage, layer, n) for n, layer in (("mart_patient_encounters", "marts"), ("mart_daily_census", "marts"),
                                                            ("int_patient_encounters", "intermediate"))}
    by_key = os.path.join(stage, "by_encounter")

    def stage_facts() -> dict:
        by_encounter.stage(*(staged[n] for n in MODEL_SOURCES), by_key)
        return {}

    progress.step("by_encounter", models, stage_facts)
    facts = by_encounter.open_staged(spark, by_key)
    phase("by_encounter")
    stg_p = sinks.materialize(gold.stg_patients(staged["patients"], cfg.as_of, cfg.run_id), "stg_patients",
                              "STAGING", as_view=True)
    stg_e = sinks.materialize(gold.stg_encounters(staged["encounters"], cfg.as_of), "stg_encounters",
                              "STAGING", as_view=True)

    def build_mart() -> dict:
        return {"rows": sinks.load(by_encounter.patient_encounter_mart(facts, cfg.as_of), "mart_patient_encounters", "replace",
                                   schema=TARGETS["mart_patient_encounters"], path=at["mart_patient_encounters"])}

    def build_int() -> dict:
        sinks.materialize(by_encounter.int_patient_encounters(facts, cfg.as_of), "int_patient_encounters", "INTERMEDIATE", path=stage)
        return {}

    built = _concurrently({"mart": lambda: progress.step("mart", models, build_mart), "int": lambda: progress.step("int", models, build_int)})
    int_pe = spark.read.parquet(at["int_patient_encounters"])
    phase("mart_and_int")

    def build_census() -> dict:
        sinks.materialize(gold.mart_daily_census(int_pe, cfg.as_of), "mart_daily_census", "MARTS", path=stage)
        return {}

    progress.step("census", models, build_census)
    census = spark.read.parquet(at["mart_daily_census"])
    phase("census")
    paths.update(at)
    tests = cut_lineage(quality.declared_model_tests(stg_p, stg_e, int_pe, census), "model_tests")  # Q13
    sinks.write_json_report(tests, os.path.join(stage, "reports", "model_tests"))
    failed = tests.where("failures > 0").count()  # one row per declared test
    phase("model_tests")
    # loading shuffles nothing: last, it does not lie beside the shuffles of the models
    load_all({"mart_patient_encounters": built["mart"]["rows"]})
    return finish("MODEL_TESTS_FAILED" if failed else "SUCCESS")


def _finish(spark, cfg, started, started_at, status, score, gate, records, staged, loaded, paths, source_rows,
            phases=None, skipped=()) -> RunResult:
    minutes = (time.time() - started) / 60
    metrics = {"run_id": cfg.run_id, "mode": cfg.mode, "records": records, "staged": staged, "loaded": loaded,
               "quality_score": score, "gate_passed": gate, "sla_target_minutes": C.SLA_MINUTES,
               "sla_met": minutes <= C.SLA_MINUTES, "paths": paths, "phase_seconds": phases or {}, "skipped_steps": sorted(skipped)}
    run_row = spark.createDataFrame(
        [(cfg.run_id, started_at.isoformat(), _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(),
          status, int(sum(records.values())), float(score) if score is not None else None, round(minutes, 2),
          json.dumps(metrics))],
        TARGETS["pipeline_runs"])
    sinks.upsert_by_key(spark, run_row, os.path.join(cfg.out_dir, "pipeline_runs"), ["run_id"])   # A9
    timed = spark.createDataFrame(source_rows, "source string, records long, seconds double")
    sinks.write_json_report(source_metrics(timed, cfg.run_id),
                            os.path.join(cfg.out_dir, "runs", cfg.run_id, "reports", "source_metrics"))
    # The run's summary and the rows of each table that it loaded
    reports = os.path.join(cfg.out_dir, "runs", cfg.run_id, "reports")
    sinks.write_json_report(run_row, os.path.join(reports, "run_summary"))
    counts = spark.createDataFrame(sorted(loaded.items()), "table_name string, row_count long")
    sinks.write_json_report(counts, os.path.join(reports, "table_counts"))
    return RunResult(cfg.run_id, status, score, gate, records, staged, loaded, round(minutes, 2), paths, phases or {}, sorted(skipped))
