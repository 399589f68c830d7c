"""End-to-end batch run on sf0.001."""
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clinspark.operators import quality, silver
from clinspark.plans import batch, catalog_more
from clinspark.plans.batch import RunConfig, run
from clinspark.schemas import TARGETS
from clinspark.session import SHUFFLES_FREED, shuffles_freed
from clinspark.sources import testdata
from clinspark.sources.progress import Progress

SF = "/root/testdata/sf0.001"


def test_full_run_and_run_log(spark, tmp_dir):
    res = run(spark, RunConfig(SF, tmp_dir, mode="full", run_id="r1"))
    assert res.status == "SUCCESS" and res.gate_passed and res.overall_score >= 0.95
    assert set(res.loaded) > {f"raw_{n}" for n in res.staged} and res.loaded["raw_labs"] == 6000
    raw = spark.read.parquet(res.paths["raw_labs"])
    assert raw.schema == TARGETS["raw_labs"] and raw.count() == 6000
    runs = spark.read.parquet(os.path.join(tmp_dir, "pipeline_runs"))
    assert [r.status for r in runs.collect()] == [res.status]
    assert res.records["encounters"] == 1500 and res.records["labs"] == 6000
    months = [d for d in os.listdir(res.paths["encounters"]) if d.startswith("year_month=")]
    assert len(months) > 12                          # facts partitioned by month
    census = spark.read.parquet(res.paths["mart_daily_census"])
    assert census.count() > 0
    assert spark.read.parquet(res.paths["mart_patient_encounters"]).count() == 1500
    # a re-run with the same id replaces its log row (INSERT OR REPLACE)
    res2 = run(spark, RunConfig(SF, tmp_dir, mode="validate-only", run_id="r1"))
    runs = spark.read.parquet(os.path.join(tmp_dir, "pipeline_runs")).collect()
    assert len(runs) == 1 and runs[0].status == res2.status


def test_checks_measured_by_the_writes(spark, tmp_dir):
    """The gate's checks and the statistics equal those of queries over the tables, and only key columns are read for them."""
    res = run(spark, RunConfig(SF, tmp_dir, mode="validate-only", run_id="m"))
    report = os.path.join(tmp_dir, "runs", "m", "reports")
    staged = {n: spark.read.parquet(p) for n, p in res.paths.items()}
    data = {n: staged[n] for n in quality.SUITE_ORDER}
    rows = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
    want = quality.run_checks(data, data["patients"], with_count=True)
    got = spark.read.schema(want.schema).json(os.path.join(report, "quality_checks"))
    assert rows(got) == rows(want) and got.count() > 40
    stats = {(r.table, r.metric): r.value for r in spark.read.json(os.path.join(report, "transform_stats")).collect()}
    asked = catalog_more.transform_stats(spark, SF).collect()
    assert {(r.table, r.metric): round(r.value, 6) for r in asked} == {k: round(stats[k], 6) for k in ((r.table, r.metric) for r in asked)}
    assert stats["patients", "dupes_removed"] > 0
    measured = {n: {"rows": 1} | {k: 0 for k in quality.rule_metrics(df, quality.suite_rules(n, df))} for n, df in data.items()}
    plan = quality.run_checks(data, data["patients"], measured=measured)._jdf.queryExecution().executedPlan().toString()
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert read and all(re.fullmatch(r"(patient_id:bigint|mrn:string|encounter_id:bigint)", r) for r in read), read
    assert plan.count("Scan parquet") == 5  # patients twice, encounters twice, labs once


def test_gate_failure_publishes_nothing(spark, tmp_dir):
    res = run(spark, RunConfig(SF, tmp_dir, mode="full", threshold=1.01, run_id="strict"))
    assert res.status == "QUALITY_GATE_FAILED" and res.gate_passed is False
    assert "mart_daily_census" not in res.paths and res.loaded == {} and res.staged["labs"] == 6000
    assert os.path.exists(os.path.join(tmp_dir, "runs", "strict", "reports", "quality_checks"))


def test_skip_validate_records_sla_score(spark, tmp_dir):
    res = run(spark, RunConfig(SF, tmp_dir, mode="skip-validate", run_id="skip"))
    assert res.status == "SUCCESS" and res.overall_score == 0.998 and res.gate_passed is None


def test_latest_runs(spark, tmp_dir):
    from clinspark.operators.insights import latest_runs
    rows = [(f"r{i}", f"2026-08-{i + 1:02d}T00:00:00", None, "SUCCESS", i, 1.0, 0.1, "{}") for i in range(8)]
    runs = spark.createDataFrame(rows, TARGETS["pipeline_runs"])
    assert [r.run_id for r in latest_runs(runs, 5).collect()] == ["r7", "r6", "r5", "r4", "r3"]


def test_duplicate_patient_ids_stop_before_the_mart(spark, tmp_dir, monkeypatch):
    """Fan-out guard: a second MRN for an existing patient id (the dedup keeps
    both) would multiply that patient's encounters in the mart."""
    original = testdata.SOURCES["patients"]

    def with_duplicate(s, d):
        raw = original(s, d)
        return raw.unionByName(raw.where(F.col("patient_id") == 1).withColumn("mrn", F.lit("PHI_other"))
                              .withColumn("mrn_digest", F.lit("other")))

    monkeypatch.setitem(testdata.SOURCES, "patients", with_duplicate)
    res = run(spark, RunConfig(SF, tmp_dir, mode="full", run_id="dup"))
    assert res.status == "PATIENT_ID_NOT_UNIQUE" and "mart_patient_encounters" not in res.paths


def test_command_line(spark, tmp_dir, capsys):
    import json
    from clinspark.__main__ import main
    code = main(["run", "--sf-dir", SF, "--out-dir", tmp_dir, "--mode", "validate-only", "--run-id", "cli"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["status"] == "VALIDATED" and out["run_id"] == "cli"


def _declared(spark, tmp_dir, empty=()):
    """The nine sources written as parquet files and declared with their schemas."""
    out = {}
    for name in testdata.SOURCES:
        df = testdata.bronze(spark, SF, name)
        path = os.path.join(tmp_dir, "in", name)
        (df.where("false") if name in empty else df).coalesce(1).write.parquet(path)
        out[name] = {"format": "parquet", "path": path, "schema": df.schema}
    return out


def test_declared_sources_give_the_same_run(spark, tmp_dir):
    res = run(spark, RunConfig(None, tmp_dir, sources=_declared(spark, tmp_dir), run_id="own"))
    assert res.status == "SUCCESS" and res.loaded["raw_labs"] == 6000 and res.loaded["mart_patient_encounters"] == 1500


def test_one_source_empty(spark, tmp_dir):
    res = run(spark, RunConfig(None, tmp_dir, sources=_declared(spark, tmp_dir, ["staff", "billing"]), run_id="one"))
    assert res.status == "SUCCESS" and res.loaded["raw_staff"] == 0 and res.staged["billing"] == 0
    assert spark.read.parquet(res.paths["raw_staff"]).count() == 0


def test_all_sources_empty_halt_at_the_gate(spark, tmp_dir):
    res = run(spark, RunConfig(None, tmp_dir, sources=_declared(spark, tmp_dir, testdata.SOURCES), run_id="none"))
    assert (res.status, res.overall_score, res.gate_passed, res.loaded) == ("QUALITY_GATE_FAILED", 0.0, False, {})
    # the same id with data afterwards replaces the empty staging
    again = run(spark, RunConfig(SF, tmp_dir, mode="validate-only", run_id="none"))
    assert again.status == "VALIDATED" and again.staged["labs"] == 6000


def test_undeclared_sources_are_skipped(spark, tmp_dir):
    labs = {"labs": _declared(spark, tmp_dir)["labs"]}
    res = run(spark, RunConfig(None, tmp_dir, sources=labs, threshold=0.5, run_id="labs"))
    assert res.status == "SUCCESS" and res.loaded == {"raw_labs": 6000}


def _tables(spark, res):
    return {n: sorted(map(str, spark.read.parquet(p).collect())) for n, p in res.paths.items()}


def test_a_killed_run_goes_on(spark, tmp_dir, monkeypatch):
    """After a kill behind the staging writes no source is read again, after one in the models only these are built; the end is equal."""
    given = _declared(spark, tmp_dir)
    whole = run(spark, RunConfig(None, os.path.join(tmp_dir, "a"), sources=given, run_id="r"))
    out = os.path.join(tmp_dir, "b")
    cfg = lambda: RunConfig(None, out, sources=given, run_id="r", resume=True)

    def killed(*_args, **_how):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(quality, "run_checks", killed)
        with pytest.raises(KeyboardInterrupt):
            run(spark, cfg())
    wrote = []
    original = batch.sinks.load_measured
    with monkeypatch.context() as m:
        m.setattr(batch.sinks, "load_measured", lambda df, target, *a, **k: wrote.append((target, a)) or original(df, target, *a, **k))
        m.setattr(batch.gold, "mart_daily_census", killed)
        with pytest.raises(KeyboardInterrupt):
            run(spark, cfg())
    assert wrote and not [a for _, a in wrote if "silver" in str(a)]         # loads only: nothing was staged again
    res = run(spark, cfg())
    assert {s for s in res.skipped if not s.startswith("load-")} == {f"silver-{n}" for n in given} | {"by_encounter", "mart", "int"}
    assert (res.status, res.loaded, res.records, res.overall_score) == (whole.status, whole.loaded, whole.records, whole.overall_score)
    assert _tables(spark, res) == _tables(spark, whole)
    # a source with one more file is read again, and what follows from it; the others are not
    spark.read.schema(given["labs"]["schema"]).parquet(given["labs"]["path"]).limit(5).withColumn(
        "lab_result_id", F.concat(F.lit("again-"), "lab_result_id")).write.mode("append").parquet(given["labs"]["path"])
    more = run(spark, cfg())
    assert more.staged["labs"] == 6005 and more.loaded["raw_labs"] == 6005
    assert set(more.skipped) == {f"{k}-{n}" for n in given if n != "labs" for k in ("silver",)} | {
        f"load-raw_{n}" for n in given if n != "labs"}
    # without resume every step is done
    assert run(spark, RunConfig(None, out, sources=given, run_id="r", mode="validate-only")).skipped == []


def test_a_step_broken_off_is_done_anew(spark, tmp_dir):
    """A note of an earlier run does not outlive the start of its step."""
    work = iter([{"n": 1}, None, {"n": 3}])

    def do():
        got = next(work)
        if got is None:
            raise RuntimeError("killed")
        return got

    assert Progress(spark, tmp_dir).step("s", "x", do) == {"n": 1}
    with pytest.raises(RuntimeError):
        Progress(spark, tmp_dir).step("s", "x", do)
    again = Progress(spark, tmp_dir, resume=True)
    assert again.step("s", "x", do) == {"n": 3} and again.skipped == []
    assert again.step("s", "x", do) == {"n": 3} and again.skipped == ["s"]


def test_tables_in_the_catalog(spark, tmp_dir):
    """The tables of a successful run get their names; a failed one changes nothing, the next successful one replaces all."""
    db = f"clinic_{os.path.basename(tmp_dir).replace('-', '_').lower()}"
    run(spark, RunConfig(SF, tmp_dir, mode="full", run_id="one", database=db))
    names = {t.name for t in spark.catalog.listTables(db) if t.namespace}
    assert names == {f"raw_{n}" for n in testdata.SOURCES} | {"mart_patient_encounters", "int_patient_encounters", "mart_daily_census"}
    assert spark.table(f"{db}.raw_labs").count() == 6000 and spark.table(f"{db}.raw_labs").schema == TARGETS["raw_labs"]
    declared = _declared(spark, tmp_dir, ["staff"])
    run(spark, RunConfig(None, tmp_dir, sources=declared, threshold=1.01, run_id="bad", database=db))
    assert spark.table(f"{db}.raw_staff").count() > 0
    run(spark, RunConfig(None, tmp_dir, sources=declared, run_id="two", database=db))
    assert spark.table(f"{db}.raw_staff").count() == 0 and spark.table(f"{db}.mart_patient_encounters").count() == 1500
    spark.sql(f"DROP DATABASE {db} CASCADE")


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are not in ``before``; they are removed behind the query, so a moment is given."""
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_shuffle_files_go_with_their_queries(spark, tmp_dir):
    """A run leaves no shuffle file behind, also when the driver collects no garbage; the caller's setting stays."""
    for given in (None, "false", "true"):
        spark.conf.unset(SHUFFLES_FREED) if given is None else spark.conf.set(SHUFFLES_FREED, given)
        kept = spark.conf.get(SHUFFLES_FREED)
        with pytest.raises(ZeroDivisionError):
            with shuffles_freed(spark):
                assert spark.conf.get(SHUFFLES_FREED) == "true"
                raise ZeroDivisionError
        assert spark.conf.get(SHUFFLES_FREED) == kept
    spark.conf.unset(SHUFFLES_FREED)
    before = _shuffle_files(spark)
    res = run(spark, RunConfig(SF, tmp_dir, run_id="files"))
    assert res.status == "SUCCESS" and not _left(spark, before)
    assert spark.conf.get(SHUFFLES_FREED) == "false"


def test_loads_come_behind_the_models(spark, tmp_dir, monkeypatch):
    """No loaded table lies on the disk beside the models' shuffles; what was loaded and noted is as before."""
    steps, original = [], Progress.step
    monkeypatch.setattr(Progress, "step", lambda self, name, *a: steps.append(name) or original(self, name, *a))
    res = run(spark, RunConfig(SF, tmp_dir, run_id="order"))
    loads = {f"load-raw_{n}" for n in testdata.SOURCES}
    assert res.status == "SUCCESS" and set(steps[-len(loads):]) == loads and "census" in steps[:-len(loads)]
    assert [*res.loaded] == [*batch.LOAD_TABLES.values(), "mart_patient_encounters"]


def test_tables_of_a_run_are_written_small(spark, tmp_dir):
    """Staged tables, buckets and models: zstd, and differences where ids do not repeat."""
    res = run(spark, RunConfig(SF, tmp_dir, run_id="small"))
    top = os.path.join(tmp_dir, "runs", "small")
    codecs, ids = set(), set()
    for folder in [*(res.paths[n] for n in testdata.SOURCES), os.path.join(top, "by_encounter"), res.paths["int_patient_encounters"],
                   res.paths["mart_daily_census"]]:
        for at, _, names in os.walk(folder):
            for meta in (pq.ParquetFile(os.path.join(at, n)).metadata for n in names if n.endswith(".parquet")):
                columns = [meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns)]
                codecs |= {c.compression for c in columns}
                ids |= {e for c in columns if c.path_in_schema in ("lab_result_id", "claim_id", "study_id") for e in c.encodings}
    assert codecs == {"ZSTD"} and "DELTA_BYTE_ARRAY" in ids
    want = silver.to_silver("labs", testdata.bronze(spark, SF, "labs"))
    got = spark.read.parquet(res.paths["labs"])
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
