"""Quality rules, suites, scores, model tests and expectations."""
import datetime as dt

from pyspark.sql import functions as F

from clinspark.operators import quality as Q

PAT = "patient_id long, mrn string, gender string, dob date, age_years int, zip_code string, insurance_type string"


def patients(spark, n=500, nulls=0, dupes=0):
    rows = [(i, f"M{i}", "MALE" if i % 2 else "FEMALE", dt.date(1980, 1, 1), 40, "10000", "MEDICARE")
            for i in range(n)]
    rows = [(None if i < nulls else r[0],) + r[1:] for i, r in enumerate(rows)]
    rows += rows[:dupes]
    return spark.createDataFrame(rows, PAT)


def result(df, rules):
    return {r.check: r for r in Q.validate(df, rules, "patients").collect()}


def test_not_null_passes_and_fails(spark):
    assert result(patients(spark), [Q.NotNull("patient_id")])["not_null::patient_id"].passed
    r = result(patients(spark, nulls=51), [Q.NotNull("patient_id")])["not_null::patient_id"]
    assert not r.passed and r.violations == 51 and r.total == 500


def test_unique_counts_beyond_first(spark):
    assert result(patients(spark), [Q.Unique("patient_id")])["unique::patient_id"].passed
    r = result(patients(spark, dupes=10), [Q.Unique("patient_id")])["unique::patient_id"]
    assert not r.passed and r.violations == 10
    # NULLs count as one value: 3 NULLs -> 2 duplicates
    r = result(patients(spark, nulls=3), [Q.Unique("patient_id")])["unique::patient_id"]
    assert r.violations == 2


def test_in_set_null_handling_and_samples(spark):
    df = spark.createDataFrame([("N",), (None,), ("None",), ("X",), ("Y",), ("X",)], "f string")
    lab_rule = Q.InSet("f", ["N", "H", None, "None"])
    r = {x.check: x for x in Q.validate(df, [lab_rule]).collect()}["in_set::f"]
    assert r.violations == 3
    strict = Q.InSet("f", ["N"])
    assert {x.check: x for x in Q.validate(df, [strict]).collect()}["in_set::f"].violations == 5
    samples = [r.value for r in Q.invalid_samples(df, strict).collect()]
    assert samples == [None, "None", "X"]


def test_range_over_non_null(spark):
    df = spark.createDataFrame([(v,) for v in [None, -1.0, 0.0, 130.0, 131.0, 50.0]], "age double")
    r = {x.check: x for x in Q.validate(df, [Q.Between("age", 0, 130)]).collect()}["range::age[0,130]"]
    assert r.violations == 2 and r.total == 5 and not r.passed


def test_date_range_parse_old_future(spark):
    df = spark.createDataFrame([("2024-01-01",), ("bad",), ("1999-12-31",), ("2027-01-01",), ("2026-08-01T10:00:00Z",),
                                (None,)], "d string")
    r = {x.check: x for x in Q.validate(df, [Q.DateBetween("d")], as_of=dt.datetime(2026, 9, 1)).collect()}
    assert r["date_range::d"].violations == 4   # bad, old, future (> as_of + 90 days), NULL
    r2 = {x.check: x for x in Q.validate(df, [Q.DateBetween("d", high="2030-01-01")]).collect()}
    assert r2["date_range::d"].violations == 3  # a given max date replaces the 90-day rule


def test_foreign_key_orphans_and_nulls(spark):
    parents = spark.createDataFrame([(1,), (2,)], "patient_id long")
    kids = spark.createDataFrame([(1,), (1,), (3,), (None,)], "patient_id long")
    r = {x.check: x for x in Q.validate(kids, [Q.ForeignKey("patient_id", parents, "patient_id")]).collect()}
    assert r["referential_integrity::patient_id"].violations == 1 and r["referential_integrity::patient_id"].total == 3
    strict = Q.ForeignKey("patient_id", parents, "patient_id", allow_null=False)
    r = {x.check: x for x in Q.validate(kids, [strict]).collect()}
    assert r["referential_integrity::patient_id"].violations == 2 and r["referential_integrity::patient_id"].total == 4


def test_suite_scores_and_gate(spark):
    df = patients(spark)
    checks = Q.run_checks({"patients": df})
    scores = Q.score_sources(checks).collect()
    assert scores[0].checks_total == 9 and scores[0].score == 1.0 and scores[0].gate_passed
    bad = patients(spark, nulls=60, dupes=5)
    s = Q.score_sources(Q.run_checks({"patients": bad})).collect()[0]
    # NULL ids (65 of 505), repeated ids and repeated MRNs: three checks fail
    assert s.checks_passed == 6 and s.score == 6 / 9 and not s.gate_passed
    o = Q.overall(Q.score_sources(Q.run_checks({"patients": df})).unionByName(
        Q.score_sources(Q.run_checks({"patients": bad})))).first()
    assert abs(o.overall_score - (1 + 6 / 9) / 2) < 1e-12 and not o.gate_passed


def test_record_estimates(spark):
    scores = spark.createDataFrame([("a", 100, 0.875, False), ("b", 10, 1.0, True)],
                                   "source string, record_count long, score double, gate_passed boolean")
    r = {x.source: x for x in Q.record_estimates(scores).collect()}
    assert (r["a"].passed_records, r["a"].failed_records) == (87, 12)
    assert (r["b"].passed_records, r["b"].failed_records) == (10, 0)


def test_model_tests_semantics(spark):
    df = spark.createDataFrame([(1, "A", 5.0), (1, "B", None), (None, None, 400.0), (2, "A", -1.0)],
                               "k long, v string, x double")
    ref = spark.createDataFrame([(1,)], "k long")
    got = {r.test: r.failures for r in [
        Q.model_test(df, "m", "unique", "k").first(), Q.model_test(df, "m", "not_null", "k").first()]}
    assert got == {"unique": 1, "not_null": 1}
    assert Q.model_test(df, "m", "accepted_values", "v", ["A"]).first().failures == 1   # NULL passes
    assert Q.model_test(df, "m", "accepted_range", "x", low=0, high=365,
                        where="x IS NOT NULL").first().failures == 2
    assert Q.model_test(df, "m", "relationships", "k", ref=(ref, "k")).first().failures == 1


def test_expectations_mostly(spark):
    df = patients(spark, nulls=1).withColumn("dob", F.when(F.col("patient_id") == 5, None).otherwise(F.col("dob")))
    res = {(r.expectation, r.column): r for r in Q.expect(df, Q.PATIENT_EXPECTATIONS, "patients").collect()}
    assert not res[("not_null", "patient_id")].success         # mostly 1.0, one NULL
    assert res[("not_null", "dob")].success                     # 1/500 missing, mostly 0.99
    assert res[("unique", "mrn")].success and res[("column_to_exist", "patient_id")].success
    assert not res[("in_set", "insurance_type")].success is False


def test_gate_looks_at_unrounded_scores(spark):
    scores = spark.createDataFrame([("a", 0.94996, 10)], "source string, score double, record_count long")
    assert not Q.overall(scores).first().gate_passed
    checks = spark.createDataFrame([("a", "c", "not_null", 0, 9, 0.0, i != 0, "") for i in range(20)], Q.CHECK_SCHEMA)
    s = Q.score_sources(checks, threshold=0.95).first()
    assert s.score == 0.95 and s.gate_passed and s.record_count is None


def test_no_data_does_not_pass_the_gate(spark):
    assert Q.run_checks({}).collect() == []
    o = Q.overall(Q.score_sources(Q.run_checks({}))).first()
    assert (o.overall_score, o.sources, o.gate_passed) == (0.0, 0, False)
    empty = Q.run_checks({"patients": patients(spark).where("false")}, with_count=True)
    assert Q.score_sources(empty).collect() == []
    d = Q.gate_decision(Q.score_sources(empty)).first()
    assert (d.overall_score, d.decision, d.failing_sources) == (0.0, "HALT", "")


def test_unique_rules_do_not_expand_rows(spark):
    plan = Q.run_checks({"patients": patients(spark)})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_expectations_on_an_absent_column_fail(spark):
    rows = Q.expect(patients(spark).drop("mrn"), Q.PATIENT_EXPECTATIONS, "patients").collect()
    assert len(rows) == len(Q.PATIENT_EXPECTATIONS)
    assert all(not r.success for r in rows if r.column == "mrn") and all(r.success for r in rows if r.column == "patient_id")
