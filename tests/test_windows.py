"""Skew-safe keyed operators against brute force on small fixtures."""
import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clinspark.operators.silver import hr_rolling_5min
from clinspark.operators.windows import keep_last, numbered, rolling_mean_rows, rolling_mean_time


def _fixture(n=3000, seed=7):
    """One hot patient (about a third of rows), sparse patients, rows at bucket
    edges, NULL readings and a NULL patient."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        pid = 1 if rnd.random() < 0.35 else rnd.randint(2, 40)
        if i % 97 == 0:
            pid = None
        minute = rnd.randint(0, 60 * 30)
        sec = rnd.choice([0, 59, 30])
        ts = base + dt.timedelta(minutes=minute, seconds=sec)
        hr = None if i % 53 == 0 else round(rnd.uniform(40, 140), 1)
        rows.append((i, pid, ts, hr))
    return rows


def _brute_rows(rows, n):
    pdf = pd.DataFrame(rows, columns=["vital_id", "patient_id", "ts", "hr"])
    pdf = pdf.sort_values(["patient_id", "ts", "vital_id"], na_position="first")
    pdf["avg"] = (pdf.groupby("patient_id")["hr"].transform(lambda x: x.rolling(window=n, min_periods=1).mean()))
    return {r.vital_id: (None if pd.isna(r.avg) else r.avg) for r in pdf.itertuples()}


def _same(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        if v is None:
            assert got[k] is None, k
        else:
            assert got[k] is not None and abs(got[k] - v) < 1e-9, (k, got[k], v)


def _rolled(spark, rows, at_once, window=10):
    df = spark.createDataFrame(rows, "vital_id long, patient_id long, ts timestamp_ntz, hr double").repartition(5)
    out = rolling_mean_rows(df, "patient_id", ["ts", "vital_id"], "hr", window, "avg", at_once)
    assert out.columns == [*df.columns, "avg"]
    return {r.vital_id: r.avg for r in out.select("vital_id", "avg").collect()}


@pytest.mark.parametrize("at_once, n", [(4096, 3000), (100, 3000), (10, 800)])
def test_rolling_rows_matches_brute_force(spark, at_once, n):
    """Any bucket length: in buckets as long as the frame, each is halo as a whole."""
    rows = _fixture(n)
    _same(_rolled(spark, rows, at_once), _brute_rows(rows, 10))


@pytest.mark.parametrize("at_once", [16, 4096])
def test_rolling_rows_of_sparse_keys(spark, at_once):
    """A key of a third of the rows, one reading an hour; the others a reading a month."""
    base = dt.datetime(2020, 1, 1)
    rows = [(i, 1, base + dt.timedelta(hours=i), None if i % 41 == 0 else 60.0 + i % 37) for i in range(700)]
    rows += [(1000 + i, 2 + i % 60, base + dt.timedelta(days=31 * (i // 60)), 50.0 + i % 29) for i in range(1400)]
    random.Random(1).shuffle(rows)
    _same(_rolled(spark, rows, at_once), _brute_rows(rows, 10))


def test_rolling_rows_with_null_times_and_ties(spark):
    """Rows without a time come first; equal times are ordered by id."""
    rows = [(i, pid, None if i % 11 == 0 else ts, hr) for i, pid, ts, hr in _fixture(900, seed=3)]
    rows += [(10_000 + i, 1, rows[1][2], float(i)) for i in range(25)]
    rows += [(20_000 + i, 50, t, v) for i, (t, v) in enumerate(
        [(None, 100.0), (None, 90.0)] + [(dt.datetime(2024, 1, 1, h), 50.0 + h) for h in range(4)])]
    _same(_rolled(spark, rows, 12), _brute_rows(rows, 10))


def test_rolling_rows_of_one_row_and_of_none(spark):
    rows = _fixture(60)
    _same(_rolled(spark, rows, 4096, 1), {i: None if pid is None else hr for i, pid, _, hr in rows})
    assert _rolled(spark, [], 4096) == {}
    with pytest.raises(ValueError):
        _rolled(spark, rows, 9)


def test_no_window_over_a_whole_key(spark):
    """Every window of the plan is partitioned by a bucket as well; the number of a row comes from a range partitioning."""
    df = spark.createDataFrame(_fixture(50), "vital_id long, patient_id long, ts timestamp_ntz, hr double")
    plan = rolling_mean_rows(df, "patient_id", ["ts", "vital_id"], "hr", 10, "avg")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    keyed = [w for w in windows if "patient_id" in w]
    assert keyed and all("_bucket" in w.split("], [")[1] for w in keyed)


def test_numbers_follow_the_order(spark):
    """Many copies of one row, NULL keys: numbers are 0 to n - 1 in the order."""
    rows = [(i % 3 if i % 7 else None, i % 5, i) for i in range(400)] + [(1, 1, 0)] * 300
    df = spark.createDataFrame(rows, "k long, t long, x long").repartition(4)
    got = [(r.k, r.t) for r in sorted(numbered(df, ["k", "t"]).collect(), key=lambda r: r._pos)]
    assert sorted(r._pos for r in numbered(df, ["k", "t"]).collect()) == list(range(700))
    assert got == sorted(((k, t) for k, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("bucket", [5, 7, 60])
def test_rolling_time_matches_brute_force(spark, bucket):
    rows = [(i, pid, None if i % 13 == 0 else ts, hr) for i, pid, ts, hr in _fixture(1500, seed=11)]
    df = spark.createDataFrame(rows, "vital_id long, patient_id long, ts timestamp_ntz, hr double")
    out = rolling_mean_time(df, "patient_id", "ts", "hr", 5, "avg", bucket_minutes=bucket)
    by_pid, want = {}, {}
    for r in rows:
        by_pid.setdefault(r[1], []).append(r)
    for vid, pid, ts, hr in rows:
        near = [x[3] for x in by_pid[pid] if x[3] is not None and (
            x[2] is None if ts is None else x[2] is not None and ts - dt.timedelta(minutes=5) <= x[2] <= ts)]
        want[vid] = sum(near) / len(near) if near and pid is not None else None
    _same({r.vital_id: r.avg for r in out.collect()}, want)


def test_rolling_5min_of_silver_rows(spark):
    """E3 as the query has it: the window reaches over the edge of an hour, and is closed at both ends; rows without a time or a patient."""
    at = lambda h, m, s=0: dt.datetime(2024, 1, 1, h, m, s)
    rows = [(1, 7, at(9, 55), 60.0), (2, 7, at(10, 0), 70.0), (3, 7, at(10, 0, 1), 80.0), (4, 7, at(10, 0, 1), None),
            (5, 7, None, 50.0), (6, 7, None, 51.0), (7, None, at(9, 58), 90.0), (8, None, at(10, 2), 92.0), (9, 8, at(10, 0), None)]
    df = spark.createDataFrame(rows, "vital_id long, patient_id long, timestamp timestamp_ntz, heart_rate double")
    out = hr_rolling_5min(df)
    assert out.columns == [*df.columns, "hr_avg_5min"]
    assert {r.vital_id: r.hr_avg_5min for r in out.collect()} == {
        1: 60.0, 2: 65.0, 3: 75.0, 4: 75.0, 5: 50.5, 6: 50.5, 7: 90.0, 8: 91.0, 9: None}


def test_keep_last_dedup_sixty_to_fifty(spark):
    """The source's test: 50 patients plus the first 10 again -> 50 rows."""
    base = [(i, f"PHI_{i:012d}", dt.datetime(2026, 8, 31)) for i in range(50)]
    again = [(i, f"PHI_{i:012d}", dt.datetime(2026, 8, 31, 12)) for i in range(10)]
    df = spark.createDataFrame(base + again, "patient_id long, mrn string, extracted_at timestamp_ntz")
    out = keep_last(df, ["mrn"], ["extracted_at", "patient_id"])
    assert out.count() == 50
    latest = {r.patient_id: r.extracted_at for r in out.collect()}
    assert all(latest[i].hour == 12 for i in range(10))
    assert all(latest[i].hour == 0 for i in range(10, 50))


def test_keep_last_hot_key_and_null_key(spark):
    rows = [(i, "HOT", i) for i in range(5000)] + [(5000, None, 1), (5001, None, 2), (5002, "B", 3)]
    df = spark.createDataFrame(rows, "id long, k string, t long").repartition(8)
    out = {r.k: r.id for r in keep_last(df, ["k"], ["t", "id"]).collect()}
    assert out == {"HOT": 4999, None: 5001, "B": 5002}


def test_keep_last_plan_combines_map_side(spark):
    df = spark.createDataFrame([(1, "a", 1)], "id long, k string, t long")
    plan = keep_last(df, ["k"], ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
