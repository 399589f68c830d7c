"""Structured Streaming ICU jobs against the batch result on the same files."""
import datetime as dt
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from clinspark.operators import insights, silver
from clinspark.operators.silver import icu_measures
from clinspark.sources.testdata import icu_from_events, read_table
from clinspark.streaming import icu

SF = "/root/testdata/sf0.001"


def _split_events(spark, tmp_dir, parts=4):
    """Write the events table as several files (one per time slice) - a file stream source."""
    src = os.path.join(tmp_dir, "events")
    ev = read_table(spark, SF, "events")
    ev.withColumn("slice", F.ntile(parts).over(__import__("pyspark.sql").sql.Window.orderBy("ts"))) \
      .repartition("slice").drop("slice").write.parquet(src)
    return src, ev


def test_alert_windows_stream_equals_batch_on_closed_windows(spark, tmp_dir):
    src, ev = _split_events(spark, tmp_dir)
    target = os.path.join(tmp_dir, "alerts")
    icu.run_alert_windows(spark, src, target, dedup=True).awaitTermination(300)
    once = spark.read.parquet(target).count()
    icu.run_alert_windows(spark, src, target, dedup=True).awaitTermination(300)   # nothing new
    assert spark.read.parquet(target).count() == once
    streamed = {(r.window_start, r.icu_unit): (r.readings, r.alerts, round(r.mean_hr, 6))
                for r in spark.read.parquet(target).collect()}
    batch = insights.alert_windows(icu_from_events(ev))
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(max_ts - dt.timedelta(minutes=10)))
    expected = {(r.window_start, r.icu_unit): (r.readings, r.alerts, round(r.mean_hr, 6)) for r in closed.collect()}
    assert expected and set(expected) <= set(streamed)
    for k, v in expected.items():
        assert streamed[k] == v, k


def test_dedup_within_watermark(spark, tmp_dir):
    src, ev = _split_events(spark, tmp_dir, parts=2)
    # the same monitor rows delivered again in a later file
    ev.limit(50).write.mode("append").parquet(src)
    target = os.path.join(tmp_dir, "dedup")
    icu.run_alert_windows(spark, src, target, dedup=True).awaitTermination(300)
    total = spark.read.parquet(target).agg(F.sum("readings")).first()[0]
    assert total <= ev.count()


def _same_as_batch(spark, target, events, parts=4):
    """The silver table equals the batch's (P4) over the same events, rolling means included."""
    want = silver.transform_icu_vitals(icu_from_events(events))
    got = icu.read_silver(spark, target, parts).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _deliver(spark, rows, src, target, **how):
    rows.write.mode("append").parquet(src)
    icu.refresh_silver(spark, src, target, parts=4, **how).awaitTermination(300)


def test_silver_of_many_batches_equals_the_batch(spark, tmp_dir):
    """Late readings change the means after them, repeats are left out, a patient holds a third of all rows."""
    ev = read_table(spark, SF, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id") % 40))
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 50 == 0, None).otherwise(F.col("user_id")))
    src, target = os.path.join(tmp_dir, "events"), os.path.join(tmp_dir, "silver")
    dealt = ev.withColumn("n", F.ntile(5).over(Window.orderBy("ts"))).withColumn(
        "n", F.when((F.col("event_id") % 4 == 0) & (F.col("n") < 5), F.col("n") + 1).otherwise(F.col("n"))).cache()
    for i in range(1, 6):
        rows = dealt.where(F.col("n") == i).drop("n")
        again = dealt.where(F.col("n") == i - 1).drop("n").where("event_id % 7 = 0")
        _deliver(spark, rows.unionByName(again).unionByName(rows.where("event_id % 11 = 0")), src, target,
                 lateness=dt.timedelta(days=400))
        _same_as_batch(spark, target, dealt.where(F.col("n") <= i).drop("n"))
    assert icu.read_late(spark, target, 4).count() == 0


def test_state_holds_what_lateness_asks_for(spark, tmp_dir):
    """With a short lateness the state is small, the table still equal; what comes later is told apart, and nothing is lost."""
    ev = read_table(spark, SF, "events").withColumn("user_id", F.col("user_id") % 20)
    src, target = os.path.join(tmp_dir, "events"), os.path.join(tmp_dir, "silver")
    dealt = ev.withColumn("n", F.ntile(4).over(Window.orderBy("ts", "event_id"))).cache()
    for i in range(1, 5):
        _deliver(spark, dealt.where(F.col("n") == i).drop("n"), src, target, lateness=dt.timedelta(days=1))
    _same_as_batch(spark, target, ev)
    schema = icu.read_silver(spark, target, 4).schema
    held = icu._state(spark, target, 4).read(schema)
    recent = held.where(F.col("timestamp") >= ev.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)).count()
    assert held.count() <= recent + 9 * 20 and held.count() < ev.count() / 2
    late = ev.limit(6).withColumns({"event_id": F.col("event_id") + 10 ** 9, "ts": F.when(F.col("event_id") % 2 == 0, None).otherwise(
        F.lit(dt.datetime(2001, 1, 1)))}).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    _deliver(spark, late, src, target, lateness=dt.timedelta(days=1))
    assert icu.read_late(spark, target, 4).count() == 6
    _same_as_batch(spark, target, ev)


def test_a_repeated_or_killed_batch(spark, tmp_dir):
    """A batch run again changes nothing; rows of a batch whose state was not committed are not read, and replaced."""
    target = os.path.join(tmp_dir, "silver_icu")
    ev = read_table(spark, SF, "events")
    batch = [icu_measures(icu_from_events(ev.where(f"event_id % 2 = {i}"))).withColumn("event_time", F.col("timestamp").cast("timestamp"))
             for i in range(2)]
    how = (target, dt.timedelta(days=4000), 4)
    for epoch in (0, 0):
        icu.write_batch(batch[0], epoch, *how)
    _same_as_batch(spark, target, ev.where("event_id % 2 = 0"))
    batch[0].limit(5).withColumn("hr_rolling_avg", F.lit(1.0)).drop("event_time").write.parquet(os.path.join(target, "rows", "batch_id=1"))
    _same_as_batch(spark, target, ev.where("event_id % 2 = 0"))
    for epoch in (1, 1):
        icu.write_batch(batch[1], epoch, *how)
    _same_as_batch(spark, target, ev)


def test_nothing_new_and_targets_with_one_last_name(spark, tmp_dir):
    src, ev = _split_events(spark, tmp_dir, parts=1)
    for folder in ("a", "b"):
        target = os.path.join(tmp_dir, folder, "silver_icu")
        for _ in range(2):
            icu.refresh_silver(spark, src, target, parts=4).awaitTermination(300)
            assert icu.read_silver(spark, target, 4).count() == ev.count()


def test_json_stream_source(spark, tmp_dir):
    """S1 from JSON lines (the ICU feed is declared as a JSON time series)."""
    src = os.path.join(tmp_dir, "events_json")
    ev = read_table(spark, SF, "events")
    ev.write.json(src)
    q = (icu.vitals_stream(spark, src, fmt="json").writeStream.format("memory").queryName("t_json")
            .option("checkpointLocation", os.path.join(tmp_dir, "ckpt_json")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("t_json")
    assert got.count() == ev.count()
    batch = {r.vital_id: (r.alert_type, r.heart_rate) for r in icu_from_events(ev).collect()}
    assert {r.vital_id: (r.alert_type, r.heart_rate) for r in got.collect()} == batch


def test_late_rows_beyond_watermark_are_dropped(spark, tmp_dir):
    """A reading older than the watermark, arriving in a later file, changes nothing.

    Spark filters late input with the previous batch's watermark, so the late
    file comes two batches after the watermark has moved.
    """
    src = os.path.join(tmp_dir, "events_late")
    ev = read_table(spark, SF, "events")
    cut = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    ev.where(F.col("event_id") <= cut).coalesce(1).write.parquet(os.path.join(src, "a"))
    ev.where(F.col("event_id") > cut).coalesce(1).write.parquet(os.path.join(src, "b"))
    late = ev.limit(1).withColumn("event_id", F.lit(10 ** 9)).withColumn("ts", F.lit(dt.datetime(2023, 1, 1)))
    late.coalesce(1).write.parquet(os.path.join(src, "c"))
    target = os.path.join(tmp_dir, "late")
    q = icu.run_alert_windows(spark, os.path.join(src, "*"), target, dedup=False, max_files=1)
    q.awaitTermination(300)
    assert [p["numInputRows"] for p in q.recentProgress][-1] == 1
    out = spark.read.parquet(target)
    assert out.where(F.year("window_start") == 2023).count() == 0


def test_windows_and_late_rows_account_for_all_input(spark, tmp_dir):
    """Three deliveries with repeats, late rows and rows without a time: nothing is lost, and windows hold on-time readings once."""
    ev = read_table(spark, SF, "events").withColumn("ts", F.when(F.col("event_id") % 97 == 0, None).otherwise(F.col("ts")))
    n = F.ntile(3).over(Window.orderBy("ts", "event_id"))
    dealt = ev.withColumn("n", n).withColumn("n", F.when((F.col("event_id") % 5 == 0) & (F.col("n") < 3), F.col("n") + 1).otherwise(F.col("n"))).cache()
    src, target = os.path.join(tmp_dir, "events"), os.path.join(tmp_dir, "accounted")
    arrived, mark, late, ontime = [], None, [], []
    for i in (1, 2, 3):
        rows = dealt.where(F.col("n") == i).drop("n")
        rows = rows.unionByName(rows.where("event_id % 11 = 0")).cache()        # delivered twice
        rows.write.mode("append").parquet(src)
        icu.run_accounted_windows(spark, src, target)
        got = [(r.event_id, r.ts) for r in rows.collect()]
        for event, ts in got:
            (late if ts is None or (mark is not None and ts <= mark) else ontime).append((event, ts))
        arrived += got
        mark = max(ts for _, ts in arrived if ts is not None) - dt.timedelta(minutes=10)
        account = icu.window_account(spark, target).collect()
        assert sum(r.on_time_rows + r.late_rows for r in account) == len(arrived)
        assert sorted((r.vital_id, r.timestamp) for r in icu.read_late_arrivals(spark, target).collect() if r.timestamp) == sorted(
            (e, t) for e, t in late if t)
        floor = lambda t: t - dt.timedelta(minutes=t.minute % 5, seconds=t.second, microseconds=t.microsecond)
        closed = {e for e, t in ontime if floor(t) + dt.timedelta(minutes=5) <= mark}
        assert sum(r.readings for r in icu.read_windows(spark, target).collect()) == len(closed)
        assert sum(r.counted_readings or 0 for r in account) == len(closed)
    assert late and len(late) < len(arrived) / 2
    icu.run_accounted_windows(spark, src, target)                               # nothing new
    assert sorted(map(str, icu.window_account(spark, target).collect())) == sorted(map(str, account))


def test_a_batch_dealt_again_is_dealt_alike(spark, tmp_dir):
    ev = read_table(spark, SF, "events")
    batch = [icu_measures(icu_from_events(ev.where(w))).withColumn("event_time", F.col("timestamp").cast("timestamp"))
             for w in ("event_id % 2 = 0", "event_id % 2 = 1", "false")]
    for epoch, rows in ((0, batch[0]), (1, batch[1]), (1, batch[1]), (2, batch[2]), (3, batch[1])):
        icu.split_late(rows, epoch, tmp_dir, dt.timedelta(days=3))
    ids = lambda kind, n: {r.vital_id for r in spark.read.parquet(os.path.join(tmp_dir, kind, f"batch_id={n}")).collect()}
    first = batch[0].agg(F.max("event_time")).first()[0]
    want = {r.vital_id for r in batch[1].collect() if r.event_time > first - dt.timedelta(days=3)}
    assert ids("ontime", 1) == want and ids("late", 1) == {r.vital_id for r in batch[1].collect()} - want
    assert ids("ontime", 2) == set() and len(ids("ontime", 3)) > 0             # the mark outlives a batch without rows
