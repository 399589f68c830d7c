"""ICU vitals as a Structured Streaming job.

* S1 ``vitals_stream``: a file-source stream of monitor events (schema given,
  no inference), turned into ICU rows by the same Column functions as batch.
* S3 ``dedup_vitals``: drop repeated ``vital_id`` within the watermark.
* S2 ``alert_windows``: 5-minute tumbling windows per ICU unit with a
  10-minute watermark; state is purged behind it and rows older than it are
  dropped (Spark filters late input with the previous micro-batch's
  watermark, so a row is dropped from the second batch after the watermark
  passed it).
  ``run_accounted_windows`` keeps what comes late: a first job deals each micro-batch to on-time rows and a
  side table of late ones, by the watermark of the batches before it, and the windows
  are then those of a job over the on-time rows, of which Spark drops none. ``window_account`` sets
  both against each other per window.
* S4 ``refresh_silver``: incremental refresh with ``trigger(availableNow=True)``
  and ``foreachBatch`` into the same silver table as the batch's (P4), its rolling mean (E1)
  included. A micro-batch is rolled together with the readings of its
  patients that a state table keeps: those within ``LATENESS`` of the latest seen, and the few
  before these that a mean looks back to. A late reading changes the means of
  the readings after it: those rows are written again and replace what was
  written before (``read_silver``). A reading seen before is left out; one later than ``LATENESS``,
  or without a time, cannot be placed and goes to the table of late rows
  (``read_late``), so that silver, repeats and late rows account for all input.

Micro-batches are all or nothing: a batch writes its rows to a folder that a retry
replaces, then commits its state; readers take the rows of committed batches. The
checkpoint lies under the shared checkpoint folder, so a restarted job resumes where it stopped.

Clinical times are TIMESTAMP_NTZ; the watermark needs TIMESTAMP, so the stream
casts with the session zone (UTC).
"""
from __future__ import annotations

import datetime as dt
import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import config as C
from ..functions.clinical import ts_lit
from ..operators.silver import ICU_ORDER, icu_measures, icu_rolling
from ..operators.windows import keep_last
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.testdata import INPUT_SCHEMAS, icu_from_events
from ..sources.versions import PART, PARTS, Versions

LATENESS = dt.timedelta(minutes=10)
WATERMARK = "10 minutes"
WINDOW = "5 minutes"


def vitals_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Streaming ICU rows from monitor event files under ``path``."""
    reader = spark.readStream.schema(INPUT_SCHEMAS["events"]).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return icu_measures(icu_from_events(reader.load(path))).withColumn("event_time", F.col("timestamp").cast("timestamp"))


def with_watermark(stream: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Late-data bound on event time; defined once per query, shared by S3 and S2."""
    return stream.withWatermark("event_time", watermark)


def dedup_vitals(stream: DataFrame) -> DataFrame:
    """S3: one row per vital_id among rows inside the watermark (set beforehand)."""
    return stream.dropDuplicatesWithinWatermark(["vital_id"])


def alert_windows(stream: DataFrame, window: str = WINDOW, watermark: str | None = WATERMARK) -> DataFrame:
    """Per (5-minute window, ICU unit): readings, alerts, mean heart rate.

    Pass ``watermark=None`` when the stream already carries one.
    """
    if watermark:
        stream = with_watermark(stream, watermark)
    return (stream.groupBy(F.window("event_time", window).alias("w"), "icu_unit")
                  .agg(F.count(F.lit(1)).alias("readings"),
                       F.count_if(F.col("alert_triggered")).alias("alerts"),
                       F.avg("heart_rate").alias("mean_hr"))
                  .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                          "icu_unit", "readings", "alerts", "mean_hr"))


def _checkpoint(spark: SparkSession, kind: str, target: str) -> str:
    """A folder of its own for each target, whatever targets share a last name."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{kind}-{hashlib.sha256(target.encode()).hexdigest()[:32]}")


def run_alert_windows(spark: SparkSession, path: str, target: str, checkpoint: str | None = None,
                      dedup: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Run S2 (after S3) over everything available now into the parquet table at ``target``.

    The file sink's log makes each closed window appear once, also after a restart.
    """
    s = with_watermark(vitals_stream(spark, path, max_files=max_files))
    if dedup:
        s = dedup_vitals(s)
    return (alert_windows(s, watermark=None).writeStream.outputMode("append").format("parquet").option("path", target)
              .option("checkpointLocation", checkpoint or _checkpoint(spark, "alerts", target))
              .trigger(availableNow=True).start())


def split_late(batch: DataFrame, epoch: int, target: str, lateness: dt.timedelta = LATENESS) -> None:
    """One micro-batch's rows to ``ontime`` or, if they are not after the watermark or have no time, to ``late``.

    The watermark is the latest time of the batches before, less ``lateness``; each batch leaves the latest
    time seen so far (one row) in a folder of its own, written last. A batch that is run again is dealt as
    before and replaces its own folders.
    """
    spark = batch.sparkSession
    seen = lambda n: os.path.join(target, "seen", f"batch_id={n}")
    before = spark.read.schema("latest timestamp").parquet(seen(epoch - 1)).first()[0] if epoch else None
    time = F.col("event_time")
    late = time.isNull() if before is None else time.isNull() | (time <= F.lit(before - lateness))
    rows = cut_lineage(batch.withColumn("_late", late), "icu-arrived")
    for kind, chosen in (("ontime", ~F.col("_late")), ("late", F.col("_late"))):
        rows.where(chosen).drop("_late").write.mode("overwrite").parquet(os.path.join(target, kind, f"batch_id={epoch}"))
    latest = F.max("event_time") if before is None else F.greatest(F.max("event_time"), F.lit(before))
    rows.agg(latest.alias("latest")).coalesce(1).write.mode("overwrite").parquet(seen(epoch))


def run_accounted_windows(spark: SparkSession, path: str, target: str, lateness: dt.timedelta = LATENESS,
                          width: dt.timedelta = dt.timedelta(minutes=5), max_files: int | None = None) -> None:
    """S2 after S3 over everything available now, with a side table of late rows; run again, it takes up what is new.

    ``target`` holds the closed windows (``windows``), the on-time rows and the late ones. The second job starts when
    the first has committed its batches, and its watermark is never ahead of the one the rows were dealt by.
    """
    seconds = lambda d: f"{d.total_seconds():.0f} seconds"
    (vitals_stream(spark, path, max_files=max_files).writeStream
        .foreachBatch(lambda batch, epoch: split_late(batch, epoch, target, lateness))
        .option("checkpointLocation", _checkpoint(spark, "split", target)).trigger(availableNow=True).start().awaitTermination())
    ontime = spark.readStream.schema(vitals_stream(spark, path).schema).parquet(os.path.join(target, "ontime", "*"))
    counted = alert_windows(dedup_vitals(with_watermark(ontime, seconds(lateness))), seconds(width), watermark=None)
    (counted.writeStream.outputMode("append").format("parquet").option("path", os.path.join(target, "windows"))
            .option("checkpointLocation", _checkpoint(spark, "accounted", target)).trigger(availableNow=True).start().awaitTermination())


def read_windows(spark: SparkSession, target: str) -> DataFrame:
    """The closed windows of ``run_accounted_windows``."""
    return spark.read.parquet(os.path.join(target, "windows"))


def read_late_arrivals(spark: SparkSession, target: str) -> DataFrame:
    """The late rows of ``run_accounted_windows``, with the batch that brought them."""
    at = os.path.join(target, "late")
    return spark.read.option("basePath", at).parquet(at)


def window_account(spark: SparkSession, target: str, width: dt.timedelta = dt.timedelta(minutes=5)) -> DataFrame:
    """Per window and unit: rows on time, readings counted (NULL while the window is open), late rows.

    On-time and late rows add up to all input; on-time rows of a closed window that are not counted are repeats. Rows
    without a time are late, in a window NULL. Three counts combined map-side, one exchange.
    """
    micros = int(width.total_seconds() * 1e6)
    at = F.unix_micros("event_time")
    start = F.timestamp_micros(at - F.pmod(at, F.lit(micros))).cast("timestamp_ntz").alias("window_start")
    arrived = lambda kind: os.path.join(target, kind, "*")
    none = F.lit(None).cast("long")
    parts = [spark.read.parquet(arrived("ontime")).select(start, "icu_unit", F.lit(1).cast("long").alias("on"), none.alias("counted"), none.alias("late")),
             spark.read.parquet(arrived("late")).select(start, "icu_unit", none.alias("on"), none.alias("counted"), F.lit(1).cast("long").alias("late")),
             read_windows(spark, target).select("window_start", "icu_unit", none.alias("on"), F.col("readings").alias("counted"), none.alias("late"))]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return (parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("window_start", "icu_unit")
            .agg(total("on").alias("on_time_rows"), F.sum("counted").alias("counted_readings"), total("late").alias("late_rows")))


def _state(spark: SparkSession, target: str, parts: int) -> Versions:
    return Versions(spark, os.path.join(target, "state"), parts)


def _same_patient(a: str = "patient_id", b: str = "_patient") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def write_batch(batch: DataFrame, epoch: int, target: str, lateness: dt.timedelta = LATENESS, parts: int = PARTS) -> None:
    """One micro-batch of ``vitals_stream`` rows into the silver table at ``target``; a batch that is run again changes nothing.

    ``state`` holds, per patient, all readings from ``cut`` (the latest time
    seen less ``lateness``) on, and the last nine before it: whatever a reading from
    ``cut`` on can change, or is averaged with.
    """
    spark = batch.sparkSession
    state, version = _state(spark, target, parts), epoch + 1
    if state.current() >= version:
        return  # a retry of a batch whose state is committed, its rows being written before it
    info = state.info(version - 1)
    seen = dt.datetime.fromisoformat(info["latest"]) if info.get("latest") else None
    time = F.col("timestamp")
    placed = time.isNotNull() & (F.lit(True) if seen is None else time >= ts_lit(seen - lateness))
    rows = cut_lineage(batch.drop("event_time").withColumn("_placed", placed), "icu-batch")
    rows.where(~F.col("_placed")).drop("_placed").write.mode("overwrite").parquet(os.path.join(target, "late", f"batch_id={epoch}"))

    new = keep_last(rows.where("_placed").drop("_placed"), ["vital_id"], ["timestamp"])
    schema = StructType(new.schema.fields).add("hr_rolling_avg", "double")
    patients = new.select(F.col("patient_id").alias("_patient"), state.part_of("patient_id").alias("_p")).distinct()
    touched = [r[0] for r in patients.select("_p").distinct().collect()]  # at most ``parts`` numbers
    held = state.read(schema, version - 1, touched)
    known = held.join(patients, _same_patient(), "left_semi")
    ids = known.select(F.col("vital_id").alias("_id"))
    new = new.join(ids, F.col("vital_id").eqNullSafe(F.col("_id")), "left_anti")
    both = known.withColumnRenamed("hr_rolling_avg", "_before").withColumn("_new", F.lit(False)).unionByName(
        new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    # a reading before the cut lacks some that it was averaged with, and no reading of this batch comes before it
    final = F.lit(False) if seen is None else (time < ts_lit(seen - lateness))
    rolled = cut_lineage(icu_rolling(both).withColumn("hr_rolling_avg", F.when(final, F.col("_before")).otherwise(F.col("hr_rolling_avg"))),
                         "icu-rolled")
    changed = rolled.where(F.col("_new") | ~F.col("hr_rolling_avg").eqNullSafe(F.col("_before")))
    columns = [f.name for f in schema.fields]
    changed.select(*columns).write.mode("overwrite").parquet(os.path.join(target, "rows", f"batch_id={epoch}"))

    latest = rolled.agg(F.max("timestamp")).first()[0]
    latest = max((t for t in (seen, latest) if t is not None), default=None)
    cut = ts_lit(latest - lateness) if latest is not None else F.lit(None).cast("timestamp_ntz")
    last = Window.partitionBy("patient_id").orderBy(*[F.col(c).desc() for c in ICU_ORDER])
    recent = rolled.where(time >= cut)
    # at most nine rows a patient leave a task
    older = rolled.where(~(time >= cut)).withColumn("_n", F.row_number().over(last)).where(F.col("_n") < C.ROLLING_ROWS)
    others = held.join(patients, _same_patient(), "left_anti")
    kept = recent.select(*columns).unionByName(older.select(*columns)).unionByName(others.select(*columns))
    state.replace(kept.withColumn(PART, state.part_of("patient_id")), version, touched, ["patient_id", "timestamp"],
                  {"latest": latest.isoformat() if latest is not None else None})
    state.prune()


def refresh_silver(spark: SparkSession, path: str, target: str, checkpoint: str | None = None, lateness: dt.timedelta = LATENESS,
                   max_files: int | None = None, parts: int = PARTS) -> StreamingQuery:
    """Newly arrived monitor rows to the silver table at ``target``; re-running only picks up new files."""
    return (vitals_stream(spark, path, max_files=max_files).writeStream
              .foreachBatch(lambda batch, epoch: write_batch(batch, epoch, target, lateness, parts))
              .option("checkpointLocation", checkpoint or _checkpoint(spark, "refresh", target))
              .trigger(availableNow=True).start())


def _committed(spark: SparkSession, target: str, kind: str, parts: int) -> DataFrame:
    rows = spark.read.option("basePath", os.path.join(target, kind)).parquet(os.path.join(target, kind))
    return rows.where(F.col("batch_id") < _state(spark, target, parts).current())


def read_silver(spark: SparkSession, target: str, parts: int = PARTS) -> DataFrame:
    """The silver table: of a reading written more than once, as it was written last by a committed batch."""
    return keep_last(_committed(spark, target, "rows", parts), ["vital_id"], ["batch_id"]).drop("batch_id")


def read_late(spark: SparkSession, target: str, parts: int = PARTS) -> DataFrame:
    """Readings that came too late to be placed, or have no time."""
    return _committed(spark, target, "late", parts)
