"""Skew-safe keyed operators: keep-last dedup and rolling means.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; with
one patient (or one duplicated record) holding a third of all rows that task
does a third of the job. The operators here split each key - by the rows' number in
the order, or by time - and carry a bounded "halo" of rows across bucket edges, so the
largest task is bounded by the rows of one (key, bucket), not of one key.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], copies: str | None = None) -> DataFrame:
    """One row per key, the greatest by ``order`` (ties: greatest remaining columns).

    Written as ``max(struct(order..., row))`` per key: an aggregate, so Spark
    combines copies map-side before the shuffle and a hot key costs one row
    per input partition in the exchange. NULL keys form one group, like the
    source's keep-last dedup. ``copies`` names a column for the number of rows a key had.
    """
    cols = df.columns
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in cols]).alias("_row"))
    counts = [F.count(F.lit(1)).alias(copies)] if copies else []
    return (df.groupBy(*keys).agg(F.max(packed).alias("_last"), *counts)
              .select(*[F.col(f"_last._row.{c}").alias(c) for c in cols], *([copies] if copies else [])))


def numbered(df: DataFrame, order: Sequence[str], name: str = "numbered", out: str = "_pos") -> DataFrame:
    """Rows numbered 0, 1, 2, ... in ``order`` (NULL first) over the whole frame; no task holds more than its range.

    Rows are range-partitioned, sorted and written once under the shared
    checkpoint folder, since sampling the ranges anew could deal them differently.
    The offset of a range is a sum over one row per range. Rows that are equal
    in ``order`` are told apart by where they were read, so that copies do not
    share one range.
    """
    tie = "_read"
    placed = cut_lineage(df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie)
                           .sortWithinPartitions(*order, tie).drop(tie)
                           .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: as many as there are shuffle partitions
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
                     .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
                  .withColumn(out, F.col("_offset") + row).drop("_at", "_part", "_offset"))


def rolling_mean_rows(df: DataFrame, key: str, order: Sequence[str], value: str, rows: int, out: str,
                      at_once: int = 4096) -> DataFrame:
    """Mean of ``value`` over the last ``rows`` rows per key (min 1 row, NULLs skipped).

    An ordered prefix carry: rows are numbered by (key, order) over the whole
    frame (``numbered``), ``at_once`` numbers are a bucket, and the last rows-1
    rows of a bucket are also handed to the next. As a key's rows are
    consecutive numbers, the rows a frame looks back to are in its bucket or its
    halo. A window runs per (bucket, key): at most at_once + rows - 1
    rows, however many rows the key has and however far they lie apart in
    time. Rows with a NULL key get NULL.
    """
    back = rows - 1
    if at_once <= back:
        raise ValueError("a bucket must be longer than the frame")
    if back == 0:
        return df.withColumn(out, F.when(F.col(key).isNotNull(), F.col(value).cast("double")))
    body = (numbered(df, [key, *order], "rolling").withColumn("_bucket", F.expr(f"_pos div {at_once}"))
            .withColumn("_is_halo", F.lit(False)))
    halo = (body.where((F.col("_pos") % at_once >= at_once - back) & F.col(key).isNotNull())
                .select(key, "_pos", value, (F.col("_bucket") + 1).alias("_bucket"), F.lit(True).alias("_is_halo")))
    frame = Window.partitionBy("_bucket", key).orderBy("_pos").rowsBetween(-back, 0)
    return (body.unionByName(halo, allowMissingColumns=True)
                .withColumn(out, F.when(F.col(key).isNotNull(), F.avg(value).over(frame)))
                .where(~F.col("_is_halo"))
                .drop("_pos", "_bucket", "_is_halo"))


def _bucketed(df: DataFrame, bucket: Column) -> DataFrame:
    """Rows with their bucket of time; rows without a time have one of their own, before all others."""
    return (df.withColumn("_bucket", F.coalesce(bucket, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")))
              .withColumn("_is_halo", F.lit(False)))


def rolling_mean_time(df: DataFrame, key: str, ts: str, value: str, minutes: int,
                      out: str, bucket_minutes: int = 60, null_key: bool = False) -> DataFrame:
    """Mean of ``value`` over rows of the same key with ts in [ts - minutes, ts].

    Every key is bucketed by ``bucket_minutes``; rows in the last ``minutes`` of
    a bucket are copied into the next bucket as halo, then the RANGE frame runs
    per (key, bucket). Rows without a time share a frame of their own.
    Rows with a NULL key get NULL, or with ``null_key`` are a key like any other, as SQL has them.
    Needs bucket_minutes >= minutes.
    """
    if bucket_minutes < minutes:
        raise ValueError("bucket must be at least as long as the window")
    keyed = F.lit(True) if null_key else F.col(key).isNotNull()
    width = bucket_minutes * 60
    start = F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / width) * width).cast("timestamp_ntz")
    body = _bucketed(df, start)
    nxt = F.timestamp_add("MINUTE", F.lit(bucket_minutes), F.col("_bucket"))
    halo = (body.where(keyed & (F.col(ts) >= F.timestamp_add("MINUTE", F.lit(-minutes), nxt)))
                .select(key, ts, value, nxt.alias("_bucket"), F.lit(True).alias("_is_halo")))
    both = body.unionByName(halo, allowMissingColumns=True)
    frame_sql = (f"avg(`{value}`) OVER (PARTITION BY `{key}`, _bucket ORDER BY `{ts}` "
                 f"RANGE BETWEEN INTERVAL {minutes} MINUTES PRECEDING AND CURRENT ROW)")
    return (both.withColumn(out, F.when(keyed, F.expr(frame_sql)))
                .where(~F.col("_is_halo"))
                .drop("_bucket", "_is_halo"))
