"""Dashboard and chart figures as aggregations (D7-D11, F3, F4, S2 batch form).

Every figure is computed on the executors; only the small aggregated frames
(one row per category, bin or metric) would ever reach the driver. Unlike the
source dashboard, which read an unordered LIMIT of ICU rows, every figure
covers all rows.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clinical import round_half_up


def _stack(df: DataFrame, metrics: dict) -> DataFrame:
    """One aggregation of ``df`` turned into (metric, value) rows."""
    cols = [F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in metrics.items()]
    return df.agg(F.array(*cols).alias("_m")).select(F.explode("_m").alias("r")).select("r.metric", "r.value")


def kpi_summary(patients: DataFrame, encounters: DataFrame, labs: DataFrame, billing: DataFrame,
                icu: DataFrame) -> DataFrame:
    """The KPI tiles as (metric, value) rows - one aggregation per table,
    stacked with a union (no joins between the one-row results).

    Collection rate divides by max(charges, 1), as the dashboard does.
    """
    inpatient = F.col("encounter_type") == "INPATIENT"
    n = F.count(F.lit(1))
    alerts = F.count_if(F.col("alert_triggered"))
    charges = F.coalesce(F.sum("charge_amount"), F.lit(0.0))
    paid = F.coalesce(F.sum("paid_amount"), F.lit(0.0))
    parts = [
        _stack(patients, {"total_patients": n}),
        _stack(encounters, {"total_encounters": n,
                            "avg_inpatient_los": round_half_up(F.avg(F.when(inpatient, F.col("los_days"))), 1)}),
        _stack(labs, {"total_labs": n, "critical_labs": F.count_if(F.col("result_category") == "CRITICAL")}),
        _stack(billing, {"total_billing": n, "total_charges": round_half_up(charges, 2),
                         "total_paid": round_half_up(paid, 2),
                         "collection_rate": round_half_up(paid / F.greatest(charges, F.lit(1.0)) * 100, 1)}),
        _stack(icu, {"icu_readings": n, "alerts": alerts,
                     "alert_rate": round_half_up(alerts / F.greatest(n, F.lit(1)) * 100, 2)}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def breakdown(df: DataFrame, col: str, top: int | None = None, chart: str | None = None) -> DataFrame:
    """D8 (+F3 with ``top``): (chart, category, count, rank), count desc, NULLs dropped.

    Ties in count are ordered by category. The top-k is a TakeOrdered over the
    per-category counts, never a sort of the rows. Without ``top`` the rank
    window holds one row per category, so it is meant for code-list columns
    (types, units, flags); pass ``top`` for open-ended columns.
    """
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("category"))
                .agg(F.count(F.lit(1)).alias("count")))
    if top is not None:
        counts = counts.orderBy(F.col("count").desc(), "category").limit(top)
    w = Window.partitionBy(F.lit(chart or col)).orderBy(F.col("count").desc(), "category")
    return counts.select(F.lit(chart or col).alias("chart"), "category", "count",
                         F.row_number().over(w).alias("rank"))


def share_of_total(counts: DataFrame, key: str = "chart") -> DataFrame:
    """Count / total per chart on an aggregated frame (one row per category,
    so the per-chart window holds a bounded number of rows)."""
    w = Window.partitionBy(key)
    return counts.withColumn("share_pct", round_half_up(F.col("count") / F.sum("count").over(w) * 100, 2))


def rate_by(df: DataFrame, key: str, flag: str, digits: int = 4) -> DataFrame:
    """Per key mean of a boolean flag, rounded to ``digits``, times 100."""
    return (df.groupBy(key).agg(round_half_up(F.avg(F.col(flag).cast("double")), digits).alias("_r"))
              .select(key, (F.col("_r") * 100).alias(f"{flag}_pct")))


def histogram(long: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Equal-width histogram per series of a (series, value) frame.

    Range = [min, max] of each series (already clipped by the caller); the
    last bin is closed. Bin edges come from a per-series aggregate joined on
    the series name (one row per series of ``bins``: a bounded broadcast). A
    series that ``bins`` does not name raises an error.
    """
    known = F.create_map(*[F.lit(x) for k, v in bins.items() for x in (k, int(v))])
    number = F.coalesce(F.try_element_at(known, F.col("series")),
                        F.raise_error(F.concat(F.lit("no bins for series "), F.col("series"))).cast("int"))
    stats = (long.groupBy("series").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
                 .withColumn("bins", number))
    width = F.col("hi") - F.col("lo")
    idx = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) * (F.col("bins") / width)),
                                    F.col("bins") - 1)).otherwise(F.lit(0))
    return (long.join(F.broadcast(stats), "series")
                .groupBy("series", idx.cast("int").alias("bin"), "lo", "hi", "bins")
                .agg(F.count(F.lit(1)).alias("count"))
                .select("series", "bin",
                        (F.col("lo") + F.col("bin") * width / F.col("bins")).alias("bin_low"),
                        (F.col("lo") + (F.col("bin") + 1) * width / F.col("bins")).alias("bin_high"),
                        "count"))


def series_summary(long: DataFrame, ranges: int = 1024) -> DataFrame:
    """Per series count, mean and exact median (pandas ``.median()``).

    Rows are counted per (series, value) with map-side combine. The span of a series
    is cut into ``ranges`` value ranges; cumulative counts over these find the
    range that holds a middle row, and only that range's values are ranked. No
    state grows with the rows, and no task holds all values of a series.
    """
    n, v = F.col("_n"), F.col("value")
    counts = long.groupBy("series", "value").agg(F.count(F.lit(1)).alias("_n"))
    stats = counts.groupBy("series").agg(F.sum("_n").alias("n"), (F.sum(v * n) / F.sum("_n")).alias("mean"),
                                         F.min("value").alias("lo"), F.max("value").alias("hi"))
    part = F.when(F.col("hi") > F.col("lo"), F.least(
        F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * ranges), F.lit(ranges - 1))).otherwise(F.lit(0))
    cut = counts.join(stats, "series").withColumn("part", part.cast("long"))
    sums = cut.groupBy("series", "part").agg(F.sum("_n").alias("_in"), F.max("n").alias("n"))
    to_here = Window.partitionBy("series").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)   # places of the middle rows from 0
    sums = sums.withColumn("_before", F.sum("_in").over(to_here) - F.col("_in"))
    middle = sums.where((F.col("_before") <= high) & (low < F.col("_before") + F.col("_in"))).select("series", "part", "_before")
    inside = Window.partitionBy("series", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cut.join(middle, ["series", "part"]).withColumn("_to", F.col("_before") + F.sum("_n").over(inside))
    holds = lambda i: (F.col("_to") - n <= i) & (i < F.col("_to"))
    return (ranked.groupBy("series", "n", "mean").agg(
                ((F.max(F.when(holds(low), v)) + F.max(F.when(holds(high), v))) / 2).alias("median")))


def clipped_series(df: DataFrame, specs: Sequence[tuple[str, str, float, float]]) -> DataFrame:
    """(series, value) rows: each column's non-null values clipped to [lo, hi] (B11 + clip).

    All columns of one frame come from a single scan (one exploded array of
    (series, value) pairs per row), not one scan per column.
    """
    items = [F.when(F.col(col).isNotNull(),
                    F.struct(F.lit(name).alias("series"),
                             F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.col(col))).alias("value")))
             for name, col, lo, hi in specs]
    return (df.select(F.explode(F.array(*items)).alias("s")).where(F.col("s").isNotNull())
              .select("s.series", "s.value"))


def alert_windows(icu: DataFrame, minutes: int = 5) -> DataFrame:
    """S2 in batch form: tumbling windows per ICU unit - readings, alerts, mean HR."""
    w = F.window(F.col("timestamp"), f"{minutes} minutes")
    return (icu.groupBy(w.alias("w"), "icu_unit")
               .agg(F.count(F.lit(1)).alias("readings"), F.count_if(F.col("alert_triggered")).alias("alerts"),
                    F.avg("heart_rate").alias("mean_hr"))
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       "icu_unit", "readings", "alerts", "mean_hr"))


def latest_runs(runs: DataFrame, k: int = 5) -> DataFrame:
    """the k most recent runs (ORDER BY started_at DESC LIMIT k; ties by run id)."""
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(k)
