"""Bronze -> silver transforms (P1-P4) and per-table transform stats."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import clinical as H
from .windows import keep_last, rolling_mean_rows, rolling_mean_time


def _lineage(df: DataFrame, as_of, layer: str = "SILVER") -> DataFrame:
    """Audit columns; the time is the run's ``as_of``, not the wall clock."""
    return df.withColumns({"transformed_at": H.ts_lit(as_of), "data_layer": F.lit(layer)})


def transform_patients(raw: DataFrame, as_of: _dt.datetime = C.AS_OF, copies: str | None = None) -> DataFrame:
    """Gender recode (B6), age (H4), age group (H5), keep last record per MRN (E2); ``copies``: see ``keep_last``.

    The shown MRN is a short mask of which some collide among very many patients; where the extract
    carries the whole digest (``mrn_digest``), that is the key.
    """
    age = H.age_years(F.col("dob").cast("date"), H.ts_lit(as_of))
    df = raw.withColumns({"gender": H.recode_gender("gender"), "dob": F.col("dob").cast("date"),
                          "age_years": age, "age_group": H.age_bucket(age)})
    key = "mrn_digest" if "mrn_digest" in raw.columns else "mrn"
    df = keep_last(df, [key], ["extracted_at", "patient_id"], copies).drop("mrn_digest")
    return _lineage(df, as_of)


def transform_encounters(raw: DataFrame, as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """LOS (H8), LOS risk (H11), year-month (H12), encounter hours (H9)."""
    los = H.los_days("admit_datetime", "discharge_datetime", "los_days")
    df = raw.withColumns({"los_days": los, "los_risk": H.los_risk(los),
                          "year_month": H.year_month("admit_datetime"),
                          "encounter_hours": H.elapsed_hours("admit_datetime", "discharge_datetime")})
    return _lineage(df, as_of)


def transform_labs(raw: DataFrame, as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """Turnaround (H9), critical flag and category (B7, B8), outlier clip."""
    df = raw.withColumns({
        "tat_hours": H.elapsed_hours("collected_datetime", "resulted_datetime"),
        "is_critical": H.is_critical_lab("abnormal_flag"),
        "result_category": H.result_category("abnormal_flag"),
        "result_value": H.clip_outlier("result_value", "reference_range_low", "reference_range_high")})
    return _lineage(df, as_of)


ICU_ORDER = ["timestamp", "vital_id"]


def icu_measures(rows: DataFrame, as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """P4 but for the rolling mean: MAP (H15), status (H16) and lineage; row by row, so for streams as well."""
    df = rows.withColumns({"map_calculated": H.mean_arterial_pressure("systolic_bp", "diastolic_bp"),
                           "vitals_status": H.vitals_status("spo2", "alert_triggered")})
    return _lineage(df, as_of)


def icu_rolling(rows: DataFrame) -> DataFrame:
    """P4's rolling heart rate over the last 10 readings of a patient."""
    df = rolling_mean_rows(rows, "patient_id", ICU_ORDER, "heart_rate", C.ROLLING_ROWS, "_hr_avg")
    return df.withColumn("hr_rolling_avg", H.round_half_up("_hr_avg", 1)).drop("_hr_avg")


def transform_icu_vitals(raw: DataFrame, as_of: _dt.datetime = C.AS_OF, rolling: bool = True) -> DataFrame:
    """Rolling heart rate (E1), MAP (H15), status.

    The rolling mean numbers all rows, which writes them once; readers of other columns leave it out.
    """
    return icu_measures(icu_rolling(raw) if rolling else raw, as_of)


def hr_rolling_5min(vitals: DataFrame, minutes: int = 5) -> DataFrame:
    """Time-based rolling mean of heart rate over the preceding 5 minutes; readings of no known patient are one group, as in its SQL."""
    out = rolling_mean_time(vitals.select("vital_id", "patient_id", "timestamp", "heart_rate"),
                            "patient_id", "timestamp", "heart_rate", minutes, "_hr5", null_key=True)
    return out.withColumn("hr_avg_5min", H.round_half_up("_hr5", 1)).drop("_hr5")


SILVER = {
    "patients": transform_patients,
    "encounters": transform_encounters,
    "labs": transform_labs,
    "icu_vitals": transform_icu_vitals,
}


def to_silver(name: str, raw: DataFrame, as_of: _dt.datetime = C.AS_OF, rolling: bool = True) -> DataFrame:
    """Silver table for any source; sources without a transform only get lineage."""
    if name == "icu_vitals":
        return transform_icu_vitals(raw, as_of, rolling)
    fn = SILVER.get(name)
    return fn(raw, as_of) if fn else _lineage(raw, as_of)


def stats_metrics(table: str, copies: str | None = None) -> dict[str, object]:
    """D12 as aggregates of the silver rows, for an aggregation or to be observed on their write.

    Rows read are rows written, but where a transform drops some: ``copies`` then names the column that counts them.
    """
    rows = F.count(F.lit(1))
    found = {"input": F.coalesce(F.sum(copies), F.lit(0)) if copies else rows, "output": rows}
    if table == "labs":
        found["critical_values"] = F.count_if(F.col("is_critical"))
        found["abnormal_pct"] = H.round_half_up(
            F.avg((F.col("result_category") == "ABNORMAL").cast("double")) * 100, 1)
    if table == "icu_vitals":
        found["alerts_triggered"] = F.count_if(F.col("alert_triggered"))
        found["alert_rate_pct"] = H.round_half_up(F.avg(F.col("alert_triggered").cast("double")) * 100, 2)
    if table == "patients":
        found["dupes_removed"] = found["input"] - found["output"]
    return {k: v.cast("double") for k, v in found.items()}


def transform_stats(table: str, silver: DataFrame, copies: str | None = None) -> DataFrame:
    """(table, metric, value) rows - input/output counts, dupes removed, and per-table measures (critical labs,
    abnormal %, ICU alerts and alert rate), from one aggregation of the silver rows."""
    cols = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in stats_metrics(table, copies).items()]
    return (silver.agg(F.array(*cols).alias("_m"))
                  .select(F.lit(table).alias("table"), F.explode("_m").alias("_r")).select("table", "_r.metric", "_r.value"))
