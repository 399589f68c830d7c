"""Silver -> gold: encounter mart (C1-C5), SQL models.

Joins are plain equi left joins. Which side is broadcast is left to adaptive
execution, which converts a sort-merge join to a broadcast join only after
measuring the shuffled side below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
- a checked size, with the sort-merge join as the way beyond it. A hot key on
the left side is split by AQE's skew-join handling. Facts are pre-aggregated
per encounter before any join, so no join fans rows out.
"""
from __future__ import annotations

import datetime as _dt
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import clinical as H

Named = Callable[[str], Column]
PATIENT_ATTRS = ["patient_id", "gender", "age_years", "age_group", "insurance_type", "zip_code"]


# --------------------------------------------------- encounter-level facts --

def lab_encounter_metrics(labs: DataFrame) -> DataFrame:
    """Per encounter lab count, critical count, abnormal count (NULL key dropped)."""
    return (labs.where(F.col("encounter_id").isNotNull())
                .groupBy("encounter_id")
                .agg(F.count("lab_result_id").alias("lab_count"),
                     F.count_if(F.col("is_critical")).alias("critical_lab_count"),
                     F.count_if(F.col("result_category") == "ABNORMAL").alias("abnormal_lab_count")))


def billing_encounter_metrics(billing: DataFrame) -> DataFrame:
    """Per encounter charges, paid (all-NULL gives 0) and claim count."""
    return (billing.where(F.col("encounter_id").isNotNull())
                   .groupBy("encounter_id")
                   .agg(F.sum("charge_amount").alias("total_charges"),
                        F.coalesce(F.sum("paid_amount"), F.lit(0.0)).alias("total_paid"),
                        F.count("claim_id").alias("claim_count")))


def patient_encounter_mart(patients: DataFrame, encounters: DataFrame, labs: DataFrame,
                           billing: DataFrame, as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """Encounters + patient attributes (C1) + lab (C2) and billing (C3) metrics.

    No zero fill for unmatched encounters. When a whole fact table is empty its
    counts are 0 (charges 0.0) instead of NULL; the emptiness test is a scalar
    subquery (``EXISTS``) evaluated once, and every column is always present.
    """
    mart = (encounters
            .join(patients.select(*PATIENT_ATTRS), "patient_id", "left")
            .join(lab_encounter_metrics(labs), "encounter_id", "left")
            .join(billing_encounter_metrics(billing), "encounter_id", "left"))
    labs_empty = ~labs.select(F.lit(1)).exists()
    bill_empty = ~billing.select(F.lit(1)).exists()
    for c in ["lab_count", "critical_lab_count"]:
        mart = mart.withColumn(c, F.when(labs_empty, F.lit(0).cast("long")).otherwise(F.col(c)))
    mart = mart.withColumn("total_charges", F.when(bill_empty, F.lit(0.0)).otherwise(F.col("total_charges")))
    return (mart.withColumn("data_layer", F.lit("GOLD"))
                .withColumn("mart_created_at", H.ts_lit(as_of)))


# ---------------------------------------------------------------- models --

def stg_patients(patients: DataFrame, as_of: _dt.datetime = C.AS_OF, run_id: str = "manual") -> DataFrame:
    """B1: rename dob -> date_of_birth, casts, upper payer, audit columns."""
    return patients.select(
        "patient_id", "mrn", "gender",
        F.col("dob").cast("date").alias("date_of_birth"),
        F.col("age_years").cast("int").alias("age_years"),
        "age_group", "zip_code",
        F.upper("insurance_type").alias("insurance_type"),
        "primary_physician_id", "source_system",
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
        F.col("transformed_at").cast("timestamp_ntz").alias("transformed_at"),
        "data_layer",
        H.ts_lit(as_of).alias("dbt_loaded_at"),
        F.lit(run_id).alias("dbt_run_id"),
    )


def stg_encounters(encounters: DataFrame, as_of: _dt.datetime = C.AS_OF, beside: Sequence[str] = ()) -> DataFrame:
    """Drop NULL ids, renames, casts, upper-case codes, stay and ED flags.

    ``is_ed_visit`` reads the raw encounter_type, as the model does. Columns ``beside`` the model's are kept as they are.
    """
    return (encounters.where(F.col("encounter_id").isNotNull()).select(
        "encounter_id", "patient_id",
        F.upper("encounter_type").alias("encounter_type"),
        F.col("admit_datetime").cast("timestamp_ntz").alias("admit_datetime"),
        F.col("discharge_datetime").cast("timestamp_ntz").alias("discharge_datetime"),
        F.col("primary_diagnosis_icd10").alias("icd10_code"),
        "attending_physician_id",
        F.upper("department").alias("department"),
        "facility_id",
        F.col("los_days").cast("double").alias("los_days"),
        F.upper("los_risk").alias("los_risk"),
        "drg_code", "year_month",
        F.col("encounter_hours").cast("double").alias("encounter_hours"),
        "source_system", "data_layer",
        H.is_extended_stay("los_days").alias("is_extended_stay"),
        H.is_ed_visit("encounter_type").alias("is_ed_visit"),
        H.ts_lit(as_of).alias("dbt_loaded_at"),
        *beside,
    ))


def labs_agg(labs: DataFrame) -> DataFrame:
    """D3: per encounter (NULL key kept as a group): orders, critical, abnormal, mean TAT."""
    return labs.groupBy("encounter_id").agg(
        F.count(F.lit(1)).alias("total_lab_orders"),
        F.count_if(F.col("is_critical")).alias("critical_lab_count"),
        F.count_if(F.col("result_category") == "ABNORMAL").alias("abnormal_lab_count"),
        F.avg("tat_hours").alias("avg_lab_tat_hours"))


def billing_agg(billing: DataFrame) -> DataFrame:
    """Per encounter charges, paid (NULL as 0), claims, denied claims."""
    return billing.groupBy("encounter_id").agg(
        F.sum("charge_amount").alias("total_charges"),
        F.sum(F.coalesce(F.col("paid_amount"), F.lit(0.0))).alias("total_paid"),
        F.count(F.lit(1)).alias("claim_count"),
        F.count_if(F.col("claim_status") == "DENIED").alias("denied_claims"))


def int_patient_encounters(stg_p: DataFrame, stg_e: DataFrame, labs: DataFrame, billing: DataFrame,
                           as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """Encounters + patients + D3 + D4, zero-filled, collection rate (H24), risk.

    Risk and collection rate read the un-filled aggregates, so an encounter
    without labs cannot be HIGH or MEDIUM through lab counts.
    """
    e, p = stg_e.alias("e"), stg_p.alias("p")
    l, b = labs_agg(labs).alias("l"), billing_agg(billing).alias("b")
    j = (e.join(p, F.col("e.patient_id") == F.col("p.patient_id"), "left")
          .join(l, F.col("e.encounter_id") == F.col("l.encounter_id"), "left")
          .join(b, F.col("e.encounter_id") == F.col("b.encounter_id"), "left"))
    of = lambda side: lambda c: F.col(f"{side}.{c}")
    return j.select(*int_columns(of("e"), of("p"), of("l"), of("b"), as_of))


def int_columns(e: Named, p: Named, l: Named, b: Named, as_of: _dt.datetime) -> list[Column]:
    """C6's columns of joined rows; ``e``, ``p``, ``l`` and ``b`` give a column of the encounter, patient, lab and billing side."""
    z = lambda c, name, v=0: F.coalesce(c, F.lit(v)).alias(name)
    return [
        *[e(c) for c in ["encounter_id", "patient_id", "encounter_type", "admit_datetime", "discharge_datetime", "icd10_code",
                         "department", "facility_id", "los_days", "los_risk", "is_extended_stay", "is_ed_visit", "year_month"]],
        *[p(c) for c in ["gender", "age_years", "age_group", "insurance_type", "zip_code"]],
        *[z(l(c), c) for c in ["total_lab_orders", "critical_lab_count", "abnormal_lab_count"]],
        l("avg_lab_tat_hours"),
        *[z(b(c), c, 0.0) for c in ["total_charges", "total_paid"]],
        *[z(b(c), c) for c in ["claim_count", "denied_claims"]],
        H.collection_rate(b("total_paid"), b("total_charges")).alias("collection_rate_pct"),
        H.encounter_risk_score(e("los_days"), l("critical_lab_count"), l("abnormal_lab_count")).alias("encounter_risk_score"),
        H.ts_lit(as_of).alias("dbt_loaded_at"),
    ]


CENSUS_KEYS = ["census_date", "facility_id", "department", "encounter_type"]


def mart_daily_census(enc: DataFrame, as_of: _dt.datetime = C.AS_OF, ordered: bool = True) -> DataFrame:
    """Daily census per (date, facility, department, type).

    1. per (group, LOS value): row count and additive partial sums of every
       metric - fixed-width hash aggregation, combined map-side;
    2. beside it, the distinct encounter and patient ids of a group, together in one
       exchange, counted per group and kind;
    3. the rows of both stacked, per group: the sums, the counts, and the exact
       continuous median (D6) from cumulative counts over the group's distinct LOS values
       (a window per group over at most as many rows as distinct 2-decimal LOS values,
       never over the group's encounters - a hot group stays cheap).

    Four hash exchanges and no join; averages are sum/count of the partials.
    """
    r = F.col("encounter_risk_score")
    ins = F.col("insurance_type")
    age = F.col("age_years")
    keyed = enc.withColumn("census_date", H.calendar_date("admit_datetime"))
    level1 = keyed.groupBy(*CENSUS_KEYS, F.col("los_days").alias("_los")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("is_extended_stay")).alias("_ext"),
        F.count_if(r == "HIGH").alias("_high"), F.count_if(r == "MEDIUM").alias("_med"),
        F.count_if(r == "LOW").alias("_low"),
        F.sum("total_charges").alias("_charges"), F.sum("total_paid").alias("_paid"),
        F.sum("collection_rate_pct").alias("_cr_sum"), F.count("collection_rate_pct").alias("_cr_n"),
        F.count_if(ins == "MEDICARE").alias("_mcare"), F.count_if(ins == "MEDICAID").alias("_mcaid"),
        F.count_if(ins == "SELF_PAY").alias("_self"),
        F.sum(age).alias("_age_sum"), F.count(age).alias("_age_n"),
        F.count_if(age >= C.SENIOR_AGE).alias("_senior"))
    ids = F.explode(F.array(F.struct(F.lit(1).alias("kind"), F.col("encounter_id").cast("string").alias("id")),
                            F.struct(F.lit(2).alias("kind"), F.col("patient_id").cast("string").alias("id"))))
    distinct = (keyed.select(*CENSUS_KEYS, ids.alias("_id")).select(*CENSUS_KEYS, "_id.kind", "_id.id")
                     .where(F.col("id").isNotNull()).distinct()
                     .groupBy(*CENSUS_KEYS, F.col("kind").alias("_kind")).agg(F.count(F.lit(1)).alias("_ids")))
    stacked = level1.withColumn("_kind", F.lit(0)).unionByName(distinct, allowMissingColumns=True)
    # rank of each distinct LOS value inside its group (NULL LOS takes no rank)
    los = F.col("_los")
    known = F.when(los.isNotNull(), F.col("_rows")).otherwise(F.lit(0))
    w_cum = Window.partitionBy(*CENSUS_KEYS).orderBy("_kind", "_los").rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*CENSUS_KEYS)
    ranked = (stacked.withColumn("_cum", F.sum(known).over(w_cum))
                    .withColumn("_n", F.sum(known).over(w_all)))
    pos = (F.col("_n") - 1) / F.lit(2.0)
    first = F.col("_cum") - known               # 0-based index of the value's first copy
    covers = lambda i: los.isNotNull() & (first <= i) & (i < F.col("_cum"))
    lo_i, hi_i = F.floor(pos), F.ceil(pos)
    count = lambda k: F.coalesce(F.sum(F.when(F.col("_kind") == k, F.col("_ids"))), F.lit(0))
    metrics = ranked.groupBy(*CENSUS_KEYS).agg(
        count(1).alias("encounter_count"), count(2).alias("unique_patients"),
        (F.sum(F.when(los.isNotNull(), los * F.col("_rows"))) / F.sum(F.when(los.isNotNull(), F.col("_rows"))))
        .alias("avg_los_days"),
        F.min(F.when(covers(lo_i), los)).alias("_v_lo"), F.max(F.when(covers(hi_i), los)).alias("_v_hi"),
        F.max(pos).alias("_pos"),
        F.max(los).alias("max_los_days"),
        F.sum("_ext").alias("extended_stay_count"),
        F.sum("_high").alias("high_risk_count"), F.sum("_med").alias("medium_risk_count"),
        F.sum("_low").alias("low_risk_count"),
        F.sum("_charges").alias("total_charges"), F.sum("_paid").alias("total_paid"),
        (F.sum("_cr_sum") / F.sum("_cr_n")).alias("avg_collection_rate"),
        F.sum("_mcare").alias("medicare_count"), F.sum("_mcaid").alias("medicaid_count"),
        F.sum("_self").alias("self_pay_count"),
        (F.sum("_age_sum") / F.sum("_age_n")).alias("avg_patient_age"),
        F.sum("_senior").alias("senior_patient_count"))
    median = F.col("_v_lo") + (F.col("_v_hi") - F.col("_v_lo")) * (F.col("_pos") - F.floor(F.col("_pos")))
    out = metrics.withColumn("median_los_days", median).select(
        *CENSUS_KEYS, "encounter_count", "unique_patients", "avg_los_days", "median_los_days", "max_los_days",
        "extended_stay_count", "high_risk_count", "medium_risk_count", "low_risk_count", "total_charges", "total_paid",
        "avg_collection_rate", "medicare_count", "medicaid_count", "self_pay_count", "avg_patient_age",
        "senior_patient_count", H.ts_lit(as_of).alias("dbt_loaded_at"))
    if ordered:
        out = out.orderBy(F.col("census_date").desc(), "facility_id", "department")
    return out
