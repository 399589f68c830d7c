"""C1-C3, C5, C6 over staged tables in buckets of ``encounter_id``: models are built without an exchange of facts.

``stage`` does the shuffling once for all models: encounters get their patient's attributes (C1) and
are dealt by encounter; labs and billing are summed per encounter before they are dealt,
combined map-side. A fact table therefore comes to one row per encounter, and an
encounter with a third of all labs to one row like any other. The mart (C5), the intermediate
model (C6) and any later model then join bucket by bucket.

Rows without an encounter id match nothing: those of facts are left out, encounters without
one are kept in a plain table beside the buckets (all of them would be one bucket) and stacked onto the mart.
Encounter ids are unique by declaration (Q13 tests it); rows that repeat one are kept, and read by one task.
"""
from __future__ import annotations

import datetime as _dt
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import clinical as H
from ..sources import buckets
from . import gold

KEY = "encounter_id"


@dataclass
class Staged:
    """The staged tables; ``encounters``, ``labs`` and ``billing`` in buckets of the encounter, ``unkeyed`` encounters apart."""
    encounters: DataFrame
    unkeyed: DataFrame
    labs: DataFrame
    billing: DataFrame
    labs_empty: bool
    billing_empty: bool


def encounter_base(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    """Encounters with their patient's attributes."""
    return encounters.join(patients.select(*gold.PATIENT_ATTRS), "patient_id", "left")


def lab_totals(labs: DataFrame) -> DataFrame:
    """D1 and D3 together, per encounter."""
    return labs.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.count("lab_result_id").alias("lab_count"), F.count(F.lit(1)).alias("total_lab_orders"),
        F.count_if(F.col("is_critical")).alias("critical_lab_count"),
        F.count_if(F.col("result_category") == "ABNORMAL").alias("abnormal_lab_count"),
        F.avg("tat_hours").alias("avg_lab_tat_hours"))


def billing_totals(billing: DataFrame) -> DataFrame:
    """D2 and D4 together, per encounter."""
    return billing.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.sum("charge_amount").alias("total_charges"), F.coalesce(F.sum("paid_amount"), F.lit(0.0)).alias("total_paid"),
        F.count("claim_id").alias("claim_count"), F.count(F.lit(1)).alias("claim_rows"),
        F.count_if(F.col("claim_status") == "DENIED").alias("denied_claims"))


def stage(patients: DataFrame, encounters: DataFrame, labs: DataFrame, billing: DataFrame, path: str,
          count: int | None = None) -> Staged:
    """Write the staged tables under ``path``; all of them get the same number of buckets."""
    spark = encounters.sparkSession
    base = encounter_base(patients, encounters)

    def unkeyed():
        base.where(F.col(KEY).isNull()).write.mode("overwrite").parquet(os.path.join(path, "unkeyed"))

    def fact(name: str, rows: DataFrame, totals: DataFrame):
        buckets.write(totals, os.path.join(path, name), KEY, count, {"empty": rows.isEmpty()})

    jobs = [unkeyed,
            lambda: buckets.write(base.where(F.col(KEY).isNotNull()), os.path.join(path, "encounters"), KEY, count),
            lambda: fact("labs", labs, lab_totals(labs)), lambda: fact("billing", billing, billing_totals(billing))]
    with ThreadPoolExecutor(len(jobs)) as pool:  # independent writes are submitted together
        for done in [pool.submit(job) for job in jobs]:
            done.result()
    return open_staged(spark, path)


def open_staged(spark: SparkSession, path: str) -> Staged:
    """The tables that ``stage`` wrote under ``path``, in any session."""
    at = {n: os.path.join(path, n) for n in ("encounters", "unkeyed", "labs", "billing")}
    return Staged(buckets.read(spark, at["encounters"]), spark.read.parquet(at["unkeyed"]), buckets.read(spark, at["labs"]),
                  buckets.read(spark, at["billing"]), buckets.info_of(spark, at["labs"])["empty"],
                  buckets.info_of(spark, at["billing"])["empty"])


def patient_encounter_mart(staged: Staged, as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """C5 as ``gold.patient_encounter_mart`` gives it."""
    labs = staged.labs.select(KEY, "lab_count", "critical_lab_count", "abnormal_lab_count")
    billing = staged.billing.select(KEY, "total_charges", "total_paid", "claim_count")
    joined = staged.encounters.join(labs, KEY, "left").join(billing, KEY, "left")
    mart = joined.unionByName(staged.unkeyed, allowMissingColumns=True)
    if staged.labs_empty:
        mart = mart.withColumns({c: F.lit(0).cast("long") for c in ("lab_count", "critical_lab_count")})
    if staged.billing_empty:
        mart = mart.withColumn("total_charges", F.lit(0.0))
    return mart.withColumn("data_layer", F.lit("GOLD")).withColumn("mart_created_at", H.ts_lit(as_of))


def int_patient_encounters(staged: Staged, as_of: _dt.datetime = C.AS_OF) -> DataFrame:
    """C6 as ``gold.int_patient_encounters`` gives it over the staging models."""
    attrs = [c for c in gold.PATIENT_ATTRS if c != "patient_id"]
    e = gold.stg_encounters(staged.encounters, as_of, attrs)
    joined = (e.join(staged.labs, KEY, "left").join(staged.billing.withColumnRenamed("claim_count", "claim_ids"), KEY, "left")
               .withColumnRenamed("claim_rows", "claim_count"))
    patient = {"age_years": F.col("age_years").cast("int"), "insurance_type": F.upper("insurance_type")}  # as B1 has them
    return joined.select(*gold.int_columns(F.col, lambda c: patient.get(c, F.col(c)).alias(c), F.col, F.col, as_of))
