"""FHIR-style JSON resources from silver rows, and back.

Resources are built with ``to_json(named_struct(...))`` and read with
``from_json`` against a fixed schema - no Python per row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, StringType, StructField, StructType)


def _ref(kind: str, col: str) -> Column:
    return F.when(F.col(col).isNotNull(),
                  F.struct(F.concat(F.lit(f"{kind}/"), F.col(col).cast("string")).alias("reference")))


def patient_resource(df: DataFrame) -> Column:
    return F.to_json(F.struct(
        F.lit("Patient").alias("resourceType"),
        F.col("patient_id").cast("string").alias("id"),
        F.array(F.struct(F.lit("MR").alias("type"), F.col("mrn").alias("value"))).alias("identifier"),
        F.lower("gender").alias("gender"),
        F.col("dob").cast("string").alias("birthDate"),
        F.array(F.struct(F.col("zip_code").alias("postalCode"))).alias("address")))


def encounter_resource(df: DataFrame) -> Column:
    return F.to_json(F.struct(
        F.lit("Encounter").alias("resourceType"),
        F.col("encounter_id").cast("string").alias("id"),
        F.upper("encounter_type").alias("class"),
        _ref("Patient", "patient_id").alias("subject"),
        F.struct(F.col("admit_datetime").cast("string").alias("start"),
                 F.col("discharge_datetime").cast("string").alias("end")).alias("period")))


def observation_resource(df: DataFrame) -> Column:
    """A lab result as an Observation (LOINC code, quantity, interpretation)."""
    return F.to_json(F.struct(
        F.lit("Observation").alias("resourceType"),
        F.col("lab_result_id").alias("id"),
        F.lit("final").alias("status"),
        F.struct(F.array(F.struct(F.lit("http://loinc.org").alias("system"), F.col("loinc_code").alias("code"),
                                  F.col("test_name").alias("display"))).alias("coding")).alias("code"),
        _ref("Patient", "patient_id").alias("subject"),
        _ref("Encounter", "encounter_id").alias("encounter"),
        F.struct(F.col("result_value").alias("value"), F.col("result_unit").alias("unit")).alias("valueQuantity"),
        F.array(F.struct(F.col("abnormal_flag").alias("code"))).alias("interpretation"),
        F.col("collected_datetime").cast("string").alias("effectiveDateTime")))


_REF = StructType([StructField("reference", StringType())])
OBSERVATION_SCHEMA = StructType([
    StructField("resourceType", StringType()), StructField("id", StringType()), StructField("status", StringType()),
    StructField("code", StructType([StructField("coding", ArrayType(StructType([
        StructField("system", StringType()), StructField("code", StringType()), StructField("display", StringType())])))])),
    StructField("subject", _REF), StructField("encounter", _REF),
    StructField("valueQuantity", StructType([StructField("value", DoubleType()), StructField("unit", StringType())])),
    StructField("interpretation", ArrayType(StructType([StructField("code", StringType())]))),
    StructField("effectiveDateTime", StringType()),
])


def parse_observations(resources: DataFrame, col: str = "resource") -> DataFrame:
    """Observation JSON back to flat columns."""
    o = F.from_json(F.col(col), OBSERVATION_SCHEMA).alias("o")
    return resources.select(o).select(
        F.col("o.id").alias("lab_result_id"),
        F.col("o.code.coding")[0]["code"].alias("loinc_code"),
        F.regexp_extract(F.col("o.subject.reference"), r"^Patient/(.*)$", 1).alias("patient_ref"),
        F.regexp_extract(F.col("o.encounter.reference"), r"^Encounter/(.*)$", 1).alias("encounter_ref"),
        F.col("o.valueQuantity.value").alias("result_value"),
        F.col("o.valueQuantity.unit").alias("result_unit"),
        F.col("o.interpretation")[0]["code"].alias("abnormal_flag"),
        F.col("o.effectiveDateTime").cast("timestamp_ntz").alias("collected_datetime"))


PATIENT_SCHEMA = ("resourceType string, id string, identifier array<struct<type: string, value: string>>, gender string, "
                  "birthDate string, address array<struct<postalCode: string>>")
ENCOUNTER_SCHEMA = ("resourceType string, id string, class string, subject struct<reference: string>, "
                    "period struct<start: string, end: string>")


def _key(reference: Column, kind: str) -> Column:
    """The id of a reference; NULL without one."""
    return F.when(reference.isNotNull(), F.regexp_extract(reference, f"^{kind}/(.*)$", 1))


def parse_patients(resources: DataFrame, col: str = "resource") -> DataFrame:
    """Patient JSON back to flat columns."""
    p = F.from_json(F.col(col), PATIENT_SCHEMA).alias("p")
    return resources.select(p).select(
        F.col("p.id").alias("patient_ref"), F.col("p.identifier")[0]["value"].alias("mrn"),
        F.upper("p.gender").alias("gender"), F.col("p.birthDate").cast("date").alias("dob"),
        F.col("p.address")[0]["postalCode"].alias("zip_code"))


def parse_encounters(resources: DataFrame, col: str = "resource") -> DataFrame:
    """Encounter JSON back to flat columns."""
    e = F.from_json(F.col(col), ENCOUNTER_SCHEMA).alias("e")
    return resources.select(e).select(
        F.col("e.id").alias("encounter_ref"), _key(F.col("e.subject.reference"), "Patient").alias("patient_ref"),
        F.col("e.class").alias("encounter_type"), F.col("e.period.start").cast("timestamp_ntz").alias("admit_datetime"),
        F.col("e.period.end").cast("timestamp_ntz").alias("discharge_datetime"))
