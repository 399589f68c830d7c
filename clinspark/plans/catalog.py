"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracles.

Every query reads the driver's tables through the bronze views, over whole
tables. Output doubles are rounded half-up (6 places unless stated) so the
Spark result and the oracle agree independent of summation order.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import clinical as H
from ..operators import gold, silver
from ..sources import testdata as T
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _decimal_round(c, digits: int):
    """Output rounding as the oracles do it: through DECIMAL, so that engines agree."""
    return F.round(c.cast("decimal(38,9)"), digits).cast("double")


def stable(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(_decimal_round(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


class Tables:
    """Lazily built bronze/silver/model frames of one sf_dir (built once per query)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        key = "raw_" + name
        if key not in self._cache:
            self._cache[key] = T.bronze(self.spark, self.sf_dir, name)
        return self._cache[key]

    def silver(self, name: str) -> DataFrame:
        """A silver table; ICU vitals without the rolling mean, which no other query reads."""
        if name not in self._cache:
            self._cache[name] = silver.to_silver(name, self.raw(name), rolling=False)
        return self._cache[name]

    def int_patient_encounters(self) -> DataFrame:
        if "int" not in self._cache:
            self._cache["int"] = gold.int_patient_encounters(
                gold.stg_patients(self.silver("patients")), gold.stg_encounters(self.silver("encounters")),
                self.silver("labs"), self.silver("billing"))
        return self._cache["int"]

    def int_table(self) -> DataFrame:
        """The intermediate model materialised as a table (as the model declares),
        written once under the shared checkpoint folder. Queries that read it
        more than once (the census reads it in two aggregations) then scan
        parquet instead of recomputing four sources and three joins."""
        if "int_table" not in self._cache:
            from ..session import cut_lineage
            self._cache["int_table"] = cut_lineage(self.int_patient_encounters(), "int_patient_encounters")
        return self._cache["int_table"]


def _doubles_sql(sql: str, cols: list[str], digits: int = 6, overrides: dict[str, int] | None = None) -> str:
    d = {c: digits for c in cols}
    d.update(overrides or {})
    return O.stable(sql, d)


# ------------------------------------------------------------- bronze (A1) --

_RAW_DOUBLES = {
    "patients": [],
    "encounters": ["los_days"],
    "labs": ["result_value", "reference_range_low", "reference_range_high"],
    "billing": ["charge_amount", "allowed_amount", "paid_amount"],
    "icu_vitals": ["heart_rate", "systolic_bp", "diastolic_bp", "mean_arterial_pressure", "spo2",
                   "respiratory_rate", "temperature_celsius", "etco2"],
    "medications": ["quantity_dispensed"],
    "radiology": ["tat_hours"],
    "staff": [],
    "appointments": [],
}

for _name, _dbl in _RAW_DOUBLES.items():
    def _mk(name):
        def q(spark, sf_dir):
            return stable(T.bronze(spark, sf_dir, name).drop("mrn_digest"))
        return q
    register(f"raw_{_name}", _doubles_sql(O.with_views(f"SELECT * FROM raw_{_name}", f"raw_{_name}"), _dbl))(_mk(_name))


@register("table_counts", " UNION ALL ".join(
    "SELECT * FROM (" + O.with_views(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM raw_{n}",
                                     f"raw_{n}") + ")"
    for n in T.SOURCES))
def table_counts(spark, sf_dir):
    """Row count of every raw clinical table."""
    from ..sources.sinks import table_counts as counts
    t = Tables(spark, sf_dir)
    return counts({n: t.raw(n) for n in T.SOURCES})


# ------------------------------------------------------------- silver (P*) --

_SILVER_DOUBLES = {
    "patients": [],
    "encounters": ["los_days", "encounter_hours"],
    "labs": ["result_value", "reference_range_low", "reference_range_high", "tat_hours"],
    "icu_vitals": _RAW_DOUBLES["icu_vitals"] + ["hr_rolling_avg", "map_calculated"],
}

for _name, _dbl in _SILVER_DOUBLES.items():
    def _mk2(name):
        def q(spark, sf_dir):
            return stable(silver.to_silver(name, Tables(spark, sf_dir).raw(name)))
        return q
    register(f"silver_{_name}", _doubles_sql(O.with_views(f"SELECT * FROM {_name}", _name), _dbl))(_mk2(_name))


@register("hr_rolling_5min", _doubles_sql(O.with_views(
    "SELECT vital_id, patient_id, \"timestamp\", heart_rate, "
    + O.rnd('avg(heart_rate) OVER (PARTITION BY patient_id ORDER BY "timestamp" '
            'RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW)', 1)
    + " AS hr_avg_5min FROM icu_vitals", "icu_vitals"), ["heart_rate", "hr_avg_5min"]))
def hr_rolling_5min(spark, sf_dir):
    """5-minute time-range rolling heart rate per patient."""
    return stable(silver.hr_rolling_5min(Tables(spark, sf_dir).silver("icu_vitals")))


# --------------------------------------------------------------- gold (C*) --

@register("lab_encounter_metrics", O.with_views(
    "SELECT encounter_id, COUNT(lab_result_id) AS lab_count, "
    "COUNT(*) FILTER (WHERE is_critical) AS critical_lab_count, "
    "COUNT(*) FILTER (WHERE result_category = 'ABNORMAL') AS abnormal_lab_count "
    "FROM labs WHERE encounter_id IS NOT NULL GROUP BY 1", "labs"))
def lab_encounter_metrics(spark, sf_dir):
    """D1."""
    return gold.lab_encounter_metrics(Tables(spark, sf_dir).silver("labs"))


@register("billing_encounter_metrics", _doubles_sql(O.with_views(
    "SELECT encounter_id, SUM(charge_amount) AS total_charges, "
    "COALESCE(SUM(paid_amount), 0.0) AS total_paid, COUNT(claim_id) AS claim_count "
    "FROM billing WHERE encounter_id IS NOT NULL GROUP BY 1", "billing"), ["total_charges", "total_paid"]))
def billing_encounter_metrics(spark, sf_dir):
    """D2."""
    return stable(gold.billing_encounter_metrics(Tables(spark, sf_dir).silver("billing")))


_MART_SQL = O.with_views(f"""SELECT e.*, p.gender, p.age_years, p.age_group, p.insurance_type, p.zip_code,
  l.lab_count, l.critical_lab_count, l.abnormal_lab_count,
  b.total_charges, b.total_paid, b.claim_count,
  'GOLD' AS data_layer_gold, {O.AS_OF} AS mart_created_at
FROM encounters e
LEFT JOIN (SELECT patient_id, gender, age_years, age_group, insurance_type, zip_code FROM patients) p
  ON e.patient_id = p.patient_id
LEFT JOIN (SELECT encounter_id, COUNT(lab_result_id) AS lab_count,
             COUNT(*) FILTER (WHERE is_critical) AS critical_lab_count,
             COUNT(*) FILTER (WHERE result_category = 'ABNORMAL') AS abnormal_lab_count
           FROM labs WHERE encounter_id IS NOT NULL GROUP BY 1) l ON e.encounter_id = l.encounter_id
LEFT JOIN (SELECT encounter_id, SUM(charge_amount) AS total_charges,
             COALESCE(SUM(paid_amount), 0.0) AS total_paid, COUNT(claim_id) AS claim_count
           FROM billing WHERE encounter_id IS NOT NULL GROUP BY 1) b ON e.encounter_id = b.encounter_id""",
                         "patients", "encounters", "labs", "billing")
_MART_SQL = ("SELECT * EXCLUDE (data_layer, data_layer_gold), data_layer_gold AS data_layer FROM ("
             + _MART_SQL + ") m")


@register("patient_encounter_mart", _doubles_sql(
    _MART_SQL, ["los_days", "encounter_hours", "total_charges", "total_paid"]))
def patient_encounter_mart(spark, sf_dir):
    """C5 (C1 + C2 + C3): the gold patient-encounter mart."""
    t = Tables(spark, sf_dir)
    return stable(gold.patient_encounter_mart(t.silver("patients"), t.silver("encounters"),
                                              t.silver("labs"), t.silver("billing")))


@register("orphan_billing_patients", O.with_views(
    "SELECT COUNT(*) AS orphan_rows, COUNT(DISTINCT b.patient_id) AS orphan_keys "
    "FROM billing b WHERE b.patient_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM patients p WHERE p.patient_id = b.patient_id)", "billing", "patients"))
def orphan_billing_patients(spark, sf_dir):
    """C4: billing rows whose patient is unknown (anti join on pre-aggregated keys)."""
    from .. operators.quality import orphans
    t = Tables(spark, sf_dir)
    o = orphans(t.silver("billing"), "patient_id", t.silver("patients"), "patient_id", allow_null=True)
    return o.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphan_rows"),
                 F.count(F.lit(1)).alias("orphan_keys"))


@register("stg_patients", O.with_views("SELECT * FROM stg_patients", "stg_patients"))
def stg_patients(spark, sf_dir):
    """B1."""
    return gold.stg_patients(Tables(spark, sf_dir).silver("patients"))


@register("stg_encounters", _doubles_sql(O.with_views("SELECT * FROM stg_encounters", "stg_encounters"),
                                         ["los_days", "encounter_hours"]))
def stg_encounters(spark, sf_dir):
    """B2, B3."""
    return stable(gold.stg_encounters(Tables(spark, sf_dir).silver("encounters")))


@register("labs_agg", _doubles_sql(O.with_views("SELECT * FROM labs_agg", "labs_agg"), ["avg_lab_tat_hours"]))
def labs_agg(spark, sf_dir):
    """D3."""
    return stable(gold.labs_agg(Tables(spark, sf_dir).silver("labs")))


@register("billing_agg", _doubles_sql(O.with_views("SELECT * FROM billing_agg", "billing_agg"),
                                      ["total_charges", "total_paid"]))
def billing_agg(spark, sf_dir):
    """D4."""
    return stable(gold.billing_agg(Tables(spark, sf_dir).silver("billing")))


_INT_DOUBLES = ["los_days", "avg_lab_tat_hours", "total_charges", "total_paid", "collection_rate_pct"]


@register("int_patient_encounters", _doubles_sql(
    O.with_views("SELECT * FROM int_patient_encounters", "int_patient_encounters"), _INT_DOUBLES))
def int_patient_encounters(spark, sf_dir):
    """C6 with H24 collection rate and H25 risk score."""
    return stable(Tables(spark, sf_dir).int_patient_encounters())


_CENSUS_DOUBLES = ["avg_los_days", "median_los_days", "max_los_days", "total_charges", "total_paid",
                   "avg_collection_rate", "avg_patient_age"]


@register("mart_daily_census", _doubles_sql(
    O.with_views("SELECT * FROM mart_daily_census", "mart_daily_census"), _CENSUS_DOUBLES))
def mart_daily_census(spark, sf_dir):
    """D5 + D6 (exact median) + F2 (ordered): the flagship query."""
    return stable(gold.mart_daily_census(Tables(spark, sf_dir).int_patient_encounters()))
