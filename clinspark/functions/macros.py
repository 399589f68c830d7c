"""The SQL macros as session SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``).

Each is a SQL expression the optimizer inlines - no Python runs per row. The
Python counterparts in ``clinical`` return the same Columns for DataFrame code.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from .. import config as C

MACROS = {
    "age_group": ("age INT", "STRING",
                  "CASE WHEN age BETWEEN 0 AND 17 THEN '0-17' WHEN age BETWEEN 18 AND 34 THEN '18-34' "
                  "WHEN age BETWEEN 35 AND 49 THEN '35-49' WHEN age BETWEEN 50 AND 64 THEN '50-64' "
                  "WHEN age BETWEEN 65 AND 79 THEN '65-79' WHEN age >= 80 THEN '80+' ELSE 'UNKNOWN' END"),
    "los_risk": ("los DOUBLE", "STRING",
                 f"CASE WHEN los > {C.LOS_CRITICAL_DAYS} THEN 'CRITICAL' "
                 f"WHEN los > {C.LOS_EXTENDED_DAYS} THEN 'EXTENDED' ELSE 'NORMAL' END"),
    "encounter_risk_score": ("los DOUBLE, critical BIGINT, abnormal BIGINT", "STRING",
                             "CASE WHEN los > 14 AND critical > 0 THEN 'HIGH' "
                             "WHEN los > 7 OR abnormal > 3 THEN 'MEDIUM' ELSE 'LOW' END"),
    "collection_rate": ("paid DOUBLE, charge DOUBLE", "DOUBLE",
                        "CASE WHEN charge > 0 THEN CAST(ROUND(CAST(paid / charge * 100 AS DECIMAL(38,9)), 2) "
                        "AS DOUBLE) ELSE NULL END"),
    "is_critical_lab": ("flag STRING", "BOOLEAN", "CASE WHEN flag IN ('HH', 'LL') THEN TRUE ELSE FALSE END"),
    "date_diff_hours": ("start_ts TIMESTAMP_NTZ, end_ts TIMESTAMP_NTZ", "BIGINT",
                        "timestampdiff(HOUR, date_trunc('HOUR', start_ts), date_trunc('HOUR', end_ts))"),
    "mask_phi": ("value STRING", "STRING", f"'{C.PHI_MASK}'"),
    "generate_surrogate_key": ("a STRING, b STRING, c STRING", "STRING",
                               "md5(concat_ws('|', coalesce(a, '_null_'), coalesce(b, '_null_'), "
                               "coalesce(c, '_null_')))"),
}


def register_sql_macros(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the macros functions of the session, under their names behind ``prefix``."""
    for name, (args, ret, body) in MACROS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({args}) RETURNS {ret} RETURN {body}")
    return [prefix + name for name in MACROS]


def drop_sql_macros(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
