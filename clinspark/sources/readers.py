"""A1-A3: source readers by configured format, always with a declared schema.

``read_source(spark, spec)`` reads one source description:

* ``json``  - one record per line, or nested arrays flattened with
  ``explode`` (``spec["explode"] = "field"``). A malformed line stays as a row of
  NULLs with its text in ``_corrupt_record``, and a record with an empty array as
  a row of NULLs, so a quality check can count them.
* ``csv``   - header line, declared schema, no inference; ``_corrupt_record`` likewise.
* ``table`` - a table or view of the session's catalog.
* ``jdbc``  - a table or query; with ``partition_column`` and bounds the read
  is split into ``num_partitions`` parallel range queries.
* ``parquet`` - columnar files (pruning and pushdown apply).
"""
from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CORRUPT = "_corrupt_record"


def read_source(spark: SparkSession, spec: dict[str, Any]) -> DataFrame:
    fmt = spec["format"]
    schema = spec.get("schema")
    if fmt == "jdbc":
        reader = (spark.read.format("jdbc").option("url", spec["url"])
                  .option("dbtable", spec["table"]))
        if spec.get("driver"):
            reader = reader.option("driver", spec["driver"])
        if spec.get("partition_column"):
            reader = (reader.option("partitionColumn", spec["partition_column"])
                      .option("lowerBound", spec["lower_bound"]).option("upperBound", spec["upper_bound"])
                      .option("numPartitions", spec.get("num_partitions", 8)))
        if spec.get("fetch_size"):
            reader = reader.option("fetchsize", spec["fetch_size"])
        df = reader.load()
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _struct(spark, schema).fields])
        return df
    if fmt == "table":
        df = spark.table(spec["table"])
        return df if schema is None else df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in _struct(spark, schema).fields])
    if schema is None:
        raise ValueError("file sources need a declared schema")
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(spec["path"])
    reader = (spark.read.schema(_struct(spark, schema).add(CORRUPT, "string"))
              .option("columnNameOfCorruptRecord", CORRUPT))
    if fmt == "json":
        df = reader.option("mode", "PERMISSIVE").json(spec["path"])
        if spec.get("explode"):
            df = df.select(F.explode_outer(F.col(spec["explode"])).alias("_r"), CORRUPT).select("_r.*", CORRUPT)
        return df
    if fmt == "csv":
        return (reader.option("header", spec.get("header", True)).option("mode", "PERMISSIVE")
                .option("timestampNTZFormat", spec.get("timestamp_format", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))
                .csv(spec["path"]))
    raise ValueError(f"unknown format {fmt}")


def _struct(spark: SparkSession, schema):
    if isinstance(schema, str):
        return spark.createDataFrame([], schema).schema
    return schema
