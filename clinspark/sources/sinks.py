"""Sinks: table load (A4-A6), counts (A7), upsert by key (A9), layers (A10), reports."""
from __future__ import annotations

import os
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, TimestampNTZType, TimestampType, DateType

from ..functions.clinical import blank_nulls
from ..operators.windows import keep_last
from ..schemas import conform

LAYERS = ["RAW", "STAGING", "INTERMEDIATE", "MARTS"]

# Encoding of loaded files. Their columns are mostly text, whose lookups in a column's dictionary are a fifth of a load's
# processor time; zstd takes repeated values out as well, and better.
LOAD_FILES = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.enable.dictionary": "false"}

# Encoding of typed tables, staged and built: as differences where a dictionary does not pay (ids, times), in half the bytes
# of Spark's defaults at the same processor time.
TYPED_FILES = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def load_format(df: DataFrame, blank: bool = False) -> DataFrame:
    """A5 (+A6 when ``blank``): times and dates to text, booleans to 0/1, and
    optionally NULL text as ''. Driven by the frame's schema."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType, DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, BooleanType):
            c = c.cast("int")
        if blank and isinstance(f.dataType, (StringType, TimestampType, TimestampNTZType, DateType)):
            c = blank_nulls(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load(df: DataFrame, target: str, mode: str = "append", schema=None, blank: bool = False,
         path: str | None = None, partition_by: list[str] | None = None, as_text: bool = True,
         cluster_by: list[str] | None = None) -> int:
    """A4: write ``df`` to a catalog table (or a parquet path); returns rows written.

    ``mode`` is 'append' or 'replace'. ``as_text`` applies the warehouse load
    format (A5/A6); typed staging tables pass False. The row count comes from
    an ``Observation`` on the write itself, so the data is read once. An empty
    frame returns 0; replacing with it leaves an empty table with the columns,
    so that readers of the path find no rows rather than no table.
    """
    out = conform(df, schema) if schema is not None else df
    return load_measured(load_format(out, blank) if as_text else out, target, mode, path, partition_by, cluster_by,
                         options=LOAD_FILES if path and as_text else None)["rows"]


def load_measured(df: DataFrame, target: str, mode: str = "append", path: str | None = None,
                  partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
                  metrics: Mapping[str, Column] | None = None, without: Sequence[str] = (),
                  options: Mapping[str, str] | None = None) -> dict:
    """Write ``df`` as it is and return its rows and ``metrics`` (aggregates), observed on the write: no second read.

    They are observed in the writing stage, whose tasks count once however often they are tried. ``without`` names
    columns that only the metrics need, ``options`` are the writer's.
    """
    out = df
    if partition_by:
        # Range-cluster on the partition columns (plus a spread key) first:
        # each task then writes one or two partition folders instead of one
        # file per folder it happens to hold, and a hot partition value is
        # split over several tasks rather than hashed onto one.
        out = out.repartitionByRange(*partition_by, *(cluster_by or []))
    # observed after the exchange: the range sampler's job does not count rows
    obs = Observation(f"load_{target}")
    names = list(metrics or {})
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), *[metrics[n].alias(f"m{i}") for i, n in enumerate(names)]).drop(*without)
    writer = out.write.options(**(options or {})).mode("overwrite" if mode == "replace" else mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer.parquet(path)
    else:
        writer.saveAsTable(target)
    got = obs.get
    rows = int(got["rows"])
    if rows == 0 and path and partition_by and mode == "replace":
        # a partitioned write of no rows leaves no file that holds the columns
        df.sparkSession.createDataFrame([], out.schema).coalesce(1).write.mode("overwrite").parquet(path)
    return {n: got[f"m{i}"] for i, n in enumerate(names)} | {"rows": rows}


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every frame: one count each, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def upsert_by_key(spark: SparkSession, rows: DataFrame, path: str, key: list[str]) -> DataFrame:
    """INSERT OR REPLACE by ``key`` into the parquet table at ``path``.

    The table has a folder per key (meant for keys like a run id, of which a
    write holds few); a write replaces the folders of its own keys and touches
    no other, so it never reads, rewrites or loses older rows, whatever state they
    are in, and two runs at once do not meet. Of rows that repeat a key the
    greatest by the other columns stays.
    """
    rest = [c for c in rows.columns if c not in key]
    # a folder's name holds the key with a mark, so that a NULL and an empty key are told apart
    last = keep_last(rows, key, rest).withColumns(
        {f"_{c}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in key})
    (last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*[f"_{c}" for c in key]).parquet(path))
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def materialize(df: DataFrame, name: str, layer: str, as_view: bool = False, path: str | None = None) -> DataFrame:
    """A10: staging models become views, intermediate and mart models tables."""
    if layer not in LAYERS:
        raise ValueError(layer)
    if as_view:
        df.createOrReplaceTempView(name)
        return df
    if path:
        df.write.options(**TYPED_FILES).mode("overwrite").parquet(os.path.join(path, layer.lower(), name))
        return df.sparkSession.read.parquet(os.path.join(path, layer.lower(), name))
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def publish(spark: SparkSession, database: str, tables: Mapping[str, str], home: str) -> None:
    """A10: the tables (name -> folder) under their names in a database of the catalog.

    A name is a view of the folder, replaced as a whole: readers find the table as it was or as it is,
    never none, and queries that began on the former folder go on with it. A database that does
    not exist is created at ``home``.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    whole = lambda p: path(p).getFileSystem(conf).makeQualified(path(p)).toString()
    quoted = lambda s: "`" + s.replace("`", "``") + "`"
    if not spark.catalog.databaseExists(database):
        at = whole(home).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION '{at}'")
    for name, folder in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)} AS SELECT * FROM parquet.{quoted(whole(folder))}")


def write_json_report(df: DataFrame, path: str) -> None:
    """A small report frame as one JSON-lines file (bounded size: one row per check/source)."""
    df.coalesce(1).write.mode("overwrite").json(path)
