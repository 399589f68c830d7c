"""Tables laid out in buckets of a key, so that joins and aggregations on the key read them without an exchange.

A table is written once through Spark's bucketed writer. The files alone do not tell how they are
bucketed (a catalog does), so a small record beside them keeps the layout, and any session can read them.
Catalog entries serve to write or resolve a table and are dropped at once: nothing is left in a
shared catalog, and no entry can describe other files than its own. Every write has a folder of its own.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .sinks import TYPED_FILES

LAYOUT = "folder string, key string, buckets int, columns string, info string"


def bucket_count(spark: SparkSession) -> int:
    """As many as a shuffle has partitions: the exchange of an aggregation by the key then deals the buckets as well."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write(df: DataFrame, path: str, key: str, buckets: int | None = None, info: dict | None = None) -> DataFrame:
    """Write ``df`` in buckets of ``key`` under ``path``, replacing what was there; returns the table.

    ``info``: anything small that readers want to know of the table (``info_of``).
    """
    spark = df.sparkSession
    n = buckets or bucket_count(spark)
    name, folder = _name(), f"{path.rstrip('/')}/data-{uuid.uuid4().hex}"
    # dealt by the key first, so that a task writes one file for each bucket it holds, not one for each there is
    (df.repartition(n, key).write.options(**TYPED_FILES).bucketBy(n, key).sortBy(key).format("parquet").option("path", folder)
       .saveAsTable(name))
    columns = spark.table(name).schema.json()
    spark.sql(f"DROP TABLE {name}")  # the entry alone: a table with a path keeps its files
    spark.createDataFrame([(folder, key, n, columns, json.dumps(info or {}))], LAYOUT).coalesce(1).write.mode("overwrite").json(
        f"{path.rstrip('/')}/layout")
    return read(spark, path)


def _name() -> str:
    return f"clinspark_bucketed_{uuid.uuid4().hex}"


def _layout(spark: SparkSession, path: str):
    return spark.read.schema(LAYOUT).json(f"{path.rstrip('/')}/layout").first()  # one row


def info_of(spark: SparkSession, path: str) -> dict:
    return json.loads(_layout(spark, path)["info"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table under ``path`` with its buckets, whichever session wrote it."""
    at, name = _layout(spark, path), _name()
    schema = StructType.fromJson(json.loads(at["columns"]))
    quoted = lambda s: "`" + s.replace("`", "``") + "`"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    folder = at["folder"].replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(at['key'])}) "
              f"SORTED BY ({quoted(at['key'])}) INTO {at['buckets']} BUCKETS LOCATION '{folder}'")
    try:
        return spark.table(name)  # resolved here, files and buckets included
    finally:
        spark.sql(f"DROP TABLE {name}")
