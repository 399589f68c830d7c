"""Session construction and shared-storage helpers."""
from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the package relies on. On a cluster these usually come from the
# cluster config; ``get_session`` only fills what is unset.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Static: capturing the Python call site of every DataFrame call is a
    # debugging aid that roughly doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Sizing for a large cluster (100 TB input, ~1000 executors). Used with
# ``get_session(profile="cluster")``: applied at runtime to settings the
# cluster has not set explicitly (the retry limits only take effect when given
# at submit time, since they are read when the context starts).
CLUSTER_CONF = {
    # ~256 MB scan splits: fewer, fuller tasks; files with many row groups split well
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # start wide and let AQE coalesce to ~256 MB per reducer: no reducer
    # spills for want of partitions, small stages do not run 20k empty tasks
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    # skew: split a reducer 5x above the median and above 512 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    # broadcast only what AQE measured small after a shuffle
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # retry lost shuffle output rather than failing the job
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.task.maxFailures": "8",
}


def get_session(master: str | None = None, app: str = "clinspark",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                profile: str = "local") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if profile == "cluster":
        explicit = spark.sparkContext.getConf()
        for k, v in CLUSTER_CONF.items():
            if not explicit.contains(k):
                try:
                    spark.conf.set(k, v)
                except Exception:  # static (context-level) setting: only effective at submit time
                    pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as given. Only where the
    setting is absent and driver and executors are one process (local tests) a private
    folder is created; elsewhere executors would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master or 'a cluster'}")
        path = tempfile.mkdtemp(prefix="clinspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, shuffle files go when the query that wrote them ends, on all executors.

    Otherwise they stay until the driver happens to collect its garbage, so a job of many queries piles up
    the shuffles of all. For queries that run once each: one run again on the same plan does its shuffles
    anew. The caller's setting is put back; Spark before 4.1 takes no notice of it.
    """
    before = spark.conf.get(SHUFFLES_FREED, None)
    spark.conf.set(SHUFFLES_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_FREED)
        else:
            spark.conf.set(SHUFFLES_FREED, before)


def cut_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` as parquet under the shared checkpoint folder and read it back.

    Survives executor loss (unlike local checkpoints) and turns a long plan into
    a plain scan with known statistics.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tables", f"{name or 'stage'}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
