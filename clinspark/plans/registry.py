"""Registry facade used by ``__spark_entry__``."""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir


@contextmanager
def prepare(spark: SparkSession):
    """What the queries rely on in any given session: a UTC time zone while a
    plan is analysed (bucket arithmetic casts TIMESTAMP_NTZ through it; the
    zone is fixed in the plan then) and a checkpoint folder. The caller's time zone is put back."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def prepared(fn):
    def run(spark, sf_dir):
        with prepare(spark):
            return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries():
    from . import catalog, catalog_more, catalog_runs  # noqa: F401  (registers queries)
    return {k: prepared(v) for k, v in catalog.QUERIES.items()}


def oracle_sql():
    from . import catalog, catalog_more, catalog_runs  # noqa: F401
    return dict(catalog.ORACLES)
