"""A corpus pipeline over ``documents``: each stage is one of the training-data operators.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows for the next stage, which ``run`` writes as Parquet and reads
again. Every stage works on all rows its predecessor kept. All but the last
return the columns of ``documents``.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from clinspark.llm import exact_dedup, mixing, packing, simhash, toxicity
from clinspark.llm.common import stage, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, one stays."""
    return exact_dedup.dedup(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, one stays."""
    return simhash.dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents come once, in part, or again."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and place."""
    return packing.pack(packing.pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# the learned, hashed and seeded stages have no SQL form; tests/llm holds brute-force versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
