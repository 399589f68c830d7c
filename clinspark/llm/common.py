"""Helpers shared by the training-data operators."""
from __future__ import annotations

import gc
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

WHITESPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    The written table survives lost executors and cuts the lineage. Shuffle
    files of the finished job are dropped at once: Spark's cleaner removes
    them when the driver's objects are collected, which otherwise may take
    longer than the next job needs to fill the disks.
    """
    out = cut_lineage(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def text_or_empty(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_hash() -> Column:
    """Tells apart rows that share a doc_id; never decides that texts are equal."""
    return F.xxhash64(text_or_empty())


def keyed(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``, whatever their names), doc_id, th and text."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", text_hash().alias("th"), "text")


def same_key() -> Column:
    """Joins ``keyed`` rows to rows keyed by _d and _t."""
    return F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))


def with_texts(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """``keyed`` rows with the columns of ``docs``, their text and, where it exists, n_chars made anew."""
    made = rows.withColumn("made", text)
    cols = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("made")}
    if "n_chars" in cols:
        length = F.length("made").cast(docs.schema["n_chars"].dataType)
        cols["n_chars"] = F.when(F.col("made").eqNullSafe(F.col("row.text")), cols["n_chars"]).otherwise(length)
    return made.select(*[v.alias(c) for c, v in cols.items()])


def word_count(text: Column | str = "text") -> Column:
    """Number of maximal runs of characters that are not ASCII white space (null: 0)."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def ranked(df: DataFrame, keys: Sequence[str], name: str, out: str = "rank", bounds: Sequence[Column] = ()) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of ``keys``, without one task holding all of them.

    ``bounds`` are shorter values in the same order to deal the rows by, where
    the keys are long: Spark samples these on the driver.

    Rows are range-partitioned and sorted, so partition number and place in
    the partition give the order; the offsets are sums over one row per
    partition. The sorted rows are written first, as a repeated sampling of
    range bounds could deal them differently.
    """
    placed = stage(df.repartitionByRange(*(bounds or keys)).sortWithinPartitions(*keys)
                     .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort: bounded by the number of shuffle partitions
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
                     .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
                  .withColumn(out, F.col("_offset") + row).drop("_at", "_part", "_offset"))


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, root) per node but the roots.

    Alternating large and small stars: each round hangs a node's neighbours
    under the smallest of them, so paths shrink to stars in a few rounds. Rows
    never outnumber the links, and each round is written before the next.
    """
    def star(edges: DataFrame, own: Column) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return (edges.where(own).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                     .where("a <> b").distinct())

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stage(edges, f"{name}-links"), None
    while True:
        both = (edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                     .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))))
        large = stage(star(both, F.col("v") > F.col("u")), f"{name}-large")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        itself = down.select("u", F.col("u").alias("v")).distinct()
        edges = stage(star(down.unionByName(itself), F.lit(True)), f"{name}-small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
