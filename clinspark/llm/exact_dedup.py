"""Exact dedup by deterministic block naming (DataFrame operations only).

A text is compared without its ASCII white space, as UTF-8 bytes, cut into
blocks of ``BLOCK`` bytes. Blocks found more than once are sorted and numbered;
then adjacent names are paired, the pairs found more than once are sorted and
numbered, and so on until a document is left with one name. Blocks and pairs
are compared as they are, never as hashes, so two documents share a final name
if and only if their compared texts are the same. A block or pair found once
needs no number: its document equals no other and is out of the next rounds.

Defined results: a null text counts as empty; all empty texts are equal.
Of equal texts the row with the most code points in its original text stays,
then the smallest doc_id (null last), then the smallest hash of the original text. Rows
repeated with the same doc_id and text are one group, of which one row
stays. Extra columns are ignored. An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITESPACE, keyed, ranked, same_key, stage, text_hash, text_or_empty

BLOCK = 2048


def compared(text: Column | str = "text") -> Column:
    """The text without ASCII white space."""
    return F.translate(text_or_empty(text), WHITESPACE, "")


def _blocks(docs: DataFrame, size: int) -> DataFrame:
    one = (docs.select("doc_id", text_hash().alias("th"), F.length(text_or_empty()).alias("cp"),
                       compared().alias("norm"))
               .withColumn("bytes", F.col("norm").cast("binary"))
               .withColumn("nb", F.greatest(F.lit(1), F.ceil(F.octet_length("norm") / size)).cast("int")))
    cut = F.transform(F.sequence(F.lit(0), F.col("nb") - 1),
                      lambda i: F.substring(F.col("bytes"), i * size + 1, F.lit(size)))
    return one.select("doc_id", "th", "cp", "nb", "norm", F.posexplode(cut).alias("idx", "block"))


def identities(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, th, cp, text_sha256, nb, name.

    Rows with equal compared texts have the same (nb, name); name is null
    where the compared text is found once.
    """
    blocks = _blocks(docs, size)
    found = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("block")
    names = ranked(found, ["block"], "op4-blocks", "name", bounds=[F.substring("block", 1, 64)])
    sha = F.when(F.col("idx") == 0, F.sha2(F.col("norm"), 256))
    named = stage(blocks.withColumn("text_sha256", sha).drop("norm").join(names, "block", "left").drop("block"),
                  "op4-named")
    rows = named.where("idx = 0").drop("idx")
    level = (named.where("name is not null").groupBy("doc_id", "th", "nb", "idx", "name")
                  .agg(F.count(F.lit(1)).alias("copies")).withColumn("m", F.col("nb")))
    most = named.where("name is not null").agg(F.max("nb")).first()[0] or 1
    finished = level.where("m = 1")
    while most > 1:
        # a pair lacks a child where that child was found once: the pair goes too
        pairs = (level.where("m > 1")
                      .groupBy("doc_id", "th", "nb", "m", "copies", F.shiftright("idx", 1).alias("idx"))
                      .agg(F.count(F.lit(1)).alias("children"),
                           F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("l"),
                           F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))).alias("r"))
                      .where("children = least(2, m - 2 * idx)")
                      .withColumn("r", F.coalesce("r", F.lit(-1))))
        pairs = stage(pairs, "op4-pairs")
        again = pairs.groupBy("l", "r").agg(F.sum("copies").alias("n")).where("n > 1").select("l", "r")
        pair_names = ranked(again, ["l", "r"], "op4-names", "name")
        level = stage(pairs.join(pair_names, ["l", "r"])
                           .select("doc_id", "th", "nb", "idx", "name", "copies",
                                   F.ceil(F.col("m") / 2).cast("int").alias("m")), "op4-level")
        finished = finished.unionByName(level.where("m = 1"))
        most = (most + 1) // 2
    ident = finished.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("name").alias("_n"))
    return (rows.join(ident, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
                .select("doc_id", "th", "cp", "text_sha256", "nb", F.col("_n").alias("name")))


def groups(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, th, keep_id, group_size, kept, text_sha256."""
    ident = stage(identities(docs, size), "op4-identities")
    alone = (ident.where("name is null")
                  .select("doc_id", "th", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                          F.lit(True).alias("kept"), "text_sha256"))
    shared = ident.where("name is not null")
    first = F.min(F.struct((-F.col("cp")).alias("cp"), F.col("doc_id").isNull().alias("no_id"),
                           F.col("doc_id"), F.col("th")))
    best = (shared.groupBy("nb", "name").agg(F.count(F.lit(1)).alias("group_size"), first.alias("b"))
                  .select("nb", "name", "group_size", F.col("b.doc_id").alias("keep_id"), F.col("b.th").alias("keep_th")))
    best = stage(best, "op4-groups")
    copy = F.row_number().over(Window.partitionBy("doc_id", "th").orderBy("cp"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("th") == F.col("keep_th")) & (F.col("copy") == 1)
    several = (shared.withColumn("copy", copy).join(best, ["nb", "name"])
                     .select("doc_id", "th", "keep_id", "group_size", stays.alias("kept"), "text_sha256"))
    return alone.unionByName(several)


def dedup(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    out = stage(groups(docs, size).select("doc_id", "th", "kept", "group_size"), "op4-kept")
    tally = (out.where("group_size > 1").groupBy("doc_id", "th")
                .agg(F.count(F.lit(1)).alias("_copies"), F.max("kept").alias("_kept")))
    tally = tally.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "_copies", "_kept")
    rows = keyed(docs)
    once = rows.join(tally.where("not _kept or _copies > 1"), same_key(), "left_anti")
    repeated = rows.join(tally.where("_kept and _copies > 1"), same_key(), "left_semi").dropDuplicates(["doc_id", "th"])
    return once.unionByName(repeated).select("row.*")
