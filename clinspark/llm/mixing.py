"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources share ``share`` times all words by their weights; a source's target
stops at ``most`` times its size and the excess is shared anew. The targets are
votes for seats, each seat a block of ``block`` words: seats go to the highest
quotients votes / (2k + 1). A source's documents are dealt to shards by a
seeded hash; its seats go to its shards in the same way, by the shards' words.
A shard's documents, in seeded order, form a stream of words cut into equal
blocks. A quota of q over n blocks takes every block q div n times, and q mod n
blocks once more: those at even steps from a seeded start, so that which words
are taken depends on the seeded order alone and needs no list of blocks.

Defined results: a null or empty text has no words and takes none. A null
source is a source of its own, after all others. Ties between quotients go to
the smaller source or shard number. Rows with the same doc_id are planned each on
its own; ``mix`` takes rows repeated with one doc_id and text by the plan of the first. Extra columns are ignored by ``plan`` and kept by ``mix``. Empty tables and tables
without words give no words.

One row per source and per shard is kept beside the documents; a shard holds
about ``shard`` words, or 4096 documents if they are shorter, whatever a source holds.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, keyed, ranked, same_key, stage, text_hash, text_or_empty, with_texts, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 32
SHARD = 1 << 18
SEED = 20260


def sainte_lague(parties: DataFrame, group: str, party: str, votes: str, total: str, out: str) -> DataFrame:
    """Seats per party: ``total`` seats of each ``group`` go to the highest votes / (2k + 1).

    With S parties, V votes and N seats the last quotient that gets a seat lies
    between V / (2N + S) and V / (2N - S). Seats above that range are counted;
    only the at most 2S + 2 quotients inside it are listed and ranked.
    """
    sums = parties.groupBy(group).agg(F.sum(votes).alias("_v"), F.count(F.lit(1)).alias("_s"))
    p = parties.join(sums, group)
    v, n, s = F.col(votes), F.col(total), F.col("_s")

    def seats_above(divisor: Column) -> Column:
        at_least = F.floor((v * divisor / F.col("_v") + 1) / 2)
        return F.when((F.col("_v") > 0) & (divisor > 0) & (n > 0), at_least).otherwise(F.lit(0)).cast("long")

    p = p.withColumn("_sure", seats_above(2 * n - s - 1)).withColumn("_most", seats_above(2 * n + s + 1))
    sure = p.groupBy(group).agg(F.sum("_sure").alias("_all_sure"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_q"), party))
    won = (p.where("_most > _sure").select(group, party, votes, total, F.explode(F.expr("sequence(_sure, _most - 1)")).alias("_k"))
            .withColumn("_q", v / (2 * F.col("_k") + 1)).withColumn("_rank", rank)
            .join(sure, group).where(F.col("_rank") <= n - F.col("_all_sure"))
            .groupBy(group, party).agg(F.count(F.lit(1)).alias("_won")))
    return (p.join(won, [group, party], "left")
             .withColumn(out, F.col("_sure") + F.coalesce("_won", F.lit(0)))
             .drop("_v", "_s", "_sure", "_most", "_won"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_id, docs, source_size, weight, target."""
    sources = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
                    .withColumn("no_source", F.col("source").isNull()))
    s = ranked(sources, ["no_source", "source"], "op1-sources", "source_id").drop("no_source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_id") % len(weights) + 1).cast("int"))
    s = stage(s.withColumn("weight", weight.cast("double")), "op1-weights")
    cap = F.col("source_size") * F.lit(most)
    whole = s.agg(F.sum("source_size"), F.sum("weight")).first()
    total, rate = share * (whole[0] or 0), 0.0
    if whole[1]:
        rate, before = total / whole[1], None
        while rate != before:  # each round caps at least one more source
            over = F.col("weight") * rate > cap
            capped, free = s.agg(F.sum(F.when(over, cap).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
            rate, before = ((total - capped) / free if free else rate), rate
    return s.withColumn("target", F.least(F.col("weight") * rate, cap.cast("double")))


def _key(source: Column) -> list[Column]:
    return [F.coalesce(source, F.lit("")), source.isNull()]


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
         block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, th, source, size, source_size, target, taken and its place in the mix.

    ``every`` copies of the whole document are taken, and of the shard's
    ``blocks`` blocks, ``extra`` once more, counted round from ``turn``; the
    document's words start at word ``at`` of its shard.
    """
    sizes = stage(docs.select("doc_id", text_hash().alias("th"), "source", word_count().alias("size")),
                  "op1-sizes")
    s = targets(sizes, weights, share, most)
    total = s.agg(F.sum("target")).first()[0] or 0.0
    s = sainte_lague(s.withColumn("_all", F.lit(0)).withColumn("_n", F.lit(round(total / block)).cast("long")),
                     "_all", "source_id", "target", "_n", "seats").drop("_all", "_n")
    shards = F.greatest(F.ceil(F.col("source_size") / shard), F.ceil(F.col("docs") / 4096), F.lit(1)).cast("long")
    s = stage(s.withColumn("shards", shards), "op1-seats")

    same = F.col("source").eqNullSafe(F.col("s_source"))
    own = s.select(F.col("source").alias("s_source"), "source_id", "source_size", "target", "shards", "seats")
    dealt = (sizes.join(own, same).drop("s_source")
                  .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "th"))
                  .withColumn("shard", F.pmod(F.xxhash64("order"), F.col("shards"))))
    held = dealt.groupBy("source_id", "shard", "seats").agg(F.sum("size").alias("words"))
    quotas = sainte_lague(held.withColumn("votes", F.col("words").cast("double")),
                          "source_id", "shard", "votes", "seats", "quota")
    blocks = F.ceil(F.col("words") / block).cast("long")
    quotas = (quotas.withColumn("blocks", blocks)
                    .withColumn("quota", F.least("quota", (F.col("blocks") * most).cast("long")))
                    .where("blocks > 0")
                    .select(F.col("source_id").alias("q_source"), F.col("shard").alias("q_shard"), "blocks",
                            F.expr("quota div blocks").alias("every"), (F.col("quota") % F.col("blocks")).alias("extra"),
                            F.pmod(F.xxhash64(F.lit(seed), "source_id", "shard"), F.col("blocks")).alias("turn")))
    before = Window.partitionBy("source_id", "shard").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (dealt.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
                   .join(quotas, (F.col("source_id") == F.col("q_source")) & (F.col("shard") == F.col("q_shard")), "left")
                   .na.fill({"blocks": 1, "every": 0, "extra": 0, "turn": 0}))

    def chosen(j: str) -> str:
        """Blocks of extra among the first j."""
        round_at = f"(({j}) + turn)"
        whole = f"(({round_at} div blocks) * extra + ({round_at} % blocks) * extra div blocks)"
        return f"({whole} - turn * extra div blocks)"

    def words(x: str) -> str:
        """Words of extra blocks among the first x words."""
        j = f"(({x}) div {block})"
        return f"({chosen(j)} * {block} + ({chosen(j + ' + 1')} - {chosen(j)}) * (({x}) % {block}))"

    taken = F.expr(f"every * size + {words('at + size')} - {words('at')}")
    return placed.withColumn("taken", taken.cast("long")).select(
        "doc_id", "th", "source", "size", "source_size", "target", "taken", "shard", "at", "every", "extra", "blocks", "turn")


def mix(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: each taken pass over a document is a row.

    A whole pass keeps the text; a pass over some of its blocks keeps those
    words, joined by one space. ``n_chars`` is counted anew where it exists.
    """
    place = ("size", "taken", "at", "every", "extra", "blocks", "turn")
    p = plan(docs, block=block, **options).where("taken > 0").groupBy("doc_id", "th").agg(F.min(F.struct(*place)).alias("p"))
    p = stage(p.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("p.size").alias("_size"),
                       *[f"p.{c}" for c in place[1:]]), "op1-plan")
    both = keyed(docs).join(p, same_key())
    again = "((j + turn) % blocks + 1) * extra div blocks > ((j + turn) % blocks) * extra div blocks"
    picked = f"filter(sequence(at div {block}, (at + _size - 1) div {block}), j -> {again})"
    spans = f"transform({picked}, j -> slice(_words, int(greatest(j * {block} - at, 0) + 1), " \
            f"int(least((j + 1) * {block} - at, _size) - greatest(j * {block} - at, 0))))"
    more = F.expr("taken > every * _size")
    both = both.withColumn("_words", F.when(more, F.regexp_extract_all(text_or_empty(), F.lit(WORD), F.lit(0))))
    texts = F.concat(F.array_repeat(F.col("text"), F.col("every").cast("int")),
                     F.when(more, F.array(F.array_join(F.flatten(F.expr(spans)), " "))).otherwise(F.array().cast("array<string>")))
    return with_texts(both.withColumn("_text", F.explode(texts)), docs, F.col("_text"))
