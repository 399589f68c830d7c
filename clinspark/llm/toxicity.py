"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, pairs of adjacent words and pairs of
words with one between, hashed to ``DIM`` places. Training visits a document
at a time with a learning rate per coordinate; the L1 term keeps most weights at
zero, so the model that is broadcast is a short list of places and weights (at most ``DIM``).

The model is fitted on at most ``SAMPLE`` labelled documents (a documented bound:
those with the smallest seeded hash of doc_id among all that may be learned from); every
document is scored. Labels, language, source and doc_id are no features.

Defined results: null and empty texts have no features and get the score of the bias alone.
A doc_id labelled several times is toxic if any of its labels says so; null labels are
not used. Of labelled rows that share a doc_id, that with the smallest text hash is learned from, so that the
bound holds for rows. Without usable labels every score is 0.5. Rows with a null doc_id are not
held out. Rows repeated are scored each. Extra columns are ignored.
"""
from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import stage, text_hash, text_or_empty

SAMPLE = 20_000
DIM = 1 << 22
SEED = 9
EPOCHS = 5
ALPHA, BETA, L1, L2 = 4.0, 1.0, 5.0, 1.0
THRESHOLD = 0.7
SCORE = "_score"
# ASCII other than letters, digits and apostrophe parts words
SEPARATORS = bytes(c if c >= 128 or chr(c).isalnum() or c == 39 else 32 for c in range(256))


def words(text: str) -> np.ndarray:
    """A 32-bit hash of each word, in order."""
    found = text.lower().encode().translate(SEPARATORS).split()
    return np.fromiter(map(zlib.crc32, found), np.uint64, len(found))


def features(text: str) -> np.ndarray:
    """Places of words, adjacent pairs and pairs with one word between; places may repeat."""
    w = words(text)
    mixed = [w * np.uint64(0x9E3779B97F4A7C15)]
    for gap, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        mixed.append((w[:-gap] * np.uint64(factor) + w[gap:] + np.uint64(gap)) * np.uint64(0xFF51AFD7ED558CCD))
    return (np.concatenate(mixed) >> np.uint64(42)).astype(np.uint32)


def ftrl(docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[float, np.ndarray]:
    """(bias, weights) after ``epochs`` passes over documents given as sorted distinct places."""
    z, n = np.zeros(DIM, np.float64), np.zeros(DIM, np.float64)
    bias, bias_n = 0.0, 0.0

    def weight(z, n):
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    for _ in range(epochs):
        for at, y in zip(docs, labels):
            zi, ni = z[at], n[at]
            w = weight(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            bias_n += g * g
            bias -= ALPHA * g / (BETA + np.sqrt(bias_n))
    kept = np.flatnonzero((z > L1) | (z < -L1))
    w = np.zeros(DIM)
    w[kept] = weight(z[kept], n[kept])
    return bias, w


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the doc_id as text leaves 1 on division by 3."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, places, weights) learned from at most ``sample`` documents that are not held out."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
                   .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    known = stage(known.orderBy(order, "doc_id").limit(sample), "op9-sample")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blobs = [np.unique(features(x)).tobytes() for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(blobs, pa.binary())],
                                             ["one", "at", "toxic", "places"])

    def train(found: pa.Table) -> pa.Table:
        found = found.sort_by([("at", "ascending"), ("toxic", "ascending"), ("places", "ascending")])
        docs = [np.frombuffer(x.as_buffer(), np.uint32) for x in found.column("places")]
        bias, w = ftrl(docs, found.column("toxic").to_numpy())
        place = np.flatnonzero(w)
        return pa.table({"place": np.r_[-1, place], "weight": np.r_[bias, w[place]]})

    # the sample has at most ``sample`` rows of two numbers, so it is broadcast
    seen = docs.select("doc_id", F.struct(text_hash().alias("th"), text_or_empty().alias("text")).alias("own")).join(F.broadcast(known), "doc_id")
    seen = seen.groupBy("doc_id", "toxic").agg(F.min("own").alias("own"))
    seen = stage(seen.select(F.lit(1).alias("one"), order.alias("at"), "toxic", "own.text")
                     .mapInArrow(extract, "one int, at long, toxic int, places binary"), "op9-features")
    model = seen.groupBy("one").applyInArrow(train, "place long, weight double").toPandas()  # at most DIM + 1 rows
    place, weight = model["place"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)
    at = np.argsort(place, kind="stable")
    place, weight = place[at], weight[at]
    return (float(weight[0]) if len(weight) else 0.0), place[1:], weight[1:]


def quoted(column: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def score_name(columns: list[str]) -> str:
    return next(n for n in (SCORE + "_" * i for i in range(len(columns) + 1)) if n not in columns)


def scores(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray], keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` and last its score, under ``score_name(keep)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = [f"c{i}" for i in range(len(keep))]  # Python workers are given names without dots
    at_text = keep.index("text") if "text" in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, place, weight = shared.value
        dense = np.zeros(DIM)
        dense[place] = weight
        for b in batches:
            out = np.empty(b.num_rows)
            for i, text in enumerate(b.column(at_text)):
                at = features(text.as_py() or "")
                at = np.unique(at[dense[at] != 0])
                out[i] = bias + dense[at].sum()
            out = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(out)], [*plain, "score"])

    kinds = StructType([StructField(p, docs.schema[c].dataType) for p, c in zip(plain, keep)]).add("score", "double")
    read = [quoted(c).alias(p) for p, c in zip(plain, keep)] + ([] if "text" in keep else [F.col("text")])
    found = docs.select(*read).mapInArrow(run, kinds)
    return found.select(*[F.col(p).alias(c) for p, c in zip(plain, keep)], F.col("score").alias(score_name(keep)))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    return (scores(docs, fit(docs, labels, sample), ["doc_id"])
            .select("doc_id", held_out().alias("held_out"), F.col(SCORE).alias("score"),
                    (F.col(SCORE) >= threshold).cast("int").alias("predicted")))


def clean(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, with their columns."""
    found = scores(docs, fit(docs, labels, sample), docs.columns)
    return found.where(quoted(score_name(docs.columns)) < threshold).select(*map(quoted, docs.columns))
