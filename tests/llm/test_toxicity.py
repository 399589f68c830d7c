import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from clinspark.llm import toxicity as T


def insults(spark, n=1200):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(300)}" for _ in range(40)]
        bad = rng.random() < 0.2
        if bad:
            words[rng.integers(40)] = f"insult{rng.integers(4)}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_labels(spark):
    docs, labels = insults(spark)
    out = {r.doc_id: r for r in T.scored(docs, labels).collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [i for i in out if out[i].held_out]
    caught = sum(out[i].predicted for i in held if toxic[i]) / sum(toxic[i] for i in held)
    assert caught > 0.9 and not any(out[i].predicted for i in held if not toxic[i])
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r.doc_id: r.score for r in T.scored(docs, flipped).collect()} == {i: r.score for i, r in out.items()}


def test_pairs_and_skips_are_features():
    a, b = T.features("one two three"), T.features("one three two")
    assert len(a) == 6 and len(np.intersect1d(a, b)) == 3
    assert len(T.features("")) == 0 and len(T.features("one")) == 1


def test_weights_are_few(spark):
    docs, labels = insults(spark)
    bias, place, weight = T.fit(docs, labels)
    assert bias < 0 and 4 <= len(place) < 200


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (2, None, 1), (None, 1, 1), (6, 0, 0), (6, 0, 0)],
                                   "doc_id long, toxic int, quality int")
    out = T.scored(odd_docs, labels)
    assert out.count() == odd_docs.count() and out.where("score is null or held_out is null").count() == 0
    empty = out.where("doc_id in (3, 4, 5)").select("score").distinct().collect()
    assert len(empty) == 1
    kept = T.clean(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.where(F.col("_score") != "_score").count() == 0
    assert T.scored(no_docs, labels).collect() == []


def plain_scores(rows, labels):
    """FTRL-proximal feature by feature in dictionaries, over the sample in its order; (row, score) of each row."""
    z, n, bias, bias_n = {}, {}, 0.0, 0.0

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= T.L1 else (math.copysign(T.L1, zi) - zi) / ((T.BETA + math.sqrt(n[i])) / T.ALPHA + T.L2)

    def score(found):
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + sum(map(weight, found))))))

    for _ in range(T.EPOCHS):
        for found, y in labels:
            g = score(found) - y
            for i, w in [(i, weight(i)) for i in found]:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / T.ALPHA * w
                n[i] = old + g * g
            bias_n += g * g
            bias -= T.ALPHA * g / (T.BETA + math.sqrt(bias_n))
    return [(i, score(set(T.features(t or "").tolist()))) for i, t in rows]


def test_scores_against_plain_ftrl(spark):
    docs, labels = insults(spark, 300)
    rows, toxic = [tuple(r) for r in docs.collect()], dict(tuple(r) for r in labels.collect())
    order = [r.doc_id for r in docs.orderBy(F.xxhash64(F.lit(T.SEED), "doc_id"), "doc_id").collect()]
    text = dict(rows)
    learned = [(sorted(set(T.features(text[i]).tolist())), toxic[i]) for i in order if zlib.crc32(str(i).encode()) % 3 != 1]
    want = dict(plain_scores(rows, learned))
    got = {r.doc_id: r.score for r in T.scored(docs, labels).collect()}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9 and len(set(want.values())) > 2


def test_repeated_ids_count_once_in_the_sample(spark, monkeypatch):
    """A labelled doc_id on very many rows is one row of the sample: that with the smallest text hash."""
    docs, labels = insults(spark, 60)
    many = docs.unionByName(spark.range(500).select(F.lit(0).cast("long").alias("doc_id"), F.concat(F.lit("copy "), "id").alias("text")))
    learned = []
    monkeypatch.setattr(T, "stage", lambda df, name: learned.append((name, df.cache())) or learned[-1][1])
    T.fit(many, labels)
    rows = dict(learned)["op9-features"].count()
    assert rows == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))


def test_columns_of_any_name(spark, few_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd = few_docs.withColumns({"a.b": F.lit(1), "c`d": F.lit("x"), "e f": F.lit(None).cast("string"), "_score": F.lit(2)})
    kept = T.clean(odd, labels)
    assert kept.columns == odd.columns and kept.count() == T.clean(few_docs, labels).count()
    assert kept.select("`a.b`", "_score").distinct().collect() == [(1, 2)]


def test_no_labels(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in T.scored(odd_docs, labels).collect()} == {0.5}
