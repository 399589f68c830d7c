import re

import pytest
from pyspark.sql import functions as F

from clinspark.llm import mixing

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def seats_by_hand(votes, total):
    """Highest quotients one after the other."""
    seats = [0] * len(votes)
    for _ in range(total):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


@pytest.mark.parametrize("votes, total", [([10.0, 20.0, 30.0], 7), ([1.0, 1.0, 1.0], 2), ([5.0, 0.0, 3.5], 40), ([7.0], 3),
                                          ([0.0, 0.0], 4), ([3.0, 2.0, 1.0, 1.0, 0.5], 1), ([100.0, 1.0], 0)])
def test_seats_go_to_the_highest_quotients(spark, votes, total):
    rows = [(0, i, v, total) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g int, p int, v double, n long")
    got = [r.s for r in mixing.sainte_lague(df, "g", "p", "v", "n", "s").orderBy("p").collect()]
    assert got == (seats_by_hand(votes, total) if sum(votes) else [0] * len(votes))


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2):
    total, capped = share * sum(sizes), set()
    w = [weights[i % 3] for i in range(len(sizes))]
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        rate = left / sum(w[i] for i in free) if free else 0
        over = {i for i in free if w[i] * rate > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in capped else w[i] * rate for i in range(len(sizes))]
        capped |= over


def check_plan(docs, block=mixing.BLOCK):
    rows = mixing.plan(docs).collect()
    want = {}
    for r in docs.select("doc_id", "source", "text").collect():
        want.setdefault(r.source, []).append(len(WORDS.findall(r.text or "")))
    order = sorted(want, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, targets_by_hand([sum(want[s]) for s in order])))
    assert sorted((str(s), n) for s in want for n in want[s]) == sorted((str(r.source), r.size) for r in rows)
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sum(want[r.source])
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 4 * block
    return rows


def test_plan(few_docs):
    first = check_plan(few_docs)
    again = mixing.plan(few_docs.repartition(5)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_plan_of_odd_documents(odd_docs):
    check_plan(odd_docs)


def test_no_documents(no_docs):
    assert mixing.plan(no_docs).collect() == []
    assert mixing.mix(no_docs).collect() == []


def test_mix_takes_what_is_planned(few_docs):
    planned = {r.doc_id: r.taken for r in mixing.plan(few_docs).collect()}
    mixed = mixing.mix(few_docs)
    assert mixed.columns == few_docs.columns
    got, texts = {}, {r.doc_id: r.text for r in few_docs.collect()}
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(WORDS.findall(r.text))
        if r.text != texts[r.doc_id]:  # a pass over some blocks keeps the order of words
            words = iter(WORDS.findall(texts[r.doc_id]))
            assert all(w in words for w in WORDS.findall(r.text))
    assert got == {k: v for k, v in planned.items() if v}


def test_mix_of_odd_documents(odd_docs):
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.where(F.col("row") != "row").count() == 0


def test_large_source_is_dealt_to_shards(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("a b c").alias("text"))
    rows = mixing.plan(docs, shard=3000).groupBy("shard").count().collect()
    assert len(rows) == 9 and max(r["count"] for r in rows) < 1500
