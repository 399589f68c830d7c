import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clinspark.llm import best_position as B

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """docs: (doc_id, text); items: (item_id, text)."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    N = sum(bool(c) for _, c in counts)
    L = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms_of(t))
    out = []
    for i, terms in wanted.items():
        scores = []
        for d, c in counts:
            n = sum(c.values())
            m = 50 + (50 * n * N) // L if L else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@given(st.text(alphabet="aZé_Ÿ İ0-.\n\x00\x7f{[`@:/", max_size=40))
@settings(max_examples=300, deadline=None)
def test_terms(text):
    assert [t.decode() for t in B.terms_of(text.encode())] == terms_of(text)


def test_documents(spark, few_docs, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in few_docs.collect()]
    want = brute(docs, [(r.item_id, r.text) for r in items.collect()], 50)
    monkeypatch.setattr(B, "FIRST_DEPTH", 2)
    assert rows(B.search(few_docs, items)) == want


def test_shards_and_blocks(spark, few_docs, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").where("item_id < 9")
    monkeypatch.setattr(B, "PAIRS", 60)
    some = few_docs.where("doc_id < 60").repartition(4)
    want = brute([(r.doc_id, r.text) for r in some.collect()], [(r.item_id, r.text) for r in items.collect()], 3)
    assert rows(B.search(some, items, k=3)) == want


ITEMS = [(1, "again, and"), (2, "The FOX"), (2, "dog é"), (3, None), (4, "   "), (None, "brown x"), (5, "nowhere"), (2, "The FOX")]


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(*r, "x", "y") for r in ITEMS], "item_id long, text string, doc_id string, rank string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for k in (2, 50):
        assert rows(B.search(odd_docs, items, k)) == brute(docs, ITEMS, k)
    assert rows(B.search(no_docs, items)) == [] == rows(B.search(odd_docs, items.where("false")))


def lists_of(docs, number, shard=3):
    """Shards of rows as ``shards`` makes them."""
    for at in range(0, len(docs), shard):
        part = docs[at:at + shard]
        entries = [sorted(Counter(number[t] for t in terms_of(x) if t in number).items()) for _, x in part]
        flat = [e for own in entries for e in own]
        yield [np.array([d for d, _ in part]), np.zeros(len(part), bool), np.array([len(terms_of(x)) for _, x in part]),
               np.array(list(map(len, entries)), np.int32), np.array([t for t, _ in flat], np.int32), np.array([c for _, c in flat], np.int32)]


@given(st.lists(st.lists(st.sampled_from("abcdefg"), max_size=9).map(" ".join), min_size=1, max_size=25),
       st.sets(st.sampled_from("abcdefgh"), min_size=1), st.integers(1, 6), st.integers(1, 9), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_best_positions_against_brute_force(texts, terms, k, shard, step):
    docs = list(enumerate(texts))
    number = {t: i for i, t in enumerate(sorted(terms))}
    found = list(lists_of(docs, number, shard))
    N, L = sum(bool(t) for t in texts), sum(len(terms_of(t)) for t in texts)
    df = np.array([sum(t in x.split() for x in texts) for t in number])
    weight, best = B.weights(N, df), B.Best(k)
    own = np.arange(len(number))
    before, B.FIRST_DEPTH = B.FIRST_DEPTH, step
    try:
        for arrays in found:
            B.Lists(arrays, N, L, len(number)).search(own[weight > 0], weight, best)
    finally:
        B.FIRST_DEPTH = before
    got = [(0, r, int(d), int(s)) for r, (d, s) in enumerate(zip(best.id, best.score), 1)]
    assert sorted(got, key=str) == brute(docs, [(0, " ".join(terms))], k)


def test_search_stops_early():
    """One document far above the rest: with the best positions passed by direct access, few others are scored."""
    docs = [(0, "a b c " * 20)] + [(i, "a b c " + "z " * 500) for i in range(1, 4000)]
    number = {"a": 0, "b": 1, "c": 2}
    arrays = next(lists_of(docs, number, len(docs)))
    lists = B.Lists(arrays, len(docs) * 3, sum(len(t.split()) for _, t in docs), 3)
    assert lists.search(np.arange(3), np.array([5, 5, 5]), B.Best(1)) <= 2 * B.FIRST_DEPTH
    again = B.Best(1)
    again.add(np.array([10**12]), np.array([7]), np.array([False]))
    assert lists.search(np.arange(3), np.array([5, 5, 5]), again) == 0


@pytest.mark.parametrize("text,terms", [("", []), (None, []), ("A-b_C9 É", ["a", "b", "c9", "É"])])
def test_terms_of_texts(text, terms):
    assert [t.decode() for t in B.terms_of((text or "").encode())] == terms
