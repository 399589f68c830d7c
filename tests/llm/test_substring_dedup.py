import collections
import hashlib
import random

import pytest

from clinspark.llm import routing, substring_dedup as S


def by_hand(rows):
    words = [(r.text or "").encode().split() for r in rows]
    seen = collections.Counter(tuple(w[k:k + S.WINDOW]) for w in words for k in range(len(w) - S.WINDOW + 1))
    out = []
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - S.WINDOW + 1):
            if seen[tuple(w[k:k + S.WINDOW])] > 1:
                gone[k:k + S.WINDOW] = [True] * S.WINDOW
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((r.doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in S.removed(docs).collect()), key=str)


def test_every_difference_is_covered():
    for d in range(S.PERIOD):
        assert any((a - b) % S.PERIOD == d for a in S.COVER for b in S.COVER)


def test_documents(few_docs):
    assert found(few_docs) == by_hand(few_docs.collect())


def test_odd_documents(odd_docs):
    assert found(odd_docs) == by_hand(odd_docs.collect())


def test_many_chunks(few_docs, monkeypatch):
    monkeypatch.setattr(routing, "CHUNK", 20_000)
    monkeypatch.setattr(S, "PER_PART", 50_000)
    assert found(few_docs) == by_hand(few_docs.collect())


@pytest.mark.parametrize("shared", [S.WINDOW - 1, S.WINDOW, S.WINDOW + 1, 60])
def test_passages_at_any_offset(spark, shared):
    rnd, passage = random.Random(shared), [f"p{i}" for i in range(shared)]
    rows = [(i, " ".join([f"a{rnd.random()}" for _ in range(i)] + passage + [f"b{rnd.random()}" for _ in range(3)])) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(docs)
    assert got == by_hand(docs.collect())
    assert all(r[2] == (shared if shared >= S.WINDOW else 0) for r in got)


def test_dedup_keeps_columns(odd_docs, no_docs):
    out = S.dedup(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert out.where("doc_id = 10").first().text == ""
    assert S.dedup(no_docs).collect() == [] and S.removed(no_docs).collect() == []
