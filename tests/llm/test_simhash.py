import numpy as np
import pytest
import xxhash

from clinspark.llm import simhash as S


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def by_hand(rows):
    fp = [fingerprint(r.text) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[root(i)] = min(least.get(root(i), r.doc_id), r.doc_id)
    return sorted(((r.doc_id, fp[i], least.get(root(i))) for i, r in enumerate(rows)), key=str)


def found(docs):
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in S.groups(docs).collect()), key=str)


def test_code_covers_all_near_pairs():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    for flips in range(S.THRESHOLD + 1):
        y = x.copy()
        for k in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64)
        homes, all_of = S.anchors(x), S.anchors(y)
        home = {int(f): int(a & ~S.HOME) for a, f in homes[(homes["anchor"] & S.HOME) > 0]}
        assert len(home) == len(np.unique(x))
        near = {}
        for a, f in all_of:
            near.setdefault(int(f), set()).add(int(a & ~S.HOME))
        assert all(home[int(p)] in near[int(q)] for p, q in zip(x, y))


@pytest.mark.parametrize("chunk", [3, 50, 1 << 22])
def test_forest_connects_what_brute_force_connects(chunk):
    rng = np.random.default_rng(chunk)
    x = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([x] + [x ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(6)]))
    a, b = S.forest(S.anchors(fps), chunk=chunk)
    assert (np.bitwise_count(a ^ b) > 0).all() and len(a) == len(fps) - 30
    groups = dict(zip(a.tolist(), b.tolist()))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    for i, j in zip(*np.nonzero(near)):
        assert groups.get(int(fps[i]), int(fps[i])) == groups.get(int(fps[j]), int(fps[j]))


def test_documents(few_docs):
    assert found(few_docs) == by_hand(few_docs.collect())


def test_near_copies_over_several_links(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(words[:850] + [f"v{rng.integers(9)}" for _ in range(4)] + words[850:])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == by_hand(docs.collect())


def test_odd_documents(odd_docs, no_docs):
    assert found(odd_docs) == by_hand(odd_docs.collect())
    kept = S.dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {(c, f if c is None else 0) for _, f, c in by_hand(odd_docs.collect())}
    assert kept.count() == len(want)
    assert S.groups(no_docs).collect() == [] and S.dedup(no_docs).collect() == []
