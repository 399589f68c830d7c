import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinspark.llm import quality as Q


def counts_by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def check_counts(docs):
    rows = Q.judged(docs).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=str)
    assert got == sorted(((r.doc_id, *counts_by_hand(r.text)) for r in docs.collect()), key=str)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept is not None and not (r.base_failed and r.kept)
    return rows


def test_documents(few_docs):
    check_counts(few_docs)


def test_odd_documents(odd_docs, no_docs, spark):
    check_counts(odd_docs)
    assert Q.judged(no_docs).collect() == []
    rows = [(1, "a b c d e f g h a b c d e f g h"), (2, "\n\nx y\nx y\n \nx y\r\nz"), (3, "a " * 9), (4, "a b c d e f g h"), (5, "# <&> |$%*")]
    check_counts(spark.createDataFrame([(*r, None, "s") for r in rows], "doc_id long, text string, lang string, source string"))


def floors_by_hand(fit):
    """What one count makes in a text of median size, in squared units of the grid."""
    words, chars, lines = (np.exp(np.median(np.round(100 * np.log(np.maximum(fit[c], 1)))) / 100) for c in Q.SIZES)
    return np.array([1 / words ** 2, 1 / chars, 1 / lines, 2 * Q.WINDOW / words]) * Q.GRID ** 2


def estimate_by_hand(fit):
    """The estimate of one group, in numpy: centre, covariance, scale and the covariance without its floor."""
    x, f = fit[list(Q.VECTOR)].to_numpy(np.float64), floors_by_hand(fit)
    grid = lambda d: np.round(100 * np.log(d + 1e-4))
    dist = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    refit = lambda s: (s.mean(axis=0), Q.CONSISTENT * ((s.T @ s) / len(s) - np.outer(s.mean(axis=0), s.mean(axis=0))) + np.diag(f))
    m = np.median(x, axis=0)
    s = np.sqrt((1.4826 * np.median(np.abs(x - m), axis=0)) ** 2 + f)
    z = (x - m) / s
    length = np.linalg.norm(z, axis=1, keepdims=True)
    u = np.round(Q.GRID * np.divide(z, length, out=np.zeros_like(z), where=length > 0))
    signs = 4 * np.outer(s, s) * (u.T @ u) / (Q.GRID ** 2 * len(x)) + np.diag(f)
    best = None
    for m, c in ((m, np.diag(s * s)), refit(x), (m, signs)):
        for _ in range(Q.STEPS):
            g, before = grid(dist(m, c)), c
            m, c = refit(x[g <= np.ceil(np.percentile(g, 100 * Q.SUBSET))])
            if np.allclose(c, before, rtol=1e-12, atol=0):
                break
        det = round(np.linalg.slogdet(c)[1] / 2, 6)
        if best is None or det < best[0]:
            best = det, m, c
    _, m, c = best
    return m, c, max(1.0, np.exp(np.percentile(grid(dist(m, c)), 50) / 100) / Q.MEDIAN), c - np.diag(f)


def distances_by_hand(fit, x):
    m, c, scale, _ = estimate_by_hand(fit)
    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) / scale


def test_distances_are_those_of_the_estimate(spark):
    """Several languages and sources: own estimates, those of the language and those of all rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "s").when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise(F.col("source")))
    rows = Q.judged(docs).toPandas()
    fit = rows[~rows.base_failed].astype({"lang": object, "source": object})
    fit = fit.assign(lang=fit.lang.where(fit.lang.notna(), "?"), source=fit.source.where(fit.source.notna(), "?"))
    levels = set()
    for (lang, source), part in fit.groupby(["lang", "source"]):
        level, group = next((k, g) for k, g in enumerate((part, fit[fit.lang == lang], fit)) if k == 2 or len(g) >= Q.ROWS)
        want = distances_by_hand(group, part[list(Q.VECTOR)].to_numpy(np.float64))
        assert np.allclose(want, part.distance, rtol=1e-6, atol=1e-9)
        assert (part.kept == (want <= Q.CUTOFF)).all()
        levels.add(level)
    assert levels == {0, 1, 2}


def test_the_estimate_decides_not_the_floor(spark):
    """The word length's variance is that of the nearest rows, and verdicts stay when floors are halved."""
    rows = Q.judged(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    fit = rows[~rows.base_failed]
    _, c, _, measured = estimate_by_hand(fit)
    assert measured[0, 0] > 20 * floors_by_hand(fit)[0]
    x = fit[list(Q.VECTOR)].to_numpy(np.float64)
    m, c, scale, measured = estimate_by_hand(fit)
    half = measured + np.diag(floors_by_hand(fit) / 2)
    far = lambda c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) / scale > Q.CUTOFF
    assert (far(c) != far(half)).mean() < 0.01


def test_outliers_do_not_move_the_estimate(spark):
    """A fifth of the texts is junk, and every one of those is rejected; prose is kept."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    rows = [(i, " ".join(word() + ("###$$" if i % 5 == 0 else "") for _ in range(rng.integers(40, 90))), "en", "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.kept for r in Q.judged(docs).collect()}
    assert all(out[i] == (i % 5 != 0) for i in out)


def test_no_python_in_the_plan(few_docs):
    plan = Q.judged(few_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("n", [1, 2])
def test_few_rows(spark, few_docs, n):
    assert Q.judged(few_docs.limit(n)).count() == n
