import re

import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as C
from clinspark.llm import mixing, simhash, toxicity
from clinspark.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    w = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_stages_against_brute_force(spark):
    """Each stage on its own input: what goes, what stays, and that rows keep their values."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {None: {r.doc_id: r for r in docs.collect()}}
    before, after = docs, {}
    for name, fn in C.STAGES[:-1]:
        before = stage(fn(spark, before, SF), "test-pipeline")
        assert before.columns == columns
        after[name] = before.collect()
    first = list(seen[None].values())

    score = {r.doc_id: r.predicted for r in toxicity.scored(docs, table(spark, SF, "labels")).collect()}
    assert sorted(after["toxicity"]) == sorted(r for r in first if not score[r.doc_id])

    groups = {}
    for r in after["toxicity"]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    assert sorted(after["exact_dedup"]) == sorted(min(g, key=lambda r: (-len(r.text), r.doc_id)) for g in groups.values())

    rows = after["exact_dedup"]
    fp, parent = [fingerprint(r.text) for r in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= simhash.THRESHOLD:
                parent[root(i)] = root(j)
    stay = {}
    for i, r in enumerate(rows):
        stay[root(i)] = min(stay.get(root(i), r), r, key=lambda x: x.doc_id)
    assert sorted(after["simhash_dedup"]) == sorted(stay.values())

    taken = {r.doc_id: r.taken for r in mixing.plan(spark.createDataFrame(after["simhash_dedup"], docs.schema)).collect()}
    got = {}
    for r in after["mixing"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == {k: v for k, v in taken.items() if v}


def test_run_packs_what_the_stages_leave(spark):
    out = C.run(spark, SF).toPandas()
    assert (out.groupby("sequence_id")["length"].sum() <= 2048).all()
    assert out.sequence_id.nunique() <= -(-out["length"].sum() // 2048) + 1
    assert set(out.doc_id) <= set(pq.read_table(f"{SF}/documents.parquet")["doc_id"].to_pylist())


def test_stages_keep_extra_columns_of_any_name(spark, few_docs):
    docs = few_docs.withColumns({"a.b": F.lit(1), "_score": F.lit("s"), "th": F.lit(2), "row": F.lit("r"), "size": F.lit(3.5), "kept": F.lit(True)})
    for name, fn in C.STAGES:
        before = docs.columns
        docs = stage(fn(spark, docs, SF), "test-columns")
        if name != "packing":
            assert docs.columns == before and docs.select("`a.b`", "_score", "th", "row", "size", "kept").distinct().count() == 1, name
    assert docs.count() > 0


def test_odd_documents(spark, odd_docs, no_docs):
    plain = [odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs.select("doc_id", "text", "lang", "source", "n_chars")]
    for docs in plain:
        for _, fn in C.STAGES:
            docs = stage(fn(spark, docs, SF), "test-pipeline")
        docs.count()
