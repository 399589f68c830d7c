import hashlib
import re

import pytest

from clinspark.llm import exact_dedup


def by_hand(rows):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id is None, r.doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        keep = None if best[1] else best[2]
        for m in members:
            out.append((rows[m[3]].doc_id, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [7, 64, 2048])
def test_groups(odd_docs, size):
    rows = odd_docs.collect()
    got = exact_dedup.groups(odd_docs, size).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == by_hand(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})


def test_small_blocks_agree_with_whole_texts(few_docs):
    want = by_hand(few_docs.collect())
    got = exact_dedup.groups(few_docs, 50).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want


def test_dedup_keeps_one_row_of_each_group(odd_docs):
    kept = exact_dedup.dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in rows]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in odd_docs.collect()})
    assert all(r.row == "row" and r.th == "th" for r in rows)


def test_no_documents(no_docs):
    assert exact_dedup.groups(no_docs).collect() == [] and exact_dedup.dedup(no_docs).collect() == []


def test_no_python_in_the_plan(few_docs):
    plan = exact_dedup.groups(few_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
