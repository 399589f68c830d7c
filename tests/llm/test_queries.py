"""Registered queries: SQL where there is some, and that the rest of the package does not need this part."""
import math
import os
import re
import subprocess
import sys
import textwrap

import duckdb
import pytest

import __spark_entry__ as E
from clinspark.llm import queries as Q

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(E.__file__))


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    want = con.execute(Q.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, want.fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in Q.QUERIES) == list(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())


def test_nothing_else_imports_this_part():
    for folder, _, files in os.walk(os.path.join(ROOT, "clinspark")):
        for f in files:
            if f.endswith(".py") and "llm" not in folder:
                assert not re.search(r"import.*\bllm\b|from.*\bllm\b", open(os.path.join(folder, f)).read()), f


def test_entry_without_this_part():
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("clinspark.llm"):
                    raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as E
        assert len(E.queries()) > 50 and not any(n.startswith("op") and n[2].isdigit() for n in E.queries())
        assert "pipeline" not in E.queries() and set(E.oracle_sql()) <= set(E.queries())
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_queries_return_their_columns(spark):
    want = {
        "op1_mixing": {"doc_id", "size", "source_size", "target", "taken"},
        "op2_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
        "op6_simhash": {"doc_id", "fingerprint", "component_id"},
        "op7_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
        "op8_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        "op9_toxicity": {"doc_id", "held_out", "score", "predicted"},
        "op10_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op11_harmonic": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op12_best_position": {"item_id", "rank", "doc_id", "score"},
        "op13_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
    }
    for name, columns in want.items():
        df = Q.QUERIES[name](spark, SF)
        assert columns <= set(df.columns), name
    rows = Q.QUERIES["op6_simhash"](spark, SF).collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows) and not any(math.isnan(r.doc_id) for r in rows)
