import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clinspark.llm import packing as P

ODD = ["", "  \n", "a b c　d", "é x", "'s 't don't I'LL, it's.", "<|endoftext|> x<|startoftext|>y", "ǅ İΣ ΣΣ",
       "\x1c\x1d a\x85b", "12 3a 4,5!! \U0001f600‍ x", "H̱ ẖ x.\n", "a. b!, c.. d,", "é, ß. Ä; 5. don't. it's,"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_ids_by_word_are_the_tokenizers(tokenizer, few_docs, monkeypatch):
    texts = ODD + [r.text for r in few_docs.collect()]
    known = P.Vocabulary(public_tokenizers.path(P.TOKENIZER))
    monkeypatch.setattr(P, "WORDS", 500)
    got = [x for i in range(0, len(texts), 20) for x in known.encode([t.encode() for t in texts[i:i + 20]])]
    for text, ids in zip(texts, got):
        assert ids.tolist() == ids_of(tokenizer, text).tolist()


SPECIAL = ["see <|ENDOFTEXT|> here", "<|EndOfText|>, A.", "<|STARTOFTEXT|>X<|startoftext|>. Y", "A<|endoftext|>. B. <|", "É. <|endOFtext|>"]


def test_special_tokens_are_lower_case_only(tokenizer):
    known = P.Vocabulary(public_tokenizers.path(P.TOKENIZER))
    for text, ids in zip(SPECIAL, known.encode([t.encode() for t in SPECIAL])):
        assert ids.tolist() == ids_of(tokenizer, text).tolist()


PARTS = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|StartOfText|>", "<|", "|>", *"ab .,'!É\u0331HSI1\n"]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_ids_of_texts_with_special_tokens(texts):
    known = P.vocabulary(P.TOKENIZER)
    for text, ids in zip(texts, known.encode([t.encode() for t in texts])):
        assert ids.tolist() == ids_of(known.tokenizer, text).tolist()


@given(st.lists(st.text(alphabet="ab .,'!é̱́ẖHSIs1\n …", max_size=30), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_ids_of_any_text(texts):
    known = P.vocabulary(P.TOKENIZER)
    for text, ids in zip(texts, known.encode([t.encode() for t in texts])):
        assert ids.tolist() == ids_of(known.tokenizer, text).tolist()


def check(docs, tokenizer, packed):
    want = []
    for r in docs.collect():
        ids = ids_of(tokenizer, r.text)
        want += [(r.doc_id, k, a, len(ids[a:a + P.LENGTH]), zlib.crc32(ids[a:a + P.LENGTH].tobytes()))
                 for k, a in enumerate(range(0, len(ids), P.LENGTH))]
    rows = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= P.LENGTH
    return len(sequences), -(-sum(r.length for r in rows) // P.LENGTH)


def test_documents(few_docs, tokenizer):
    used, least = check(few_docs, tokenizer, P.pack(P.pieces(few_docs)))
    assert used <= least + 1


def test_groups_and_odd_documents(odd_docs, no_docs, tokenizer):
    check(odd_docs, tokenizer, P.pack(P.pieces(odd_docs), group=3))
    assert P.pack(P.pieces(no_docs)).collect() == []


@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
@settings(max_examples=150, deadline=None)
def test_search_keeps_items_and_never_adds_bins(sizes):
    sizes = np.array(sizes)
    first = P.best_fit(sizes, 40)
    bins = P.improve([list(b) for b in first], sizes, 40)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(0 < sizes[b].sum() <= 40 for b in bins)
    assert -(-sizes.sum() // 40) <= len(bins) <= len(first)


def test_search_empties_bins_that_best_fit_leaves():
    sizes = np.random.default_rng(1).integers(500, 1100, 2000)
    first = P.best_fit(sizes, 2048)
    assert len(P.improve(first, sizes, 2048)) < 0.98 * len(first)


def test_search_tries_all_open_bins():
    sizes = np.random.default_rng(1).integers(500, 1100, 2000)
    assert len(P.improve(P.best_fit(sizes, 2048), sizes, 2048)) <= 822  # 823 where it stops after 32 bins in a row
