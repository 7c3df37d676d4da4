from __future__ import annotations

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from runledger.llm.bpe_count import VOCABULARY, Counter, token_counts
from tests.llm.conftest import EDGE

PATH = public_tokenizers.path(VOCABULARY)
TOKENIZER = Tokenizer.from_file(PATH)
COUNTER = Counter(PATH, cache_entries=50)


def library(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=12), st.sampled_from(
        ["<|endoftext|>", "<|startoftext|>", "it's", "I'LL ", "\x1c", " \n",
         "Straße", "ΣΑΣ", "é", "don't,\nWhy", "1234", "aaaa" * 9])),
    max_size=8))
def test_equals_library(parts):
    text = "".join(parts)
    assert COUNTER.count(text) == library(text)


def test_rows(make_docs):
    rows = EDGE + [(20, "word " * 3000), (21, "x<|endoftext|>y")]
    got = token_counts(make_docs(rows)).collect()
    want = [(i, len((t or "").encode()), library(t), library(t) > 2048)
            for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_long_words_are_counted_but_not_kept():
    counter = Counter(PATH, cache_entries=1000)
    text = " ".join("xyzab" * 1000 + str(k) + "qw" * 40 for k in range(50))
    assert counter.count(text) == library(text)
    assert max(map(len, [*counter.words, *counter.pieces, ""])) <= 64


def test_empty_table(make_docs):
    out = token_counts(make_docs([]))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert out.count() == 0
