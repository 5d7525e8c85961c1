"""Tree concatenation against the library's own encoding."""
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from bitext.llm.bpe import TreeBpe, bpe_round_trip, encode_documents, vocabulary_path

CODEC = TreeBpe(vocabulary_path(), memo_entries=50, leaf_bytes=16)
LIBRARY = Tokenizer.from_file(vocabulary_path())


def same(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    ids = CODEC.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert CODEC.decode(ids) == LIBRARY.decode(expected, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " ", "a", "   ", "  a", "a  ", "a   b", "a \n b", "a\n \n  b", "\t\ta", "it's we'll 'tis", "12 345  6",
    "a" * 5000, "ab" * 3000, "é" * 999, "日本語" * 500, "!?" * 700, " " * 4000, "\n" * 777 + "x", "x" + " " * 999 + "y",
    "<|endoftext|>", "a<|endoftext|> b", "<|endoftext", "naïve Ünïcode ‘quotes’ — 🤖🤖" * 40,
    "".join(chr(97 + i * i % 26) for i in range(4000)), "\x00\x01 a\x7f", "a b 　c",
])
def test_equals_library(text):
    same(text)


@pytest.mark.parametrize("text", [
    "x \u00a0 \u00a0 y", "Price: \u00a0 \u00a0 \u00a0 10", "end \u00a0 \u00a0", " \u00a0 \u00a0start", "a \u00a0b\u00a0 c",
    "a \n \u00a0 \t b c  d", "a" + " \u00a0" * 300 + " b", "a \x1c b \x85 c \u3000 d",
])
def test_equals_library_on_mixed_white_space(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \u00a0\n\u3000!", max_size=60))
def test_equals_library_on_any_white_space(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab th's.,!0 \n\té日"), st.characters(codec="utf-8")), max_size=120))
def test_equals_library_on_any_text(text):
    same(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aeinrst", min_size=40, max_size=600))
def test_joins_of_unsplit_runs(text):
    same(text)


def test_joins_happen():
    before = CODEC.joins
    CODEC.encode("x" * 500)
    assert CODEC.joins > before


def test_rows(spark):
    rows = [(1, None, "e"), (2, "", "x"), (3, "Hello world", "x"), (3, "Hello world", "x"), (None, "z" * 70000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe_round_trip(docs).collect()
    assert len(out) == 5
    for r, (i, t, _) in zip(sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0)), rows):
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert encode_documents(docs.limit(0)).count() == 0
