"""rANS segments: exact round trips, independent blocks, checksums; ids as the library's."""
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from bitext.llm.bpe import vocabulary_path
from bitext.llm.token_files import (Segment, WordEncoder, pack_segment, read_token_files, scaled_frequencies,
                                    write_token_files)

PATH = vocabulary_path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH, memo_entries=40)


@pytest.mark.parametrize("n, kinds, block, lanes", [(1, 1, 8, 4), (7, 1, 8, 4), (8, 3, 8, 4), (1000, 50, 64, 8),
                                                     (5000, 4000, 512, 16), (333, 2, 64, 64), (2000, 49000, 256, 32)])
def test_segment_round_trip(n, kinds, block, lanes):
    rnd = random.Random(n)
    ids = np.array([min(int(rnd.expovariate(3 / kinds)), kinds - 1) for _ in range(n)], np.uint16)
    image = pack_segment(ids, np.array([n]), block, lanes)
    s = Segment(image)
    assert s.decode().tolist() == ids.tolist()
    for b in range(s.blocks):  # any block alone, from its checkpoint
        assert s.decode([b]).tolist() == ids[b * block:(b + 1) * block].tolist()
    spoiled = bytearray(image)
    spoiled[-1] ^= 1
    with pytest.raises(ValueError):
        Segment(bytes(spoiled)).decode()


def test_skewed_ids_take_few_bits():
    ids = np.zeros(1 << 16, np.uint16)
    ids[::100] = 5
    assert len(pack_segment(ids, np.array([len(ids)]))) < 12_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=300))
def test_frequencies(counts):
    f = scaled_frequencies(np.array(counts), 12)
    assert f.sum() == 1 << 12 and f.min() >= 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aB é's. 0\n\x1c\x85 ßİΣ!"), st.characters(codec="utf-8")),
               max_size=80))
def test_ids_equal_library(text):
    ids = np.frombuffer(ENCODER.encode(text), ENCODER.type).tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["It's WE'LL '90s", "<|endoftext|> a", "x" * 3000, "éàÜß ñandú" * 50, "a\x1cb", "İΣΑΣ"])
def test_ids_of_cases(text):
    test_ids_equal_library.hypothesis.inner_test(text)


def test_files(spark, tmp_path):
    rows = [(i * 2, f"Document number {i} " * (i % 9)) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "long " * 20_000), (203, "twice"), (203, "twice")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(5)
    path = str(tmp_path / "tokens")
    write_token_files(table, path, segment_tokens=500, block_tokens=128, lanes=8)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: (r.doc_id, r.start))
    start = 0
    for r, (i, t) in zip(got, sorted(rows, key=lambda r: r[0]), strict=True):
        ids = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and bytes(r.ids) == ids.tobytes()
        start += len(ids)


def test_empty_table(spark, tmp_path):
    table = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(table, str(tmp_path / "none"))
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_a_word_is_remembered_once_as_piece_and_part():
    encoder = WordEncoder(PATH)
    for text in ["words", "words, words'", "Word. A; ., : é. WORDS!", "Words", "it's 42 Straße ¿qué?", "''s -'s"] * 2:
        ids = encoder.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.type).tolist() == ids
    memos = [m for m in vars(encoder).values() if hasattr(m, "young")]
    assert sum("words" in m.young for m in memos) == 1
