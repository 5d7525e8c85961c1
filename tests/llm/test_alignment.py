"""op12: token alignment against a plain per-document computation."""

import hashlib
from collections import Counter, defaultdict

import pytest

from bitext.llm import alignment as A

SCHEMA = "doc_id long, text string, row int, pairs string"
TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "", None, " ", "two  blanks and\ttabs\n\nlines", "Straße, naïve café — 漢字かな 😀",
    "a▁b is rewritten by the piece model", "<|endoftext|> and <s> are plain text", "é combining", "x" * 3000,
    "word " * 5000, "    mixed", "The quick brown fox jumps over the lazy dog.", "1234567890" * 20,
]


@pytest.fixture(scope="module")
def rows():
    return [(i, t, 1, "p") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 2, None), (None, "no id here", None, None)]


def brute(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from bitext.llm.bpe import byte_alphabet

    a_side = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a_side.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_alphabet())}
    b_side = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    found, holders = [], defaultdict(set)
    for number, (doc_id, text, *_rest) in enumerate(rows):
        a = b = []
        if text:
            raw = (" " + text).encode()
            e = a_side.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(back[c] for c in a_side.id_to_token(i))) for i in e.ids]
            b = [(i, A.piece_bytes(b_side.id_to_piece(i))) for i in b_side.encode(text)]
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a = b = []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, j0 = [], 0
        for i, lo, hi in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][2] <= lo:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][1] < hi:
                links.append((i, spans[1][j][0]))
                j += 1
        cuts = sorted({s[2] for s in spans[0]} & {s[2] for s in spans[1]})
        groups, lo = [], 0
        for hi in cuts:
            sides = [",".join(str(i) for i, _s, e in side if lo < e <= hi) for side in spans]
            groups.append("|".join(sides))
            lo = hi
        for pair in links:
            holders[pair].add(number)
        found.append((doc_id, spans, links, groups))
    count = {p: len(d) for p, d in holders.items()}
    most = Counter()
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return Counter(
        (doc_id, len(spans[0]), len(spans[1]), len(groups), len(links), sum(count[p] == most[p[0]] for p in links),
         sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc_id, spans, links, groups in found)


@pytest.mark.parametrize("hot_pairs", [0, 40, 1 << 20])
def test_equals_plain_computation(spark, rows, hot_pairs):
    got = A.alignment_statistics(spark.createDataFrame(rows, SCHEMA), hot_pairs=hot_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_small_slices(spark, rows, monkeypatch):
    monkeypatch.setattr(A, "SLICE_CHARS", 50)
    monkeypatch.setattr(A, "FLUSH_PAIRS", 20)
    monkeypatch.setattr(A, "LIST_PAIRS", 3)
    got = A.alignment_statistics(spark.createDataFrame(rows, SCHEMA))
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_empty_table(spark):
    assert A.alignment_statistics(spark.createDataFrame([], SCHEMA)).collect() == []
    only_null = spark.createDataFrame([(1, None, 1, None)], SCHEMA)
    assert [tuple(r) for r in A.alignment_statistics(only_null).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
