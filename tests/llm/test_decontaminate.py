"""Aho-Corasick decontamination against window-by-window comparison."""
import random
import re

import pytest

from bitext.llm.decontaminate import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        if i is not None:
            for k in range(len(w) - n + 1 if w else 0):
                wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for win, owners in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    ids |= owners
        out.append((d, len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables():
    rnd = random.Random(3)
    vocab = ["Alpha", "beta", "Éa", "naïve", "x1", "42", "the", "of"]
    make = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(1, make(30)), (2, "Short Question?"), (3, None), (4, ""), (5, "!!!"), (None, make(20)), (6, make(13)),
             (10, "short, question")]
    docs = [(i, make(rnd.randrange(0, 60))) for i in range(30)]
    docs += [(100, items[0][1].upper().replace(" ", "--")), (101, make(300) + " " + items[0][1] + "\n" + make(5)),
             (102, "SHORT\tquestion"), (103, None), (104, ""), (105, "... "), (106, items[6][1] * 2),
             (106, items[6][1] * 2), (None, "short question " * 3)]
    return docs, items


@pytest.mark.parametrize("block_chars", [4_000_000, 60])
def test_equals_brute_force(spark, block_chars):
    docs, items = tables()
    d = spark.createDataFrame([(*r, "v") for r in docs], "doc_id long, text string, item_ids string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = decontaminate(d, b, block_chars=block_chars).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got),
                  key=str) == brute(docs, items)
    texts = dict(docs)
    for r in got:
        if r.doc_id is not None and r.doc_id != 106:
            spanned = [w for s in r.spans for w in words(texts[r.doc_id][s.start:s.end])]
            assert len(spanned) == r.n_hit


def test_empty_tables(spark):
    docs, items = tables()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(d.limit(0), b).count() == 0
    assert {r.n_hit for r in decontaminate(d, b.limit(0)).collect()} == {0}
