"""Removed windows against window-by-window comparison, and the FM-index by itself."""
import random
import re

import numpy as np
import pytest

from bitext.llm import substring_dedup as sd

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, window):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    make = lambda n: [rnd.choice("abcdefgh") + rnd.choice("éxyz") for _ in range(n)]
    passages = [make(60), make(55), make(120), ["spam"] * 90]
    docs = []
    for _ in range(40):
        w = make(rnd.randrange(0, 80))
        for _ in range(rnd.randrange(0, 3)):
            p = rnd.choice(passages)
            cut = rnd.randrange(0, 15)
            w += p[cut:len(p) - rnd.randrange(0, 8)] + make(rnd.randrange(0, 9))
        docs.append(rnd.choice([" ", "\n", "\t \r"]).join(w))
    docs += [docs[3], docs[3] + " tail", "", None, " ", " ".join(["spam"] * 300), " ".join(make(30_000))]
    return [(i * 2, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed, hot", [(1, 3000), (2, 2)])
def test_equals_brute_force(spark, seed, hot):
    docs = corpus(seed) + [(None, corpus(seed)[3][1]), (4, "spam " * 100)]
    table = spark.createDataFrame([(*r, "e") for r in docs], "doc_id long, text string, first string").repartition(5)
    got = sd.remove_repeats(table, shard_words=2_000, hot_slices=hot).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute(docs, 50)


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 5, 8])
def test_fm_index_owners(depth):
    rnd = random.Random(depth)
    for _ in range(30):
        seqs = [np.array([rnd.randrange(3) for _ in range(rnd.randrange(depth, 25))], np.uint64)
                for _ in range(rnd.randrange(1, 12))]
        owners = np.array([rnd.randrange(6) for _ in seqs])
        best = {}
        for s, o in zip(seqs, owners.tolist()):
            for k in range(len(s) - depth + 1):
                key = tuple(s[k:k + depth].tolist())
                best[key] = min(best.get(key, o), o)
        found = sd.FmIndex(seqs, owners, depth).window_owners()
        for s, f in zip(seqs, found):
            assert f.tolist() == [best[tuple(s[k:k + depth].tolist())] for k in range(len(s) - depth + 1)]


def test_wavelet_ranks():
    rnd = np.random.default_rng(4)
    seq = rnd.integers(0, 37, 500)
    tree = sd.WaveletMatrix(seq, 36)
    for symbol in range(37):
        at = rnd.integers(0, 501, 20)
        assert tree.rank(np.full(20, symbol), at).tolist() == [int((seq[:a] == symbol).sum()) for a in at]


def test_equal_windows_pick_equal_anchors():
    rnd = np.random.default_rng(6)
    core = rnd.integers(0, 2**63, 80).astype(np.uint64)
    runs = []
    for pad in (3, 17):
        words = np.r_[rnd.integers(0, 2**63, pad).astype(np.uint64), core]
        anchors, first, count = sd.slices_of(words)
        runs.append(np.repeat(anchors, count)[pad:])
        assert int(count.sum()) == len(words) - 49
    assert runs[0].tolist() == runs[1].tolist()
