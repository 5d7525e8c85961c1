"""Components of the shingle join against all-pairs comparison."""
import random
import re

import numpy as np
import pytest

from bitext.llm import graph
from bitext.llm import similarity_join as sj
from bitext.llm.graph import connected_components

NO_FILTER = (16, *(np.zeros(sj.FILTER_BITS // 8, np.uint8) for _ in range(2)))
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    top = {i: i for i, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return sorted(((i, len(shingles(t)), None if i is None else find(i)) for i, t in docs), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("klmnopq") + rnd.choice(["", "É", "x", "yz"])
    make = lambda n: [word() for _ in range(n)]
    docs, passage = [], make(40)
    for _ in range(12):
        base = make(rnd.choice([3, 5, 6, 9, 14, 30, 80, 200]))
        for _ in range(rnd.randrange(1, 7)):  # edited copies around the threshold
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(copy) // 40 + 2))):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.4:
                copy = copy[:len(copy) - len(copy) // rnd.choice([6, 10, 20])]
            docs.append(" ".join(copy))
    docs += [" ".join(make(60) + passage) for _ in range(15)] + ["   ", "", None, "one", "ONE", "one two", "a b c d e"] * 2
    rnd.shuffle(docs)
    return [(i * 3, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = corpus(seed) + [(None, "one"), (10_000, "x y z " * 30_000), (10_001, "x y z " * 30_000)]
    table = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, key int").repartition(5)
    assert sorted((tuple(r) for r in sj.similar_components(table).collect()), key=str) == brute(docs)


def test_every_link_shares_a_key():
    rnd = random.Random(5)
    for n in [4, 5, 7, 9, 12, 20, 45, 100, 300]:
        for _ in range(20):
            a = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64))
            lost = rnd.randrange(0, n // 5 + 1)
            b = np.unique(np.r_[a[lost:], np.array([rnd.getrandbits(64) for _ in range(rnd.randrange(0, n // 6 + 1))],
                                                   np.uint64)])
            if sj.linked(a, b) and len(np.setxor1d(a, b)):
                assert np.intersect1d(sj.join_keys(a, NO_FILTER), sj.join_keys(b, NO_FILTER)).size
                assert sj.sketch_distance(sj.parity_sketch(a), sj.parity_sketch(b)) <= len(np.setxor1d(a, b))


def test_cross_pairs_keep_every_link():
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(300)]
    sets = [np.unique(np.array([rnd.getrandbits(64) if rnd.random() < 0.04 * (k % 6) else x
                                for x in base[:rnd.randrange(200, 300)]], np.uint64)) for k in range(60)]
    component = np.array([k % 7 for k in range(60)])
    sizes, sketches = np.array([len(x) for x in sets]), [sj.parity_sketch(x) for x in sets]
    for side in (None, np.array([k % 2 == 0 for k in range(60)])):
        found = {tuple(sorted(p)) for p in sj.cross_pairs(component, sizes, sketches, side).tolist()}
        for i in range(60):
            for j in range(i):
                fits = component[i] != component[j] and (side is None or side[i] != side[j])
                assert ((j, i) in found) >= (fits and sj.linked(sets[i], sets[j]))
                assert ((j, i) not in found) or fits


@pytest.mark.parametrize("rounds, block", [(0, 7), (2, 2048)])
def test_near_threshold_family(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(sj, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(sj, "BLOCK_SETS", block)
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(120):
        copy = list(base)
        for _ in range(rnd.randrange(1, 8)):
            copy[rnd.randrange(150)] = f"z{i}"
        docs.append((i, " ".join(copy)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, sj.similar_components(table).collect()), key=str) == brute(docs)


def test_packed_numbers():
    for values in ([], [0], [5, 5, 9, 2**32 - 1]):
        v = np.array(values, np.uint32)
        assert sj.unpack_sorted(sj.pack_sorted(v)).tolist() == values


def test_large_group_of_near_copies(spark):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    docs = []
    for i in range(300):
        copy = list(base)
        copy[rnd.randrange(100)] = f"z{i}"
        docs.append((i, " ".join(copy)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.component_id for r in sj.similar_components(table).collect()} == {0}


def test_empty_table_and_shared_ids(spark):
    table = spark.createDataFrame([(5, "a b c d e f g"), (5, "other words than before"), (3, "other words than before")],
                                  "doc_id long, text string")
    assert sj.similar_components(table.limit(0)).count() == 0
    assert {r.component_id for r in sj.similar_components(table).collect()} == {3}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 75), (7, 7), (None, 3), (200, 201)] * 2
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 50, 50: 50, 75: 50, 200: 200, 201: 200}


@pytest.mark.parametrize("block, writes", [(50_000, 2), (100, 12)])
def test_a_chain_needs_few_rounds(spark, monkeypatch, block, writes):
    made, write = [], graph.written_table
    monkeypatch.setattr(graph, "BLOCK_LINKS", block)
    monkeypatch.setattr(graph, "written_table", lambda df, name: made.append(name) or write(df, name))
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(300)] + [("x", "y"), ("y", "x"), ("n300", "n000")]
    random.Random(4).shuffle(links)
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a string, b string")).collect()))
    assert got == {**{f"n{i:03}": "n000" for i in range(301)}, "x": "x", "y": "x"}
    assert len(made) <= writes
