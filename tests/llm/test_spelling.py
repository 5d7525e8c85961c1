"""op11: spelling variants against a brute-force grouping."""

import random
import re
import zlib
from collections import Counter

import pytest

from bitext.llm import spelling as S

SCHEMA = "doc_id long, text string, word string, chunk int"


def edit_is_one(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(words: dict) -> dict:
    near = {w: [v for v in words if edit_is_one(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, form[w], None if form[w] is None else words[form[w]], root, len(near[w]))
    return out


def brute_counts(rows) -> dict:
    upper = {i: chr(i + 32) for i in range(65, 91)}
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def as_dict(df) -> dict:
    rows = df.collect()
    out = {r.word: (r.n, r.form, r.form_n, r.root, r.n_near) for r in rows}
    assert len(out) == len(rows)
    return out


def documents(seed=3):
    rng = random.Random(seed)
    stems = ["holder", "folder", "garden", "étoile", "ÉTOILE", "straße", "running", "abcdefghij", "aaaaaaaa", "Hôtel"]
    rows = []
    for i in range(150):
        words = []
        for _ in range(40):
            w = rng.choice(stems)
            if rng.random() < 0.5:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("aeé") + w[at:],
                                w[:at] + rng.choice("xyz") + w[at + 1:]])
            words.append(w)
        rows.append((i, rng.choice([" ", ", ", "1", "\n"]).join(words), None, 7))
    rows += [(900, None, "x", 1), (901, "", None, None), (902, "123 !?", None, 1), (None, "garden garden garten", None, 1)]
    rows += [rows[0], rows[0]]  # repeated rows count as often as they are there
    rows.append((903, "longletters" * 4000 + " " + "longletters" * 4000, None, 1))
    return rows


@pytest.fixture(scope="module")
def words(spark):
    rows = documents()
    counted = S.count_words(spark.createDataFrame(rows, SCHEMA), change=S.with_deletions)
    return {r.word: r.n for r in counted.collect()}, brute_counts([r[:2] for r in rows])


def test_counts(words):
    assert words[0] == words[1] and len(words[1]) > 100


@pytest.mark.parametrize("hot_key", [0, 3, 400])
def test_near_pairs_whatever_is_hot(spark, words, hot_key):
    table = spark.createDataFrame(list(words[1].items()), "word string, n long")
    found = S.near_pairs(table, hot_key).collect()
    pairs = {frozenset((r.a, r.b)) for r in found}
    assert len(pairs) == len(found)
    assert pairs == {frozenset((a, b)) for a in words[1] for b in words[1] if edit_is_one(a, b)}


def test_groups_equal_brute_force(spark, words):
    table = spark.createDataFrame(list(words[1].items()), "word string, n long")
    assert as_dict(S.spelling_groups(table)) == brute(words[1])


def test_ties_and_chains(spark):
    rows = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "zzzzz": 1, "zzzzy": 9, "zzzyz": 9, "alone": 5}
    got = as_dict(S.spelling_groups(spark.createDataFrame(list(rows.items()), "word string, n long")))
    assert got == brute(rows)
    assert got["aaaaa"][3] == "abbbb" and got["zzzzz"][1] == "zzzyz"


def test_empty(spark):
    assert S.spelling_groups(S.count_words(spark.createDataFrame([], SCHEMA))).collect() == []
