"""op13: posting lists against a full comparison."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitext.llm import vector_search as V

SCHEMA = "vec_id long, embedding array<float>, label int, v string, list int"


def full(rows, k=20, every=20):
    seen = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            seen[i] = np.float32(v).astype(np.float64)
    width = max((len(v) for v in seen.values()), default=0)
    ids = np.array(sorted(seen))
    m = np.stack([np.pad(seen[i], (0, width - len(seen[i]))) for i in ids]) if len(ids) else np.zeros((0, 0))
    out = {}
    for at, i in enumerate(ids):
        if i % every == 0:
            score = (m * m[at]).sum(axis=1)
            score[at] = np.nan
            order = [j for j in np.lexsort((ids, -score)) if j != at][:k]
            out[int(i)] = [(int(ids[j]), score[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        got = out.setdefault(r.query_id, [])
        got.append((r.vec_id, r.score))
        assert r["rank"] == len(got)
    return out


def table(n=3000, dims=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims))
    x = centres[rng.integers(0, 30, n)] + 0.6 * rng.normal(size=(n, dims))
    return [(i, [float(np.float32(c)) for c in v], 1, "x", 2) for i, v in enumerate(x)]


def search(spark, rows, **options):
    return found(V.nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0, index_options=options or None))


def test_recall_order_and_scores(spark):
    rows = table()
    got, want = search(spark, rows), full(rows)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    vectors = {r[0]: np.float32(r[1]).astype(np.float64) for r in rows}
    for q, answers in got.items():
        assert len(answers) == 20 and answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        for i, score in answers:
            assert score == pytest.approx(vectors[q] @ vectors[i], abs=1e-9)


def test_equal_vectors_and_bad_rows(spark):
    rows = table(400)
    same = rows[7][1]
    rows += [(1000 + i, same, 1, None, None) for i in range(300)]  # ties go to the smaller id
    rows += [(2000, None, 1, None, None), (2020, [], 1, None, None), (2040, [0.0] * 24, 1, None, None),
             (2060, [None] + [1.0] * 23, 1, None, None), (2080, [float("nan")] * 24, 1, None, None),
             (2100, [float("inf")] * 24, 1, None, None), (None, same, 1, None, None), (2120, [1.0, 2.0], 1, None, None),
             (2140, [float(x) for x in np.float32(np.array(same) * 1e18)], 1, None, None)]
    rows += [rows[0]]
    got, want = search(spark, rows, list_size=16), full(rows)
    assert got.keys() == want.keys()
    for q in (1000, 1020, 1280):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_lists_grow_in_parts(spark, monkeypatch):
    monkeypatch.setattr(V, "PART_ROWS", 16)
    rows = table(600)
    got, want = search(spark, rows, max_lists=4), full(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_few_rows(spark):
    rows = [(20 * i, [1.0, float(i)], 1, None, None) for i in range(5)]
    got, want = search(spark, rows), full(rows)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}
    assert search(spark, []) == {}
    assert search(spark, [(20, None, 1, None, None)]) == {}
    assert search(spark, rows[:1]) == {}


def test_leaves_are_balanced():
    points = np.random.default_rng(2).normal(size=(1000, 8)).astype(np.float32)
    assert V.balanced_centroids(points, 37).shape == (37, 8)
    assert V.balanced_centroids(np.ones((50, 3), np.float32), 7).shape == (7, 3)


def test_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(4)
    c = rng.normal(size=(500, 12)).astype(np.float32)
    index = V.Index(11, 1.0, c)
    p = rng.normal(size=(200, 12)).astype(np.float32)
    ids, dist = index.walk(p, 32)
    true = np.argsort(((p[:, None, :] - c[None]) ** 2).sum(axis=2), axis=1)[:, :8]
    assert (np.diff(dist, axis=1) >= 0).all()
    assert np.mean([len(set(a) & set(b)) / 8 for a, b in zip(ids[:, :8], true)]) > 0.95


def test_rows_handed_on_do_not_grow_with_the_blocks(spark, monkeypatch):
    rng = np.random.default_rng(11)  # without structure: a query reads all lists
    x = rng.normal(size=(2000, 24))
    rows = [(i, [float(np.float32(c)) for c in v], 1, "x", 2) for i, v in enumerate(x)]
    monkeypatch.setattr(V, "BLOCK_LISTS", 4)
    monkeypatch.setattr(V, "WALK_SHARE", 1.0)
    monkeypatch.setattr(V, "PROBE_RATIO", 100.0)
    made, compared = [], V._compared
    monkeypatch.setattr(V, "_compared", lambda *a: made.append(compared(*a)) or made[-1])
    got, want = search(spark, rows, list_size=20), full(rows)
    handed = sum(df.count() for df in made)
    # 25 blocks, 21 classes of each: 525 rows a query without the waves' bounds.
    assert len(made) == 3 and handed <= 260 * len(want)
    for q, answers in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in answers]


def test_ties_at_the_bound_of_a_wave_keep_the_smallest_ids(spark, monkeypatch):
    rng = np.random.default_rng(12)  # small integers: many equal inner products, many of them zero
    x = np.unique(rng.integers(-1, 2, (1200, 8)), axis=0)
    rng.shuffle(x)
    rows = [(i, [float(c) for c in v], 1, "x", 2) for i, v in enumerate(x)]
    monkeypatch.setattr(V, "BLOCK_LISTS", 4096)  # one block, one wave
    whole = search(spark, rows, list_size=20)
    monkeypatch.setattr(V, "BLOCK_LISTS", 8)
    assert search(spark, rows, list_size=20) == whole and len(whole) == -(-len(rows) // 20)
