"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives about twenty numbers (shares of character classes, word and line
statistics, repetition). Each is cut into at most ``BINS`` bins. Cyclic boosting
fits, feature by feature and round after round, shallow trees (at most four
leaves over the bins) to the gradient of the logistic loss; a feature's trees add
up to one lookup table. The strongest pairs of features are then boosted in the
same way on a coarser grid. A score is the sum of the looked-up values,
vectorised over rows, through the logistic function.

Training rows: at most ``MAX_ROWS`` labelled documents, the smallest by a hash of
doc_id, from rows whose crc32(doc_id as text) mod 3 is not 1. Only features of
the text enter a score.

Defined results
* NULL and empty text: all numbers 0, scored like any other.
* Repeated labels of a document: the mean decides (half counts as 1); NULL labels
  and labels without a document are ignored.
* No training rows, or one class only: the score is that class's share (0.5 without rows).
* NULL doc_id: not held out, never a training row.
* Extra columns are not read.

Scale: no shuffle of text; the sampled ids are broadcast (bounded by
``MAX_ROWS``) and the model is a few kilobytes.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, load_table, map_rows

MAX_ROWS = 12_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 40, 6
RATE, LEAST_WEIGHT = 0.15, 5.0

FEATURES = ["log_chars", "log_words", "word_length", "upper", "digits", "signs", "marks", "sign_kinds", "non_ascii",
            "pipes", "shouts", "symbol_words", "unique_words", "top_word", "repeats", "near_repeats", "log_lines",
            "line_words", "repeated_lines", "short_words"]

_CLASS = np.full(128, 4, np.uint8)  # 0 space 1 lower 2 upper 3 digit 4 control 5 mark 6 sign
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _CLASS[_c] = 5 if chr(_c) in ".,;:'\"()-?" else 6
_SIGNED = re.compile(r"[^\W_][^\w\s.,;:'\"()?-]+(?:\s|$)")


def features(text: str | None) -> list[float]:
    """The numbers of one text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    ascii_counts = np.bincount(raw, minlength=256)
    other = int(ascii_counts[192:].sum())  # lead bytes: one per non-ASCII character
    by_class = np.bincount(_CLASS, weights=ascii_counts[:128], minlength=7)
    solid = max(1.0, by_class[1:].sum() + other)
    letters = max(1.0, by_class[1] + by_class[2] + other)
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    n_lines = max(1, len(lines))
    return [
        float(np.log1p(len(text))), float(np.log1p(len(words))), solid / n, by_class[2] / letters, by_class[3] / solid,
        by_class[6] / solid, by_class[5] / solid, float((ascii_counts[:128][_CLASS == 6] > 0).sum()), other / solid,
        ascii_counts[124] / n, ascii_counts[33] / n, len(_SIGNED.findall(text)) / n,
        len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n, sum(map(str.__eq__, words, words[2:])) / n,
        float(np.log1p(len(lines))), len(words) / n_lines, 1 - len(set(lines)) / n_lines,
        sum(len(w) <= 2 for w in words) / n]


# --- model -----------------------------------------------------------------------
def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Newton steps of a tree of at most four leaves over ordered bins."""
    cg, ch = np.r_[0, np.cumsum(g)], np.r_[0, np.cumsum(h)]

    def cut(lo, hi):
        if hi - lo < 2:
            return None
        lg, lh = cg[lo + 1:hi] - cg[lo], ch[lo + 1:hi] - ch[lo]
        rg, rh = cg[hi] - cg[lo + 1:hi], ch[hi] - ch[lo + 1:hi]
        gain = np.where((lh >= LEAST_WEIGHT) & (rh >= LEAST_WEIGHT), lg ** 2 / (lh + 1) + rg ** 2 / (rh + 1), -1.0)
        best = int(gain.argmax())
        whole = (cg[hi] - cg[lo]) ** 2 / (ch[hi] - ch[lo] + 1)
        return lo + 1 + best if gain[best] > whole else None

    cuts, first = {0, len(g)}, cut(0, len(g))
    if first is not None:
        cuts |= {c for c in (first, cut(0, first), cut(first, len(g))) if c is not None}
    out = np.zeros(len(g))
    edges = sorted(cuts)
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = (cg[hi] - cg[lo]) / (ch[hi] - ch[lo] + 1)
    return out


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, intercept: float, edges=(), tables=(), pairs=(), pair_edges=(), pair_tables=()):
        self.intercept, self.edges, self.tables = intercept, edges, tables
        self.pairs, self.pair_edges, self.pair_tables = pairs, pair_edges, pair_tables

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a = np.searchsorted(self.pair_edges[i], x[:, i], side="right")
            b = np.searchsorted(self.pair_edges[j], x[:, j], side="right")
            total += table[a, b]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return AdditiveModel(float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    base = float(np.log(y.mean() / (1 - y.mean())))
    m = x.shape[1]
    edges = [_edges(x[:, j], BINS) for j in range(m)]
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(m):
            g, h = gradients()
            size = len(tables[j])
            step = RATE * _tree(np.bincount(binned[j], g, size), np.bincount(binned[j], h, size))
            tables[j] += step
            total += step[binned[j]]

    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(m)]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]
    g, h = gradients()

    def strength(i, j):
        width = len(coarse[j]) + 1
        key = cells[i] * width + cells[j]
        sg, sh = np.bincount(key, g), np.bincount(key, h)
        return float((sg ** 2 / (sh + LEAST_WEIGHT)).sum())

    ranked = sorted(((strength(i, j), i, j) for i in range(m) for j in range(i)), reverse=True)
    pairs = [(i, j) for _, i, j in ranked[:PAIRS]]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables):
            g, h = gradients()
            sg, sh = np.zeros_like(table), np.zeros_like(table)
            np.add.at(sg, (cells[i], cells[j]), g)
            np.add.at(sh, (cells[i], cells[j]), h)
            # a tree over i in each half of j: four leaves at most per half
            half = table.shape[1] // 2
            for part in (slice(0, half), slice(half, None)):
                if sg[:, part].size:
                    table_step = RATE * _tree(sg[:, part].sum(axis=1), sh[:, part].sum(axis=1))[:, None]
                    table[:, part] += table_step
                    inside = (cells[j] < half) if part.start == 0 else (cells[j] >= half)
                    total[inside] += table_step[cells[i][inside], 0]
    return AdditiveModel(base, edges, tables, pairs, coarse, pair_tables)


# --- jobs --------------------------------------------------------------------------
def labelled_ids(labels: DataFrame, label: str, modulus: int, held_out: int, rows: int | None = None) -> DataFrame:
    """``doc_id, label`` of the training documents; of at most ``rows`` if given."""
    found = (labels.select("doc_id", F.col(label).cast("double").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL").where(crc_mod("doc_id", modulus) != held_out)
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    return found if rows is None else found.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(rows)


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> AdditiveModel:
    picked = documents.select("doc_id", "text").join(
        F.broadcast(labelled_ids(labels, "quality", 3, 1, max_rows)), "doc_id")

    def make():
        def work(doc_ids, texts, marks):
            yield {"doc_id": [str(d) for d in doc_ids], "label": marks, "x": [features(t) for t in texts]}

        return work

    rows = sorted(map_rows(picked, ["doc_id", "text", "label"], "doc_id string, label int, x array<double>",
                           make).collect(), key=lambda r: (r.doc_id, r.x))
    return fit(np.array([r.x for r in rows], float).reshape(-1, len(FEATURES)), np.array([r.label for r in rows], float))


def score_quality(documents: DataFrame, labels: DataFrame, columns: list[str] = (),
                  max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, <columns>, held_out, score, predicted`` per row."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(train(documents, labels, max_rows)))
    fields = documents.select("doc_id", *columns).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def make():
        model = AdditiveModel(**shared.value)

        def work(doc_ids, texts, held_out, *rest):
            scores = model.scores(np.array([features(t) for t in texts]))
            yield {"doc_id": doc_ids, "held_out": held_out, "score": scores.tolist(),
                   "predicted": (scores >= 0.5).astype(int).tolist()} | dict(zip(columns, rest))

        return work

    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("_held_out")
    return map_rows(documents, [F.col("doc_id"), F.col("text"), held, *map(F.col, columns)],
                    f"{ddl}, held_out boolean, score double, predicted int", make)


def op3_quality(spark, sf_dir):
    return score_quality(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels"))
