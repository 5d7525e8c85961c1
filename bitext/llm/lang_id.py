"""Language identification with a blended-spectrum presence kernel.

A text is the set of its character n-grams of one to three symbols (letters as
code points, lower case; a run of other characters is one separator). An n-gram is
one 64-bit number that holds its code points, 21 bits each, so different n-grams of
any script differ. The kernel of two texts is the size of the sets' intersection over
the root of the product of their sizes. ``LANDMARKS`` training texts span the Nyström
feature space; a ridge regression per language (one against the rest, targets +1 and
-1) is solved in it. Scoring a batch is two matrix products: gram presence x
landmarks, then kernel rows x weights.

Training rows: at most about ``PER_LANGUAGE`` texts of each language, chosen by a
hash of the id, from rows whose crc32(doc_id as text) mod 4 is not 2 and whose
lang is known (``PER_LANGUAGE`` is the documented bound of the sample). Landmarks are
each language's first texts by another hash, of those with at most ``LANDMARK_GRAMS``
n-grams (or its smallest one), so the model's size is bounded in any script.

Defined results
* NULL text, or text without a letter: ``und``, score 0.
* No training rows at all: every text is ``und``. One language: always that one.
* Ties go to the language that sorts first.
* NULL doc_id: not held out, never a training row.
* Extra columns are not read. Empty tables give no rows; repeated rows are scored alike.

Scale: one scan for the language counts, one for the sample, one for scoring;
nothing is shuffled but counts. The model has a fixed number of landmarks.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, load_table, map_rows, worker_cache

ORDER = 3
SYMBOL_BITS = 21
PER_LANGUAGE = 500
LANDMARKS = 192
RIDGE = 1e-2
LANDMARK_GRAMS = 2_000
BATCH = 256
#: Cells of a batch's presence matrix.
BATCH_CELLS = 1 << 24


def letter_table() -> np.ndarray:
    """Is a code point a letter?"""
    table = worker_cache().get("letters")
    if table is None:
        table = worker_cache()["letters"] = np.fromiter(
            (unicodedata.category(chr(p))[0] == "L" for p in range(0x110000)), bool, 0x110000)
    return table


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of ``text`` as numbers, sorted; empty without a letter.

    A letter is its code point plus 2, a separator 1; 0 stands before shorter n-grams.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter_table()[points]
    if not letters.any():
        return np.empty(0, np.int64)
    s = np.r_[1, np.where(letters, points.astype(np.int64) + 2, 1), 1]
    s = s[np.r_[True, (s[1:] != 1) | (s[:-1] != 1)]]
    two = (s[:-1] << SYMBOL_BITS) + s[1:]
    three = (two[:-1] << SYMBOL_BITS) + s[2:]
    return np.unique(np.concatenate([s, two, three]))


class KernelModel:
    """Landmark gram sets and the folded weights."""

    def __init__(self, langs, columns, landmarks, weights):
        self.langs, self.columns, self.landmarks, self.weights = langs, columns, landmarks, weights

    def batch(self) -> int:
        return max(1, min(BATCH, BATCH_CELLS // max(1, len(self.columns))))

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        presence = np.zeros((len(sets), len(self.columns)), np.float32)
        for row, own in zip(presence, sets):
            at = np.minimum(np.searchsorted(self.columns, own), len(self.columns) - 1)
            row[at[self.columns[at] == own]] = 1
        sizes = np.sqrt(np.maximum(1, [len(s) for s in sets]))
        return presence @ self.landmarks / sizes[:, None]

    def predict(self, texts: list) -> list[tuple[str, float]]:
        out = []
        step = self.batch()
        for lo in range(0, len(texts), step):
            sets = [grams(t) if t else np.empty(0, np.int64) for t in texts[lo:lo + step]]
            scores = self.kernel(sets) @ self.weights
            best = scores.argmax(axis=1)
            sure = np.clip((scores[np.arange(len(sets)), best] + 1) / 2, 0, 1)
            out += [(self.langs[b], float(p)) if len(s) else ("und", 0.0) for s, b, p in zip(sets, best, sure)]
        return out


def fit(rows: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel | None:
    """Model of ``(lang, gram set)`` rows; None without rows."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    by_lang = {lang: [s for name, s in rows if name == lang] for lang in langs}
    share = max(1, landmarks // len(langs))
    chosen = [s for lang in langs
              for s in [s for s in by_lang[lang] if len(s) <= LANDMARK_GRAMS][:share] or [min(by_lang[lang], key=len)]]
    columns = np.unique(np.concatenate(chosen))
    matrix = np.zeros((len(columns), len(chosen)), np.float32)
    for j, s in enumerate(chosen):
        matrix[np.searchsorted(columns, s), j] = 1 / np.sqrt(len(s))
    model = KernelModel(langs, columns, matrix, None)
    sets, step = [s for _, s in rows], model.batch()

    def against_landmarks(sets):
        return np.concatenate([model.kernel(sets[i:i + step]) for i in range(0, len(sets), step)]).astype(np.float64)

    k = against_landmarks(sets)
    value, vector = np.linalg.eigh(against_landmarks(chosen))
    kept = value > 1e-6 * value[-1]
    root = vector[:, kept] / np.sqrt(value[kept])
    z = k @ root
    y = np.where(np.array([r[0] for r in rows])[:, None] == np.array(langs), 1.0, -1.0)
    weight = 1 / np.sqrt([[len(by_lang[r[0]])] for r in rows])  # languages count alike
    a = (z * weight).T @ (z * weight) + ridge * np.eye(z.shape[1])
    model.weights = (root @ np.linalg.solve(a, (z * weight).T @ (y * weight))).astype(np.float32)
    return model


def training_rows(documents: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray]]:
    """``(lang, grams)`` of the sample, by language and a hash of doc_id."""
    known = documents.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL").where(
        crc_mod("doc_id", 4) != 2)
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return []
    units = 1 << 24
    share = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, min(units, units * per_language // n + 1))])
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(units)) < share[F.col("lang")])

    def make():
        def work(places, texts, langs):
            yield {"place": places, "lang": langs, "grams": [grams(t).tobytes() for t in texts]}

        return work

    found = map_rows(picked, [F.xxhash64("doc_id", F.lit(11)).alias("place"), "text", "lang"],
                     "place long, lang string, grams binary", make).collect()
    return [(r.lang, np.frombuffer(r.grams, np.int64)) for r in sorted(found, key=lambda r: (r.lang, r.place, r.grams))]


def identify_languages(documents: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row."""
    model = fit(training_rows(documents, per_language))
    shared = documents.sparkSession.sparkContext.broadcast(
        model and (model.langs, model.columns, model.landmarks, model.weights))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def make():
        parts = shared.value
        own = KernelModel(*parts) if parts else None

        def work(doc_ids, texts, held_out):
            found = own.predict(texts) if own else [("und", 0.0)] * len(texts)
            yield {"doc_id": doc_ids, "held_out": held_out, "lang_pred": [f[0] for f in found],
                   "score": [f[1] for f in found]}

        return work

    return map_rows(documents, ["doc_id", "text", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")],
                    f"doc_id {kind}, held_out boolean, lang_pred string, score double", make)


def op9_language_id(spark, sf_dir):
    return identify_languages(load_table(spark, sf_dir, "documents"))
