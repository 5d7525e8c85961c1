"""Toxicity with class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary training documents, give each word a
likelihood. A class has its own discounted word counts (documents with the word);
the discounted mass goes to lower orders that both classes share: a Kneser-Ney
model of the word's letters, with continuation counts (in how many different
longer letter runs a run ends) from all documents, labelled or not. A word rare
in a class is thus smoothed by what the whole corpus knows, equally for both. A word's
evidence is the difference of its two log-likelihoods. Its distance from the
evidence of a word without class counts is weighted by n / (n + ``RELIABLE``), n
its documents in both classes: one document says little, but never nothing.

A text's evidence is length-normalised: the mean over its words, and the mean over
its ``STRONGEST`` strongest different words (a few insults in a long text). A
logistic regression turns the two into a score; it is fitted on a fold of the
training documents that gave no class counts.

Training rows: labelled documents whose crc32(doc_id as text) mod 5 is not 0. Four
fifths of them (by another hash) give class counts, all of them; at most
``FIT_ROWS`` of the rest, the smallest by hash, fit the logistic regression (the
documented bound of that sample).

Defined results
* NULL, empty and wordless text: evidence 0, scored by the regression's intercept.
* Repeated labels of a document: the mean decides; NULL labels are ignored.
* One class only, or no training rows: the score is that class's share (0 without rows).
* NULL doc_id: not held out; its text counts only for the shared orders.
* Extra columns are not read.

Scale: words are counted per task before the shuffle. The shared orders are tables
of all letter runs, joined to the runs of the words that have a class count; every
such word has its own evidence, in a table. The evidence of the ``HOT_WORDS`` most
frequent words at most is broadcast. The other words of a text, each rarer than
those, are joined to the table by word; no text is shuffled for that. So are the
letter grams: frequent ones (``held_grams``), ``HOT_GRAMS`` at most, are
broadcast. How many words and grams are broadcast does not change a result. Word counts,
evidence and measured texts are written as compressed Parquet.
"""

from __future__ import annotations

import heapq
import math
import operator
import re
import uuid
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.session import reliable_checkpoint, written_table

from ._common import crc_mod, load_table, map_rows, worker_cache
from .idfilter import split_by_ids
from .quality import labelled_ids

ORDER = 5
STRONGEST = 3
FIT_ROWS = 8_000
#: A word's evidence counts n / (n + RELIABLE), n its documents in both classes.
RELIABLE = 10
#: Words whose evidence a worker holds; that of all others is joined.
HOT_WORDS = 200_000
#: Letter grams whose probability a worker holds; that of all others is joined.
HOT_GRAMS = 200_000
COUNT_ENTRIES = 200_000
MEMO_ENTRIES = 300_000

_LETTERS = re.compile(r"[^\W\d_]+")


def pieces_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def words_of(piece: str) -> list[str]:
    """Words (letter runs) of a piece between blanks."""
    return [piece] if piece.isalpha() else _LETTERS.findall(piece)


def letter_runs(word: str) -> list[str]:
    """Runs of ``ORDER`` symbols that predict each letter of a word and its end."""
    s = " " * (ORDER - 1) + word + " "
    return [s[i:i + ORDER] for i in range(len(s) - ORDER + 1)]


# --- counts ----------------------------------------------------------------------
def count_words(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """``word, toxic, ordinary, whole``: counts over all documents; the classes'
    counts come from the documents in ``classes(doc_id, label)``."""
    # Only texts that may have a label are moved to it.
    maybe, other = split_by_ids(documents.select("doc_id", "text"), classes.select("doc_id"))
    marked = maybe.join(classes, "doc_id", "left").unionByName(
        other.withColumn("label", F.lit(None).cast(classes.schema["label"].dataType)))

    def make():
        held = [Counter(), Counter(), Counter()]  # pieces: ordinary, toxic, unlabelled

        def counted():
            words: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
            for k, pieces in enumerate(held):
                for piece, n in pieces.items():
                    for w in words_of(piece):
                        words[w][k] += n
                pieces.clear()
            return {"word": list(words), "toxic": [c[1] for c in words.values()],
                    "ordinary": [c[0] for c in words.values()], "whole": [sum(c) for c in words.values()]}

        def work(texts, labels):
            for text, label in zip(texts, labels):
                held[2 if label is None else label].update(set(pieces_of(text)))
            if sum(map(len, held)) >= COUNT_ENTRIES:
                yield counted()

        work.flush = lambda: [counted()]
        return work

    counts = map_rows(marked, ["text", "label"], "word string, toxic long, ordinary long, whole long", make)
    return counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "whole")])


def letter_grams(words: DataFrame) -> DataFrame:
    """``gram, p, n``: the shared letter model (``SharedLetters``, of all runs of all
    words): the probability of each gram's last symbol after the others, for every
    gram of ``ORDER - 1`` symbols, and the number of different symbols before it."""
    def make():
        def work(words):
            yield {"gram": list({r for w in words for r in letter_runs(w)})}

        return work

    longer, levels = map_rows(words, ["word"], "gram string", make).distinct(), []
    for size in range(ORDER - 1, 0, -1):
        longer = reliable_checkpoint(  # different runs that end in the gram
            longer.groupBy(F.substring("gram", 2, size).alias("gram")).agg(F.count("*").alias("n")))
        levels.insert(0, longer)
    found = None
    for size, level in enumerate(levels, 1):
        symbols, ones, twos = level.agg(F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
        d = discount(ones, twos)
        level = level.withColumn("context", F.substring("gram", 1, size - 1))
        contexts = level.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        if found is None:  # one context, the empty one
            level = level.join(F.broadcast(contexts), "context").withColumn("low", F.lit(1 / (max(1, symbols) + 1)))
        else:
            level = (level.join(contexts, "context").withColumn("shorter", F.substring("gram", 2, size - 1))
                     .join(found.select(F.col("gram").alias("shorter"), F.col("p").alias("low")), "shorter"))
        found = level.select("gram", (
            (F.greatest(F.col("n") - d, F.lit(0.0)) + F.lit(d) * F.col("types") * F.col("low")) / F.col("total")).alias("p"), "n")
    return found


def held_grams(grams: DataFrame, most: int) -> dict[str, float]:
    """Log-probability of frequent grams, ``most`` at most: those that begin a word (only
    blanks precede them), the shortest beginnings first, then those that most different
    symbols precede; whole classes of that order."""
    step = F.when(F.col("gram").startswith(" "), F.lit(1 << 40) - F.length(F.ltrim("gram"))).otherwise(F.col("n"))
    least, left = None, most
    for r in grams.groupBy(step.alias("step")).agg(F.count("*").alias("grams")).orderBy(F.desc("step")).collect():
        left -= r.grams
        if left < 0:
            break
        least = r.step
    if least is None:
        return {}
    return {r.gram: math.log(r.p) for r in grams.where(step >= least).select("gram", "p").collect()}


def word_evidence(counts: DataFrame, totals: list[tuple[int, int, int, int]], hot_grams: int = HOT_GRAMS) -> DataFrame:
    """``word, toxic, ordinary, whole, value``: the log-likelihood difference (as
    ``evidence_table``) of each word with a class count; the letters' part is summed
    over a word's runs. The grams a worker does not hold are joined to ``letter_grams``
    of all words."""
    grams = reliable_checkpoint(letter_grams(counts))
    shared = counts.sparkSession.sparkContext.broadcast(held_grams(grams, hot_grams))

    def make():
        held = shared.value

        def work(words, *rest):
            runs = [[r[1:] for r in letter_runs(w)] for w in words]
            yield {"known": [math.fsum(held[g] for g in own if g in held) for own in runs],
                   "open": [[g for g in own if g not in held] for own in runs]} | dict(zip(keys, (words, *rest)))

        return work

    keys = ["word", "toxic", "ordinary", "whole"]
    letters = map_rows(counts.where("toxic > 0 OR ordinary > 0"), keys,
                       "word string, toxic long, ordinary long, whole long, known double, open array<string>", make)
    letters = written_table(letters, "letters")  # its words are split in two below
    rest = (letters.where(F.size("open") > 0).select(*keys, "known", F.explode("open").alias("gram"))
            .join(grams.select("gram", "p"), "gram").groupBy(*keys, "known")
            .agg((F.col("known") + F.sum(F.log("p"))).alias("logs")))
    low = letters.where(F.size("open") == 0).select(*keys, F.col("known").alias("logs")).unionByName(
        rest.select(*keys, "logs")).select(
        *keys, F.exp(F.greatest("logs", F.lit(-700.0))).alias("low"))
    logs = []
    for name, (n, types, ones, twos) in zip(("toxic", "ordinary"), totals):
        d = discount(ones, twos)
        logs.append(F.log(F.greatest(F.col(name) - d, F.lit(0.0)) / n + F.lit(d * types / n) * F.col("low")))
    return low.select(*keys, (logs[0] - logs[1]).alias("value"))


# --- models ----------------------------------------------------------------------
def discount(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.75


class SharedLetters:
    """Interpolated Kneser-Ney model of letters, from the types of letter runs."""

    def __init__(self, runs):
        self.levels = []
        longer = set(runs)
        while longer and len(next(iter(longer))) > 1:
            counts = Counter(g[1:] for g in longer)  # different runs that end in it
            sums, types = Counter(), Counter()
            for g, n in counts.items():
                sums[g[:-1]] += n
                types[g[:-1]] += 1
            sizes = Counter(counts.values())
            self.levels.insert(0, (counts, sums, types, discount(sizes[1], sizes[2])))
            longer = set(counts)
        self.symbols = max(1, len(longer))
        self.memo: dict[str, float] = {}

    def letter(self, run: str) -> float:
        """Log-probability of the last symbol of ``run`` after the others."""
        value = self.memo.get(run)
        if value is None:
            p = 1 / (self.symbols + 1)
            for size, (counts, sums, types, d) in enumerate(self.levels, 1):
                own = run[len(run) - size:]
                total = sums.get(own[:-1], 0)
                if total:
                    p = (max(counts.get(own, 0) - d, 0) + d * types[own[:-1]] * p) / total
            value = self.memo[run] = math.log(p)
        return value

    def word(self, word: str) -> float:
        return math.exp(max(-700.0, sum(map(self.letter, letter_runs(word)))))


def evidence_table(rows: list[tuple[str, int, int]], totals: list[tuple[int, int, int, int]],
                   runs: list[str]) -> tuple[dict, float]:
    """Log-likelihood difference (toxic minus ordinary) of each word ``(word,
    toxic, ordinary)``, and of any other word. ``totals`` per class: counts,
    different words, how many were seen once and twice."""
    if not all(t[0] for t in totals):
        return {}, 0.0
    shared = SharedLetters(runs)
    d = [discount(ones, twos) for _, _, ones, twos in totals]
    back = [dk * types / n for dk, (n, types, _, _) in zip(d, totals)]
    table = {}
    for word, *counts in rows:
        low = shared.word(word)
        p = [max(c - dk, 0) / n + bk * low for c, dk, bk, (n, _, _, _) in zip(counts, d, back, totals)]
        table[word] = math.log(p[0]) - math.log(p[1])
    return table, math.log(back[0]) - math.log(back[1])


def other_evidence(totals: list[tuple[int, int, int, int]]) -> float:
    """Evidence of a word without class counts."""
    back = [discount(ones, twos) * types / n for n, types, ones, twos in totals]
    return math.log(back[0]) - math.log(back[1])


class Evidence:
    """Evidence of texts from the words a worker holds; pieces are remembered, up to
    a bound."""

    def __init__(self, table: dict):
        self.table, self.memo = table, {}

    def piece(self, piece: str) -> float | None:
        """Evidence of a piece; None if a word of it is not held."""
        values = [self.table.get(w) for w in words_of(piece)]
        value = None if None in values else sum(values, 0.0)
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        self.memo[piece] = value
        return value

    def open_piece(self, piece: str, times: int) -> dict:
        """A piece with words that are not held: its known part and those words."""
        if piece.isalpha():
            return {"known": 0.0, "times": times, "words": [piece]}
        words = words_of(piece)
        return {"known": sum((self.table[w] for w in words if w in self.table), 0.0), "times": times,
                "words": [w for w in words if w not in self.table]}

    def text(self, text: str | None) -> tuple[int, float, list[float], list[dict]]:
        """Number of pieces; sum and strongest different values of the pieces that
        are known here; the open pieces."""
        pieces = Counter(pieces_of(text))
        table, memo = self.table, self.memo
        values, times, rest = [], [], []
        for piece, n in pieces.items():
            value = table.get(piece)  # a piece that is a held word is that word alone
            if value is None and not piece.isalpha():
                value = memo[piece] if piece in memo else self.piece(piece)
            if value is None:
                rest.append(self.open_piece(piece, n))
            else:
                values.append(value)
                times.append(n)
        return pieces.total(), sum(map(operator.mul, values, times), 0.0), heapq.nlargest(STRONGEST, values), rest


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (intercept last), means and scales; Newton steps with a small ridge."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    keep = ridge * np.eye(len(w)) * len(x) / 100
    keep[-1, -1] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep + 1e-9 * np.eye(len(w)), z.T @ (y - p) - keep @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w, mean, scale


# --- jobs --------------------------------------------------------------------------
def worker_evidence(key: str, shared) -> Evidence:
    held = worker_cache().setdefault("evidence", {})
    if key not in held:
        held.clear()
        held[key] = Evidence(shared.value)
    return held[key]


def _held_words(counts: DataFrame, table: DataFrame | None, other: float, most: int) -> dict[str, float]:
    """Evidence of the most frequent words, ``most`` at most: whole classes of
    frequency (steps of 2^(1/8))."""
    step = F.floor(F.log2("whole") * 8)
    least, left = None, most
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():
        left -= r.n
        if left < 0:
            break
        least = r.step
    if least is None:
        return {}
    held = {r.word: other for r in counts.where(step >= least).select("word").collect()}
    if table is not None:
        held |= {r.word: r.value for r in table.where(step >= least).select("word", "value").collect()}
    return held


def measure_texts(documents: DataFrame, columns: list, schema: str, counts: DataFrame, table: DataFrame | None,
                  other: float, hot_words: int) -> DataFrame:
    """The columns with ``mean`` and ``peak`` evidence. The words a worker does not
    hold are joined to ``table``; without a row there, a word's evidence is ``other``."""
    spark = documents.sparkSession
    shared, key = spark.sparkContext.broadcast(_held_words(counts, table, other, hot_words)), uuid.uuid4().hex
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        own = worker_evidence(key, shared)

        def work(texts, *rest):
            n, total, strongest, open_pieces = zip(*map(own.text, texts))
            yield {"n": n, "total": total, "strongest": strongest, "open": open_pieces} | dict(zip(names, rest))

        return work

    texts = written_table(map_rows(
        documents, ["text", *columns], "n long, total double, strongest array<double>, "
        f"open array<struct<known: double, times: long, words: array<string>>>, {schema}", make)
        .withColumn("row", F.monotonically_increasing_id()), "texts")
    words = (texts.where(F.size("open") > 0).select("row", F.posexplode("open").alias("at", "piece"))
             .select("row", "at", "piece.known", "piece.times", F.explode("piece.words").alias("word")))
    value = F.lit(other)
    if table is not None:
        words, value = words.join(table.select("word", "value"), "word", "left"), F.coalesce("value", F.lit(other))
    pieces = words.repartition("row").groupBy("row", "at").agg(
        (F.first("known") + F.sum(value)).alias("value"), F.first("times").alias("times"))
    opened = pieces.groupBy("row").agg(
        F.sum(F.col("value") * F.col("times")).alias("opened"), F.collect_list("value").alias("others"))
    strongest = F.slice(F.sort_array(F.concat("strongest", F.coalesce("others", F.array().cast("array<double>"))),
                                     asc=False), 1, STRONGEST)
    return (texts.drop("open").join(opened, "row", "left").withColumn("strongest", strongest).select(
        *names, F.when(F.col("n") > 0, (F.col("total") + F.coalesce("opened", F.lit(0.0))) / F.col("n"))
        .otherwise(0.0).alias("mean"),
        F.when(F.col("n") > 0, F.aggregate("strongest", F.lit(0.0), lambda a, x: a + x) / F.size("strongest"))
        .otherwise(0.0).alias("peak")))


def score_toxicity(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
                   hot_words: int = HOT_WORDS) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence, peak_evidence`` per row."""
    trained = labelled_ids(labels, "toxic", 5, 0)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5))
    counts = written_table(count_words(documents, trained.where(fold != 0)), "words")
    totals = counts.agg(*[f(F.col(c)) for c in ("toxic", "ordinary") for f in (
        F.sum, lambda x: F.count_if(x > 0), lambda x: F.count_if(x == 1), lambda x: F.count_if(x == 2))]).first()
    totals = [tuple(x or 0 for x in totals[i:i + 4]) for i in (0, 4)]
    table, other = None, 0.0  # one class only: no evidence
    if all(t[0] for t in totals):
        other, n = other_evidence(totals), F.col("toxic") + F.col("ordinary")
        table = written_table(word_evidence(counts, totals).select(
            "word", "whole", (other + (F.col("value") - other) * n / (n + RELIABLE)).alias("value")), "evidence")
    kind = documents.schema["doc_id"].dataType.simpleString()
    measured = written_table(measure_texts(
        documents, ["doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out")],
        f"doc_id {kind}, held_out boolean", counts, table, other, hot_words), "measured")
    chosen = trained.where(fold == 0).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(fit_rows)
    fitted = measured.join(F.broadcast(chosen), "doc_id").select("mean", "peak", "label").collect()
    fitted = sorted(tuple(r) for r in fitted)
    x, y = np.array([r[:2] for r in fitted]).reshape(-1, 2), np.array([r[2] for r in fitted], float)
    if len(y) and y.min() < y.max():
        weights, mean, scale = fit_logistic(x, y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        weights, mean, scale = np.array([0, 0, math.log((share + 1e-6) / (1 - share + 1e-6))]), np.zeros(2), np.ones(2)
    z = sum((F.lit(float(w)) * (F.col(c) - float(m)) / float(s) for c, w, m, s in
             zip(("mean", "peak"), weights, mean, scale)), F.lit(float(weights[-1])))
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return measured.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
                           F.col("mean").alias("evidence"), F.col("peak").alias("peak_evidence"))


def op10_toxicity(spark, sf_dir):
    return score_toxicity(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")
