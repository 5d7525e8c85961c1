"""Corpus BLEU as Spark aggregates (A5), line alignment (J5), systems (U4).

Definition: Papineni et al. (2002); defaults of the standard tool (Post,
2018): 13a tokenisation, orders 1-4, one reference, exponential smoothing of
zero-match orders (Chen & Cherry, 2014), brevity penalty.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._util import require_columns
from ..functions.bleu_tokenize import MAX_ORDER, Tokens13a

# Output columns of ``bleu_stats``.
STAT_COLS = ([f"correct_{n}" for n in range(1, MAX_ORDER + 1)]
             + [f"total_{n}" for n in range(1, MAX_ORDER + 1)] + ["sys_len", "ref_len"])


def align_lines(hyp: DataFrame, ref: DataFrame, key: str = "line_no",
                hyp_col: str = "hypothesis", ref_col: str = "reference") -> DataFrame:
    """Positional zip of two line-keyed tables.

    Full outer equi-join on the line key; a line present on one side only
    fails the job (the reference refuses unequal line counts).
    """
    require_columns(hyp, key, hyp_col)
    require_columns(ref, key, ref_col)
    return zip_lines(hyp.select(key, hyp_col), ref.select(key, ref_col), key)


def zip_lines(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on a line key that fails on a key of one side only. The
    check is a filter, so no choice of columns (not even a count) skips it."""
    joined = left.withColumn("_left", F.lit(True)).join(right.withColumn("_right", F.lit(True)), key, "full_outer")
    alone = F.col("_left").isNull() | F.col("_right").isNull()
    complaint = F.raise_error(F.concat(F.lit("no partner for line "), F.col(key).cast("string")))
    return joined.filter(F.when(alone, complaint.cast("boolean")).otherwise(F.lit(True))).drop("_left", "_right")


def _grams(words: list[str], n: int) -> tuple[list, set]:
    """The n-grams of a line and the different ones among them."""
    grams = words if n == 1 else list(zip(*[words[k:] for k in range(n)]))
    return grams, set(grams)


def _clipped(h: list, h_set: set, r: list, r_set: set) -> int:
    """``sum_g min(h(g), r(g))``; n-grams are only counted where both sides repeat some."""
    both = h_set & r_set
    if both and len(h_set) < len(h) and len(r_set) < len(r):
        h_count, r_count = Counter(h), Counter(r)
        return sum(min(h_count[g], r_count[g]) for g in both)
    return len(both)


def _line_stats(ref: list[str], hyps: list[list[str]]) -> list[list[int]]:
    """The ``STAT_COLS`` of one sentence's words, per hypothesis. Without a match of an order
    there is none of a longer one."""
    orders, stats, ref_grams = range(1, MAX_ORDER + 1), [], []
    for words in hyps:
        total = [max(0, len(words) - n + 1) for n in orders]
        correct = total if words == ref else [0] * MAX_ORDER
        for n in orders if words != ref else ():
            if len(ref_grams) < n:
                ref_grams.append(_grams(ref, n))
            correct[n - 1] = _clipped(*_grams(words, n), *ref_grams[n - 1])
            if not correct[n - 1]:
                break
        stats.append([*correct, *total, len(words), len(ref)])
    return stats


def bleu_stats(df: DataFrame, hyp_col: str = "hypothesis", ref_col: str = "reference",
               group_cols=(), systems: dict[str, str] | None = None) -> DataFrame:
    """Sufficient statistics per group: ``correct_n``, ``total_n``, ``sys_len``, ``ref_len``.

    Every row is a sentence; with ``systems`` (name -> hypothesis column) it has several
    hypotheses, whose reference is cut up once, and ``system`` is one more group column.

    The lines of a sentence are cut up and matched where they are read, in Arrow batches; what
    leaves a row is one number per statistic, summed by group with map-side combine: no text is
    shuffled, and no row meets another one.
    """
    group_cols, hyps = list(group_cols), systems or {"": hyp_col}
    require_columns(df, *hyps.values(), ref_col, *group_cols)
    names, width = list(hyps), len(group_cols)
    keys = [df.schema[c] for c in group_cols] + ([T.StructField("system", T.StringType())] if systems else [])
    schema = T.StructType(keys + [T.StructField(c, T.LongType()) for c in STAT_COLS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens13a()
        for batch in batches:
            ref, *lines = [[tokens.of(t) if t else [] for t in c.to_pylist()] for c in batch.columns[width:]]
            found = [_line_stats(r, own) for r, own in zip(ref, zip(*lines))]
            for k, name in enumerate(names):
                stats = zip(*[row[k] for row in found]) if found else [()] * len(STAT_COLS)
                system = [pa.array([name] * batch.num_rows, pa.string())] if systems else []
                yield pa.RecordBatch.from_arrays(
                    batch.columns[:width] + system + [pa.array(c, pa.int64()) for c in stats], schema.names)

    lines = df.select(*group_cols, F.col(ref_col).alias("_r"), *[F.col(c).alias(f"_h{k}") for k, c in enumerate(hyps.values())])
    rows = lines.mapInArrow(run, schema)
    return rows.groupBy(*[k.name for k in keys]).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                                                      for c in STAT_COLS])


def bleu_score(stats_prefix: str = "") -> Column:
    """BLEU (0-100) from the statistic columns of ``bleu_stats``."""
    c = lambda name: F.col(stats_prefix + name)
    zeros = F.lit(0)
    logs = []
    for n in range(1, MAX_ORDER + 1):
        zeros = zeros + F.when(c(f"correct_{n}") == 0, 1).otherwise(0)
        p = F.when(c(f"correct_{n}") == 0,
                   F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * c(f"total_{n}")))
        p = p.otherwise(F.lit(100.0) * c(f"correct_{n}") / c(f"total_{n}"))
        logs.append(F.ln(p))
    sys_len, ref_len = c("sys_len"), c("ref_len")
    bp = F.when(sys_len >= ref_len, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - ref_len / sys_len))
    mean_log = sum(logs[1:], logs[0]) / F.lit(float(MAX_ORDER))
    # Smoothing is for some orders without a match, not for a text without any.
    matches = sum((c(f"correct_{n}") for n in range(2, MAX_ORDER + 1)), c("correct_1"))
    return F.when((c(f"total_{MAX_ORDER}") == 0) | (sys_len == 0) | (matches == 0), F.lit(0.0)).otherwise(bp * F.exp(mean_log))


def corpus_bleu(df: DataFrame, hyp_col: str = "hypothesis", ref_col: str = "reference",
                group_cols=(), digits: int | None = None, systems: dict[str, str] | None = None) -> DataFrame:
    """Statistics plus ``bleu`` per group (rounded to ``digits`` if given)."""
    stats = bleu_stats(df, hyp_col, ref_col, group_cols, systems)
    score = bleu_score()
    if digits is not None:
        score = F.round(score, digits)
    return stats.withColumn("bleu", score)


def evaluate_systems(df: DataFrame, systems: dict[str, str] | None = None, ref_col: str = "reference",
                     system_col: str = "system", hyp_col: str = "hypothesis", digits: int | None = None) -> DataFrame:
    """BLEU of several systems on the same references (U4): ``systems`` maps names to
    hypothesis columns; without it the rows are stacked and ``system_col`` names the system."""
    if systems:
        return corpus_bleu(df, ref_col=ref_col, digits=digits, systems=systems)
    return corpus_bleu(df, hyp_col, ref_col, [system_col], digits)
