"""Pair cleaning: repair, validate, de-duplicate, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._util import as_col, require_columns
from ..functions.text import (DROPPED_EXACT_SOURCES, accept_gbk, accept_latin1, finish_side, gbk_escapes,
                              latin1_candidate)


def valid_pair(source="source", target="target") -> Column:
    """Validity rule of a cleaned pair (F1).

    Non-empty sides; source not a known placeholder text; both sides at
    least two code points; identical sides only when longer than three.
    """
    s, t = as_col(source), as_col(target)
    return (
        (s != "") & (t != "")
        & ~F.lower(s).isin(*DROPPED_EXACT_SOURCES)
        & (F.length(s) >= 2) & (F.length(t) >= 2)
        & ~((s == t) & (F.length(s) <= 3))
    )


def clean_columns(df: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Add cleaned ``source``/``target`` plus ``modified`` and ``valid`` flags.

    Per side: Latin-1 repair -> GBK repair -> control chars -> whitespace ->
    underscores. Each step is its own projection over named columns, so an
    expensive step is computed once instead of being inlined into every
    later reference. ``modified`` compares cleaned with raw text before
    validity, NULL raw counting as changed (NULL becomes ``""``). No shuffle.
    """
    require_columns(df, source, target)
    sides = {source: "_raw_s", target: "_raw_t"}
    out = df.withColumns({raw: F.col(side) for side, raw in sides.items()})
    out = out.withColumns({side: F.coalesce(F.col(raw), F.lit("")) for side, raw in sides.items()})
    out = out.withColumns({f"_cand_{raw}": latin1_candidate(side) for side, raw in sides.items()})
    out = out.withColumns({side: accept_latin1(side, f"_cand_{raw}") for side, raw in sides.items()})
    out = out.withColumns({f"_gbk_{raw}": gbk_escapes(side) for side, raw in sides.items()})
    out = out.withColumns({side: accept_gbk(side, f"_gbk_{raw}") for side, raw in sides.items()})
    out = out.withColumns({side: finish_side(side) for side in sides})
    modified = ~(F.col(source).eqNullSafe(F.col("_raw_s")) & F.col(target).eqNullSafe(F.col("_raw_t")))
    out = out.withColumn("modified", modified).withColumn("valid", valid_pair(source, target))
    return out.drop(*[f"{prefix}{raw}" for raw in sides.values() for prefix in ("", "_cand_", "_gbk_")])


def dedup_pairs(df: DataFrame, source: str = "source", target: str = "target",
                order_col: str | None = "line_no") -> DataFrame:
    """Exact ``(source, target)`` de-duplication keeping the first row.

    Output ``(order_col, source, target)``: "first" is the smallest
    ``order_col``; without one any copy is kept (same set of pairs). Either
    way it is one hash aggregate with a map-side partial step, so a pair
    repeated a billion times costs one row per map task in the shuffle.
    """
    if order_col is None:
        return df.select(source, target).dropDuplicates([source, target])
    return (df.groupBy(source, target).agg(F.min(order_col).alias(order_col))
              .select(order_col, source, target))


def clean_pairs(df: DataFrame, source: str = "source", target: str = "target",
                order_col: str | None = "line_no") -> DataFrame:
    """Cleaned, valid, de-duplicated pairs (P6 -> F1 -> D1).

    Validity is a function of the cleaned pair, so it is carried through the
    de-duplication aggregate (``max(valid)`` per pair) and filtered on the
    aggregate's output. A filter on the cleaned columns themselves would be
    pushed back through the cleaning projections by the optimizer, inlining
    (and re-running) every cleaning step inside the predicate.
    """
    cleaned = clean_columns(df, source, target)
    aggs = [F.max("valid").alias("_valid")]
    if order_col is not None:
        aggs.insert(0, F.min(order_col).alias(order_col))
    grouped = cleaned.groupBy(source, target).agg(*aggs).filter("_valid")
    cols = ([order_col] if order_col is not None else []) + [source, target]
    return grouped.select(*cols)


def clean_audit(df: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """One-row audit: input, output, modified, dropped_invalid, dropped_dup (A1).

    Validity depends only on the cleaned pair, so one grouping by the cleaned
    pair yields every counter: a partial+final hash aggregate, then a
    single-row global aggregate over the groups.
    """
    cleaned = clean_columns(df, source, target)
    groups = cleaned.groupBy(source, target).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("modified").alias("n_modified"),
        F.first("valid").alias("valid"),
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("input_rows"),
        F.count_if("valid").cast("long").alias("output_rows"),
        F.coalesce(F.sum("n_modified"), F.lit(0)).cast("long").alias("modified_rows"),
        F.coalesce(F.sum(F.when(~F.col("valid"), F.col("n"))), F.lit(0)).cast("long").alias("dropped_invalid"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("n") - 1)), F.lit(0)).cast("long").alias("dropped_dup"),
    )
