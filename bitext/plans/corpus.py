"""Corpus preparation job (U3): clean -> validate -> dedup -> filter -> split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import require_columns
from ..functions.text import normalize_cleaned
from ..operators.clean import clean_columns
from ..operators.split import check_ratios, filter_and_split, keep_pair, split_key, split_pairs
from ..session import written_table


def prepare_corpus(pairs: DataFrame, seed: int = 42, train_ratio: float = 0.7,
                   valid_ratio: float = 0.15, min_tokens: int = 2,
                   max_tokens: int = 80, max_length_ratio: float = 3.0,
                   mode: str = "exact", clean: bool = True,
                   source: str = "source", target: str = "target",
                   order_col: str = "line_no", min_pairs: int = 10,
                   materialize: bool = True) -> DataFrame:
    """Split-labelled pairs ``(line_no, source, target, split_key, split)``.

    One lazy plan with one row shuffle. Cleaning is a chain of projections;
    validity (F1) and the length filter (F3+F2 on the re-normalised text)
    depend only on the cleaned pair, so both ride through the de-duplication
    aggregate as ``max(flag)`` and are filtered on its output: each cleaning
    step runs once per row and no predicate drags the cleaning chain along.
    The exact split then adds two passes over its key column; with
    ``materialize`` (default) the de-duplicated pairs are written below the
    shared checkpoint folder first (an eager job), so that no pass repeats the cleaning.
    ``clean=False`` skips cleaning and de-duplication, as the reference allows.
    """
    check_ratios(train_ratio, valid_ratio)
    require_columns(pairs, source, target, order_col)
    if not clean:
        return filter_and_split(pairs, seed, train_ratio, valid_ratio, min_tokens,
                                max_tokens, max_length_ratio, mode, source, target,
                                order_col, min_pairs)
    cleaned = clean_columns(pairs, source, target)
    cleaned = cleaned.withColumns({"_ns": normalize_cleaned(source), "_nt": normalize_cleaned(target)})
    cleaned = cleaned.withColumn(
        "_keep", (F.col("_ns") != "") & (F.col("_nt") != "")
        & keep_pair("_ns", "_nt", min_tokens, max_tokens, max_length_ratio, normalized=True))
    kept = (cleaned.groupBy(source, target)
                   .agg(F.min(order_col).alias(order_col),
                        F.max("valid").alias("_valid"), F.max("_keep").alias("_keep"))
                   .filter("_valid AND _keep")
                   .select(order_col, normalize_cleaned(source).alias(source),
                           normalize_cleaned(target).alias(target)))
    written = mode == "exact" and materialize
    if written:
        # The exact split reads the keys, then the rows for their labels:
        # write the de-duplicated pairs once instead of re-running scan,
        # cleaning and the de-duplication shuffle for each pass.
        kept = written_table(kept.withColumn("split_key", split_key(seed, source, target, order_col)), "pairs")
    return split_pairs(kept, seed, train_ratio, valid_ratio, mode, source, target,
                       order_col, min_pairs, keyed=written)


def prepare_corpus_with_audit(pairs: DataFrame, seed: int = 42, train_ratio: float = 0.7,
                              valid_ratio: float = 0.15, min_tokens: int = 2,
                              max_tokens: int = 80, max_length_ratio: float = 3.0,
                              mode: str = "exact", source: str = "source",
                              target: str = "target", order_col: str = "line_no",
                              min_pairs: int = 10) -> tuple[DataFrame, DataFrame]:
    """``(split pairs, audit)`` from one pass over the raw pairs (U3 + A1 + A2).

    The cleaned rows are grouped once per cleaned pair, keeping the copy count,
    the modified count and the validity / non-empty / length flags, and that
    group table is written (eager). The split and a one-row audit
    (``input_rows output_rows modified_rows dropped_invalid dropped_dup loaded
    dropped_by_filter``) are both derived from it, so the raw data is scanned
    and cleaned once, like the reference's single pass with counters.
    """
    check_ratios(train_ratio, valid_ratio)
    require_columns(pairs, source, target, order_col)
    cleaned = clean_columns(pairs, source, target)
    cleaned = cleaned.withColumns({"_ns": normalize_cleaned(source), "_nt": normalize_cleaned(target)})
    cleaned = cleaned.withColumn("_nonempty", (F.col("_ns") != "") & (F.col("_nt") != "")).withColumn(
        "_keep", F.col("_nonempty")
        & keep_pair("_ns", "_nt", min_tokens, max_tokens, max_length_ratio, normalized=True))
    groups = cleaned.groupBy(source, target).agg(
        F.min(order_col).alias(order_col), F.count(F.lit(1)).alias("_n"),
        F.count_if("modified").alias("_n_mod"), F.max("valid").alias("_valid"),
        F.max("_nonempty").alias("_nonempty"), F.max("_keep").alias("_keep"))
    groups = written_table(groups, "pair-groups")
    valid = F.col("_valid")
    audit = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("input_rows"),
        F.count_if(valid).cast("long").alias("output_rows"),
        F.coalesce(F.sum("_n_mod"), F.lit(0)).cast("long").alias("modified_rows"),
        F.coalesce(F.sum(F.when(~valid, F.col("_n"))), F.lit(0)).cast("long").alias("dropped_invalid"),
        F.coalesce(F.sum(F.when(valid, F.col("_n") - 1)), F.lit(0)).cast("long").alias("dropped_dup"),
        F.count_if(valid & F.col("_nonempty")).cast("long").alias("loaded"),
        F.count_if(valid & F.col("_nonempty") & ~F.col("_keep")).cast("long").alias("dropped_by_filter"))
    kept = (groups.filter(valid & F.col("_keep"))
                  .select(order_col, normalize_cleaned(source).alias(source),
                          normalize_cleaned(target).alias(target)))
    split = split_pairs(kept, seed, train_ratio, valid_ratio, mode, source, target,
                        order_col, min_pairs)
    return split, audit


def split_summary(split: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Per split: pairs and token totals (sides are normalised, so tokens = spaces + 1)."""
    ntok = lambda c: F.size(F.split(F.col(c), " "))
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum(ntok(source)).cast("long").alias("src_tokens"),
        F.sum(ntok(target)).cast("long").alias("tgt_tokens"),
    )
