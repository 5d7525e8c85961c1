"""Translation memory: exact look-up, pending set, fan-out, upsert, hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import require_columns


def newest_entries(memory: DataFrame) -> DataFrame:
    """``(source, translation)`` with one row per source.

    With a ``snapshot`` column a key's newest snapshot decides, however many older
    ones hold it. Rows of the same snapshot, or without one, that repeat a key give
    the largest translation (NULL only if no row has one).
    """
    require_columns(memory, "source", "translation")
    if "snapshot" not in memory.columns:
        return memory.groupBy("source").agg(F.max("translation").alias("translation"))
    last = F.max(F.struct("snapshot", "translation"))
    return memory.groupBy("source").agg(last.alias("_last")).select("source", "_last.translation")


def memory_lookup(sentences: DataFrame, memory: DataFrame, text_col: str = "sentence") -> DataFrame:
    """Left equi-join on the exact, case-sensitive text.

    ``hit`` is *presence* of the key: a memory entry whose translation is
    ``""`` (or NULL) is still a hit. Shuffle join on the text; AQE turns it
    into a broadcast when the memory turns out small at runtime and splits
    skewed (very frequent) sentences. A repeated key counts once (``newest_entries``).
    """
    require_columns(sentences, text_col)
    mem = newest_entries(memory).select(F.col("source").alias(text_col),
                                        F.col("translation").alias("memory_translation"), F.lit(True).alias("hit"))
    return (sentences.join(mem, text_col, "left")
                     .withColumn("hit", F.coalesce(F.col("hit"), F.lit(False))))


def distinct_sentences(sentences: DataFrame, text_col: str = "sentence") -> DataFrame:
    """``(sentence, occurrences)``: one hash aggregate, map-side combined, so a
    sentence repeated across a third of the corpus is one row per map task."""
    return sentences.groupBy(text_col).agg(F.count(F.lit(1)).alias("occurrences"))


def pending_sentences(sentences: DataFrame, memory: DataFrame | None,
                      text_col: str = "sentence") -> DataFrame:
    """Distinct sentences not in memory, each to be translated once."""
    d = sentences.select(text_col).distinct()
    if memory is None:
        return d
    return d.join(memory.select(F.col("source").alias(text_col)), text_col, "left_anti")


def fan_out(sentences: DataFrame, results: DataFrame, text_col: str = "sentence",
            result_col: str = "translation") -> DataFrame:
    """Copy each distinct sentence's result to all its positions."""
    return sentences.join(results.select(text_col, result_col), text_col, "left")


def memory_upsert(memory: DataFrame, new: DataFrame) -> DataFrame:
    """New entries added; a new value replaces the old one for the same key.

    The result has one row per source; a key that either side repeats is reduced
    first (``newest_entries``). Written to a fresh snapshot by the caller (a path
    being read is never overwritten).
    """
    new = newest_entries(new).select("source", F.col("translation").alias("_new"), F.lit(True).alias("_is_new"))
    both = newest_entries(memory).join(new, "source", "full_outer")
    return both.select("source", F.when(F.col("_is_new"), F.col("_new")).otherwise(F.col("translation"))
                       .alias("translation"))


def memory_keys(df: DataFrame, *settings: str, text_col: str = "sentence") -> DataFrame:
    """``df`` with the memory key of each sentence in ``text_col`` (Q8): the text
    and the named setting columns (model, beam, glossary, ...) joined by U+001F, so
    that a hit never comes from other settings. Without settings the text itself."""
    require_columns(df, text_col, *settings)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in settings]
    return df.withColumn(text_col, F.concat_ws("\u001f", F.col(text_col), *parts)) if parts else df


def cache_hits(sentences: DataFrame, memory: DataFrame | None, text_col: str = "sentence") -> DataFrame:
    """One row ``(positions, hits, pending)`` (A4).

    Order-free form of the sequential count: a position is a hit when its
    sentence is in memory or repeats an earlier pending sentence, so
    ``hits = positions - distinct pending sentences``.
    """
    d = distinct_sentences(sentences, text_col)
    if memory is not None:
        d = d.join(memory.select(F.col("source").alias(text_col)).distinct().withColumn("_in_mem", F.lit(True)),
                   text_col, "left")
    else:
        d = d.withColumn("_in_mem", F.lit(None).cast("boolean"))
    pending = F.col("_in_mem").isNull()
    agg = d.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).cast("long").alias("positions"),
                F.count_if(pending).cast("long").alias("pending"))
    return agg.select("positions", (F.col("positions") - F.col("pending")).alias("hits"), "pending")
