"""Inputs of the registered queries, derived by Spark from the driver tables.

The driver tables are generic (documents, conversations, events). These
functions turn them into the shapes the bitext operators consume, so every
query's work grows with the tables:

* pairs      - documents split on newline; every line i is a source, line i+1
               its target (the last line's target is empty, so that F1/F3 drop
               it and A1 counts it); ``line_no = doc_id * 2**31 + i`` as a
               38-digit decimal, which holds any document id. Two
               deterministic defects are injected so cleaning has work:
               ``_`` before the source when ``doc_id % 7 = 0`` and a CR after
               the target when ``doc_id % 5 = 0``.
* sentences  - sentence segmentation of every document.
* memory     - sentences of the ``benchmark`` passages, translated as
               ``'[tm] ' || sentence`` (an earlier run's output).
* glossary   - ``DEMO_GLOSSARY`` below (configuration, not data), or the distinct
               words of the ``benchmark`` passages.
* garbled    - sentences whose accents were read in a wrong encoding.
* runs       - one experiment run per event (mapping below).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_sentences
from ..sources.layout import spread
from .._util import explode_rows

#: A text has fewer lines than this (a value holds less than 2**31 characters).
LINE_STRIDE = 1 << 31

# --- fixed values of the fixtures -------------------------------------------
# (ord, source_term, target_term); "the" is nested inside "and the".
DEMO_GLOSSARY = [
    (1, "and the", "y el"),
    (2, "the", "el"),
    (3, "and", "y"),
    (4, "de la", "of the"),
    (5, "der", "the"),
]
# event_type -> benchmark mode of the reference's experiment grid.
EVENT_MODES = {
    "view": "model_compare",
    "click": "glossary_compare",
    "signup": "batch_compare",
    "purchase": "beam_compare",
    "error": "cache_compare",
}
# Accented letters and the GBK characters of their two UTF-8 bytes.
GBK_READ = ("éñáüóíöäßúèêàç", "茅帽谩眉贸铆枚盲脽煤猫锚脿莽")
BATCH_SIZES = (1, 4, 8)
BEAM_SIZES = (1, 3, 5)
# ---------------------------------------------------------------------------


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table. With ``spark.bitext.spreadSmallInputs`` (off by
    default, for benchmarks on tiny files) few splits are dealt to all cores."""
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(table) if spark.conf.get("spark.bitext.spreadSmallInputs", "false") == "true" else table


def line_key(owner: str, line: str) -> "F.Column":
    """Number of a line of its owner; a decimal, since ids may be any long."""
    return (F.col(owner).cast("decimal(38,0)") * F.lit(LINE_STRIDE).cast("decimal(10,0)") + F.col(line)).cast(
        "decimal(38,0)")


def pairs_from_documents(documents: DataFrame) -> DataFrame:
    """``(line_no, source, target)`` of every line and the one after it. No shuffle."""
    # A column of its own: inside a lambda a text would be split again for every line.
    split = documents.select("doc_id", F.split(F.col("text"), "\n").alias("lines"))
    following = F.concat(F.slice("lines", F.lit(2), F.size("lines") - 1), F.array(F.lit("")))
    pairs = F.zip_with("lines", following, lambda x, y: F.struct(x.alias("source"), y.alias("target")))
    exploded = explode_rows(split, ["doc_id"], pairs, ("pos", "pair"), True).select(
        "doc_id", (F.col("pos") + 1).alias("i"), "pair.source", "pair.target")
    return exploded.select(
        line_key("doc_id", "i").alias("line_no"),
        F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("_"), "source")).otherwise(F.col("source")).alias("source"),
        F.when(F.col("doc_id") % 5 == 0, F.concat("target", F.lit("\r"))).otherwise(F.col("target")).alias("target"),
    )


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """Every turn paired with the next turn of its conversation; the last one, or
    one before a gap, with an empty target."""
    turns = conversations.select("conv_id", "turn", F.col("text").alias("source"))
    following = conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("target"))
    return turns.join(following, ["conv_id", "turn"], "left").select(
        line_key("conv_id", "turn").alias("line_no"),
        "source", F.coalesce("target", F.lit("")).alias("target"))


def sentences_from_documents(documents: DataFrame) -> DataFrame:
    """``(doc_id, pos, sentence)``; generator, no shuffle."""
    return explode_rows(documents, ["doc_id"], split_sentences("text"), ("pos", "sentence"), True)


def memory_from_benchmark(benchmark: DataFrame) -> DataFrame:
    """Translation memory ``(source, translation)`` with a unique key."""
    sent = explode_rows(benchmark, [], split_sentences("text"), ("source",))
    return sent.distinct().select("source", F.concat(F.lit("[tm] "), "source").alias("translation"))


def json_lines(memory: DataFrame, buckets: int = 8) -> DataFrame:
    """``(bucket, value)``: the memory as indented JSON objects, one per bucket, each
    bucket's lines in order within one partition."""
    bucket = F.pmod(F.xxhash64("source"), F.lit(buckets)).cast("int")
    entry = F.to_json(F.create_map("source", "translation"))
    entry = F.concat(F.lit("  "), entry.substr(F.lit(2), F.length(entry) - 2))
    rows = memory.select(bucket.alias("bucket"), F.lit(1).alias("part"), "source", entry.alias("value"))
    last = rows.groupBy("bucket").agg(F.max("source").alias("source"))
    rows = rows.join(last.withColumn("_last", F.lit(True)), ["bucket", "source"], "left").withColumn(
        "value", F.when(F.col("_last"), F.col("value")).otherwise(F.concat("value", F.lit(",")))).drop("_last")
    frame = last.select("bucket", F.explode(F.create_map(F.lit(0), F.lit("{"), F.lit(2), F.lit("}"))).alias("part", "value"))
    rows = rows.unionByName(frame.withColumn("source", F.lit("")))
    return rows.repartition("bucket").sortWithinPartitions("bucket", "part", "source").select("bucket", "value")


def memory_updates(memory: DataFrame) -> DataFrame:
    """A later run's entries: every source of even length again, with another text."""
    return memory.where(F.length("source") % 2 == 0).select("source", F.concat(F.lit("[new] "), "source").alias("translation"))


def glossary_from_benchmark(benchmark: DataFrame) -> DataFrame:
    """``(ord, source_term, target_term)``: every distinct word (two letters or more) of
    the passages in lower case, translated as its reverse."""
    words = explode_rows(benchmark, [], F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-öø-ÿ]{2,}"), F.lit(0)), ("word",))
    return words.distinct().select(F.ascii("word").alias("ord"), F.col("word").alias("source_term"),
                                   F.reverse("word").alias("target_term"))


def garbled_sentences(documents: DataFrame) -> DataFrame:
    """``(doc_id, pos, raw)``: sentences as they are, or (``doc_id % 3`` = 0) their UTF-8 bytes
    read as Latin-1, or (1) read as GBK where all their accents are in ``GBK_READ``."""
    s = sentences_from_documents(documents)
    text, kind = F.col("sentence"), F.col("doc_id") % 3
    plain = text.rlike("^[\\x{00}-\\x{7f}" + GBK_READ[0] + "]*$")
    return s.select("doc_id", "pos", F.when(kind == 0, F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")).when(
        (kind == 1) & plain, F.translate(text, *GBK_READ)).otherwise(text).alias("raw"))


def glossary_df(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or DEMO_GLOSSARY, "ord int, source_term string, target_term string")


def runs_from_events(events: DataFrame) -> DataFrame:
    """One run-metrics row per event, in ``event_id`` order (``row_no``)."""
    mode = F.create_map(*[x for kv in EVENT_MODES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    pick3 = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]),
                                        (F.col("event_id") % 3 + 1).cast("int"))
    cache_on = F.col("user_id") % 2 == 1
    n = (F.col("event_id") % 50 + 1).cast("int")
    return events.select(
        F.col("event_id").alias("row_no"),
        mode[F.col("event_type")].alias("mode"),
        F.when(F.col("user_id") % 2 == 0, "baseline").otherwise("finetuned").alias("model_type"),
        pick3(BATCH_SIZES).alias("batch_size"),
        pick3(BEAM_SIZES).alias("beam_size"),
        (F.col("event_id") % 2 == 0).alias("glossary_enabled"),
        cache_on.alias("cache_enabled"),
        F.col("value").alias("elapsed_raw"),
        n.alias("num_sentences"),
        F.when(cache_on, n).otherwise(0).alias("cache_hits"),
    )


def reverse_words(c) -> "F.Column":
    """Column twin of ``ReverseWordsPredictor`` (words of a line reversed)."""
    return F.array_join(F.reverse(F.split(c, " ")), " ")


def sentences_with_lang(documents: DataFrame) -> DataFrame:
    return explode_rows(documents, ["doc_id", "lang"], split_sentences("text"), ("pos", "sentence"), True)
