"""Document translation job (U2) and positional reassembly (K5)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._util import explode_rows, require_columns
from ..functions.text import split_sentences
from ..operators.glossary import MAPPING_TYPE, protect_terms, restore_terms
from ..operators.memory import distinct_sentences, memory_upsert, newest_entries
from ..operators.translate import translate_batch
from ..session import written_table


#: Sentences per model task up to which they are dealt out for the model alone.
DEALT_ROWS = 10_000


class TranslationResult:
    """What a translation run gives. The model runs when ``translations``, ``memory`` or
    ``new_entries`` is first asked for, once for all of them; ``stats`` never needs it."""

    def __init__(self, sentences: DataFrame, distinct: DataFrame, predict, memory: DataFrame | None,
                 cache_enabled: bool):
        self._sentences, self._distinct, self._predict = sentences, distinct, predict
        self._memory, self._cache_enabled = memory, cache_enabled

    @cached_property
    def _fresh(self) -> DataFrame:
        return self._predict()

    @cached_property
    def translations(self) -> DataFrame:
        """``(doc_id, pos, sentence, translation, hit)``: every position filled."""
        # A distinct sentence is a hit or has a prediction: no join to put the two together.
        hits = self._distinct.where("hit").select("sentence", "hit", F.col("_old").alias("translation"))
        found = hits.unionByName(self._fresh.withColumn("hit", F.lit(False)))
        return self._sentences.join(found, "sentence", "left").select(
            "doc_id", "pos", "sentence", "translation", "hit")

    @cached_property
    def new_entries(self) -> DataFrame | None:
        """``(source, translation)`` of this run: what a memory snapshot has to hold. None
        when the cache is off."""
        return self._fresh.withColumnRenamed("sentence", "source") if self._cache_enabled else None

    @cached_property
    def memory(self) -> DataFrame | None:
        """The updated memory ``(source, translation)``, None when the cache is off."""
        if not self._cache_enabled or self._memory is None:
            return self.new_entries
        return memory_upsert(self._memory, self.new_entries)

    @cached_property
    def stats(self) -> DataFrame:
        """One row ``(positions, hits, pending)``."""
        counts = self._distinct.agg(
            F.coalesce(F.sum("occurrences"), F.lit(0)).cast("long").alias("positions"),
            F.count_if(~F.col("hit")).cast("long").alias("pending"))
        hits = F.col("positions") - F.col("pending") if self._cache_enabled else F.lit(0).cast("long")
        return counts.select("positions", hits.alias("hits"), "pending")


def _parallelism(df: DataFrame) -> int:
    try:
        return df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote session
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def segment_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, pos, sentence)`` rows (P8 + W2)."""
    require_columns(docs, id_col, text_col)
    return explode_rows(docs, [id_col], split_sentences(text_col), ("pos", "sentence"), True)


def translate_documents(sentences: DataFrame, predictor, glossary=None,
                        memory: DataFrame | None = None, glossary_enabled: bool = True,
                        cache_enabled: bool = True, batch_size: int = 4, model=None,
                        options: dict | None = None, model_partitions: int | None = None) -> TranslationResult:
    """Segmented sentences -> translations, with glossary and translation memory.

    Plan: distinct sentences (one map-side-combined aggregate) -> left join
    with the memory's newest entries -> written once -> protect -> model (Arrow
    batches) -> restore -> written: the model runs once -> one fan-out join back to
    every position. The large side is shuffled once; the memory join and the
    model see distinct text only. ``model`` and ``options`` reach the predictor
    (``translate_batch``). Every position of a repeated sentence is filled (the
    reference leaves earlier copies empty with the cache off; not reproduced) and
    ``hits`` is 0 when the cache is off.
    """
    require_columns(sentences, "doc_id", "pos", "sentence")
    d = distinct_sentences(sentences)
    if cache_enabled and memory is not None:
        mem = newest_entries(memory).select(F.col("source").alias("sentence"),
                                            F.col("translation").alias("_old"), F.lit(True).alias("hit"))
        d = d.join(mem, "sentence", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    else:
        d = d.withColumns({"_old": F.lit(None).cast("string"), "hit": F.lit(False)})
    d = written_table(d, "sentences")  # read by the model step, the fan-out and the counts

    def run_model() -> DataFrame:
        # Model calls are CPU-bound on little data: size partitions by work, not
        # bytes (AQE would pack the small distinct set into a few tasks).
        parts = model_partitions or 4 * _parallelism(sentences)
        pending = d.filter(~F.col("hit")).select("sentence")
        joined = glossary_enabled and glossary is not None
        if joined:
            pending = protect_terms(pending, "sentence", glossary, "_in", "_map")
        else:
            pending = pending.withColumns({"_in": F.col("sentence"), "_map": F.array().cast(MAPPING_TYPE)})
        # Many sentences leave the glossary join in a task per core or more: they are not dealt again.
        if model_partitions or not joined or d.count() < DEALT_ROWS * parts:
            pending = pending.repartition(parts, "sentence")
        predicted = translate_batch(pending, "_in", predictor, batch_size, "_raw", model, options)
        return written_table(predicted.select("sentence", restore_terms("_raw", "_map").alias("translation")),
                             "predictions")

    return TranslationResult(sentences, d, run_model, memory, cache_enabled)


def reassemble(translations: DataFrame, col: str = "translation", documents: DataFrame | None = None,
               id_col: str = "doc_id") -> DataFrame:
    """One row per document: translations joined by newline in position order (K5).

    A document's sentences came from one input row, so the collected list is
    bounded by that row. With ``documents`` every id of that table has a row,
    those without a sentence an empty text.
    """
    joined = (translations.groupBy(id_col)
                          .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce(col, F.lit(""))
                                                                     .alias("t")))).alias("_s"))
                          .select(id_col, F.array_join(F.col("_s.t"), "\n").alias(col)))
    if documents is None:
        return joined
    return documents.select(id_col).distinct().join(joined, id_col, "left").select(
        id_col, F.coalesce(F.col(col), F.lit("")).alias(col))
