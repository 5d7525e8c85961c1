"""Registered queries: one per operator of the inventory, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal the matching SQL in ``oracle_sql.py``. Every query reads whole
tables (or data Spark derives from them); nothing is sampled or capped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_float, token_count
from ..operators.bleu import align_lines, corpus_bleu, evaluate_systems
from ..operators.clean import clean_audit, clean_columns, clean_pairs
from ..operators.glossary import mapping_text, normalize_glossary, protect_terms, restore_terms
from ..operators.memory import cache_hits, fan_out, memory_lookup, memory_upsert, pending_sentences
from ..operators.runs import (RUN_FIELDS, best_rows, cache_compare, compare_runs, concat_runs, highlights, metrics_rows,
                              model_compare, repeat_rows, report_text, run_series, runs_for_mode, throughput)
from ..operators.split import enough_pairs, keep_pair, normalize_pairs, preprocess_audit, split_pairs
from ..operators.translate import ReverseWordsPredictor
from ..operators.vocab import build_vocab
from ..session import ensure_checkpoint_dir, written_table
from ..sources.layout import dealt
from ..sources.readers import (read_bitext, read_documents, read_glossary, read_memory, read_memory_json,
                               read_pairs_csv, read_runs_csv, read_translations, read_vocab)
from ..sources.writers import (write_memory, write_metrics, write_pairs, write_split_text, write_splits,
                               write_translations, write_vocab)
from . import fixtures as fx
from .corpus import prepare_corpus, prepare_corpus_with_audit, split_summary
from .documents import reassemble, translate_documents

Query = Callable[[SparkSession, str], DataFrame]


def _text_key(df: DataFrame) -> DataFrame:
    """Line keys as text: the same in every engine, whatever its widest integer."""
    return df.withColumn("line_no", F.col("line_no").cast("string"))


def _scratch(spark, name: str) -> str:
    """A fresh folder below the shared checkpoint directory; it stays, since the result
    is read from it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _docs(spark, d):
    return fx.load_table(spark, d, "documents")


def _pairs(spark, d):
    return fx.pairs_from_documents(_docs(spark, d))


def q_pairs_clean(spark, d):
    return _text_key(clean_pairs(_pairs(spark, d)))


def q_clean_audit(spark, d):
    return clean_audit(_pairs(spark, d))


def q_keep_pairs(spark, d):
    loaded = normalize_pairs(_pairs(spark, d))
    return _text_key(loaded.filter(keep_pair(normalized=True)))


def q_token_counts(spark, d):
    p = _pairs(spark, d)
    return _text_key(p.select("line_no", token_count("source").alias("src_tokens"),
                              token_count("target").alias("tgt_tokens")))


def q_split_exact(spark, d):
    return _text_key(split_pairs(normalize_pairs(_pairs(spark, d)), mode="exact"))


def q_split_hash(spark, d):
    return _text_key(split_pairs(normalize_pairs(_pairs(spark, d)), mode="hash"))


def q_split_counts(spark, d):
    loaded = normalize_pairs(_pairs(spark, d))
    kept = loaded.filter(keep_pair(normalized=True))
    return preprocess_audit(loaded, split_pairs(kept))


def q_prepare_corpus(spark, d):
    return _text_key(prepare_corpus(_pairs(spark, d)))


def q_corpus_summary(spark, d):
    return split_summary(prepare_corpus(_pairs(spark, d)))


def q_conversation_corpus(spark, d):
    pairs = fx.pairs_from_conversations(fx.load_table(spark, d, "conversations"))
    return _text_key(prepare_corpus(pairs, min_pairs=1))  # the smallest tables hold few long enough pairs


def _sentences(spark, d):
    return fx.sentences_from_documents(_docs(spark, d))


def _dealt_docs(spark, d):
    """Documents for steps that take long per sentence and shuffle nothing themselves."""
    return dealt(_docs(spark, d), "doc_id", "text")


def _memory(spark, d):
    return fx.memory_from_benchmark(fx.load_table(spark, d, "benchmark"))


def _glossary(spark):
    return fx.glossary_df(spark)


def q_vocab_src(spark, d):
    train = prepare_corpus(_pairs(spark, d)).filter(F.col("split") == "train")
    return build_vocab(train, "source")


def q_vocab_tgt(spark, d):
    train = prepare_corpus(_pairs(spark, d)).filter(F.col("split") == "train")
    return build_vocab(train, "target")


def q_sentences(spark, d):
    return _sentences(spark, d)


def q_glossary_protect(spark, d):
    p = protect_terms(fx.sentences_from_documents(_dealt_docs(spark, d)), "sentence", _glossary(spark))
    return p.select("doc_id", "pos", "protected", mapping_text("term_map").alias("terms"))


def q_glossary_restore(spark, d):
    p = protect_terms(fx.sentences_from_documents(_dealt_docs(spark, d)), "sentence", _glossary(spark))
    return p.select("doc_id", "pos", restore_terms("protected", "term_map").alias("restored"))


def q_memory_lookup(spark, d):
    return memory_lookup(_sentences(spark, d), _memory(spark, d))


def q_memory_pending(spark, d):
    return pending_sentences(_sentences(spark, d), _memory(spark, d))


def q_cache_hits(spark, d):
    return cache_hits(_sentences(spark, d), _memory(spark, d))


def q_memory_upsert(spark, d):
    pending = pending_sentences(_sentences(spark, d), _memory(spark, d))
    new = pending.select(F.col("sentence").alias("source"),
                         fx.reverse_words("sentence").alias("translation"))
    return memory_upsert(_memory(spark, d), new)


def _translate(spark, d, **kw):
    return translate_documents(_sentences(spark, d), ReverseWordsPredictor(),
                               glossary=_glossary(spark), memory=_memory(spark, d), **kw)


def q_translate_docs(spark, d):
    return _translate(spark, d).translations


def q_translate_stats(spark, d):
    return _translate(spark, d).stats


def q_translate_memory(spark, d):
    return _translate(spark, d).memory


def q_translate_nocache(spark, d):
    return _translate(spark, d, cache_enabled=False, glossary_enabled=False).translations


def q_translated_documents(spark, d):
    return reassemble(_translate(spark, d).translations)


SYSTEMS = {"baseline": "baseline_line", "finetuned": "finetuned_line"}


def _systems(spark, d):
    """Every sentence as the reference of two systems' lines."""
    p = protect_terms(fx.sentences_with_lang(_dealt_docs(spark, d)), "sentence", _glossary(spark))
    return p.select("lang", F.col("sentence").alias("reference"), fx.reverse_words("sentence").alias("baseline_line"),
                    restore_terms("protected", "term_map").alias("finetuned_line"))


def q_bleu_by_lang(spark, d):
    return corpus_bleu(_systems(spark, d), group_cols=("lang",), digits=6, systems=SYSTEMS)


def q_evaluate_systems(spark, d):
    return evaluate_systems(_systems(spark, d), SYSTEMS, digits=6)


def q_align_lines(spark, d):
    p = _pairs(spark, d)
    hyp = p.select("line_no", fx.reverse_words("source").alias("hypothesis"))
    ref = p.select("line_no", F.col("target").alias("reference"))
    return _text_key(align_lines(hyp, ref))


def _runs(spark, d):
    return throughput(fx.runs_from_events(fx.load_table(spark, d, "events")))


def q_throughput(spark, d):
    return _runs(spark, d).select("row_no", "mode", "model_type", "elapsed_time", "num_sentences",
                                  "sent_per_sec")


def q_best_run(spark, d):
    return best_rows(_runs(spark, d), "sent_per_sec").select(
        "mode", "row_no", "model_type", "batch_size", "beam_size", "sent_per_sec")


def q_model_compare(spark, d):
    return model_compare(_runs(spark, d))


def q_cache_compare(spark, d):
    return cache_compare(_runs(spark, d))


def _metrics(spark, d):
    bleu = evaluate_systems(_systems(spark, d), SYSTEMS)
    pair = bleu.agg(F.max(F.when(F.col("system") == "baseline", F.col("bleu"))).alias("baseline_bleu"),
                    F.max(F.when(F.col("system") == "finetuned", F.col("bleu"))).alias("finetuned_bleu"))
    return metrics_rows(pair, _runs(spark, d))


def q_metrics_rows(spark, d):
    return _metrics(spark, d)


def q_report_text(spark, d):
    """The metrics as the report prints them."""
    return report_text(_metrics(spark, d))


def q_run_series(spark, d):
    return run_series(_runs(spark, d), "batch_compare", "batch_size")


def q_highlights(spark, d):
    return highlights(_runs(spark, d))


def q_pairs_csv_roundtrip(spark, d):
    """K1 -> S1: cleaned pairs written as CSV (an eager write), then read back."""
    path = _scratch(spark, "pairs-csv")
    write_pairs(clean_pairs(_pairs(spark, d)), path, fmt="csv")
    return read_pairs_csv(spark, path).select("source", "target")


def q_bitext_roundtrip(spark, d):
    """K2 -> S2: both sides of the split files, and the training part read as bitext."""
    path = _scratch(spark, "split-text")
    split = written_table(prepare_corpus(_pairs(spark, d)), "split")
    for side in ("source", "target"):
        write_split_text(split, f"{path}/{side}", side)
    return read_bitext(spark, f"{path}/source/split=train", f"{path}/target/split=train")


def q_splits_roundtrip(spark, d):
    """K2 as Parquet: pairs per split folder."""
    path = _scratch(spark, "splits")
    write_splits(prepare_corpus(_pairs(spark, d)), path)
    return _text_key(spark.read.parquet(path)).select("line_no", "source", "target", "split_key", "split")


def q_documents_from_files(spark, d):
    """S3: one file per benchmark passage, read back as documents."""
    path = _scratch(spark, "documents")
    fx.load_table(spark, d, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    docs = read_documents(spark, path)
    item = F.url_decode(F.regexp_extract("doc_id", "item_id=([^/]*)/", 1))
    return docs.select(item.alias("item_id"), "text")


def q_glossary_roundtrip(spark, d):
    """A glossary file with blanks around its cells and repeated terms."""
    path = _scratch(spark, "glossary")
    terms = fx.glossary_from_benchmark(fx.load_table(spark, d, "benchmark"))
    twice = terms.select("source_term", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), F.concat(F.lit(" "), "target_term", F.lit("\u3000")).alias("target_term")),
        F.struct(F.lit(1).alias("copy"), F.concat(F.lit("2 "), "target_term").alias("target_term")))).alias("c"))
    rows = twice.where("c.copy = 0 OR length(source_term) % 2 = 0").select("source_term", "c.copy", "c.target_term")
    write_metrics(rows.orderBy("copy", "source_term").select("source_term", "target_term"), path)
    return normalize_glossary(read_glossary(spark, path)).select("ord", "source_term", "target_term")


def q_glossary_large(spark, d):
    """P9 with some thousand terms taken from the benchmark passages."""
    glossary = fx.glossary_from_benchmark(fx.load_table(spark, d, "benchmark"))
    p = protect_terms(fx.sentences_from_documents(_dealt_docs(spark, d)), "sentence", glossary)
    return p.select("doc_id", "pos", "protected", mapping_text("term_map").alias("terms"),
                    restore_terms("protected", "term_map").alias("restored"))


def q_memory_snapshots(spark, d):
    """K4, K7 -> read: two snapshots that share keys; the newer values count."""
    base = _scratch(spark, "memory")
    memory = _memory(spark, d)
    write_memory(memory, base, "20200101_000000")
    write_memory(fx.memory_updates(memory), base, "20200102_000000")
    return read_memory(spark, base)


def q_memory_json(spark, d):
    """JSON objects of one entry per line, one file per bucket of sources."""
    path = _scratch(spark, "memory-json")
    fx.json_lines(_memory(spark, d)).write.partitionBy("bucket").text(path)
    return read_memory_json(spark, path)


def q_runs_roundtrip(spark, d):
    """K6 -> S6: run metrics as CSV and back, rows numbered in file order."""
    path = _scratch(spark, "runs")
    write_metrics(_runs(spark, d).orderBy("row_no").select(*RUN_FIELDS), path)
    return read_runs_csv(spark, path)


def q_vocab_file(spark, d):
    """K3: the vocabulary's lines in rank order, read back."""
    path = _scratch(spark, "vocab")
    train = prepare_corpus(_pairs(spark, d)).filter(F.col("split") == "train")
    write_vocab(build_vocab(train, "target"), path)
    return read_vocab(spark, path)


def q_translations_text(spark, d):
    """K5 as text: documents with and without sentences written and read back by the manifest."""
    path = _scratch(spark, "translations")
    docs = _docs(spark, d)
    done = _sentences(spark, d).select("doc_id", "pos", fx.reverse_words("sentence").alias("translation"))
    some = done.where("doc_id % 10 <> 3")  # these documents stay, with an empty text
    write_translations(reassemble(some, documents=docs), path, fmt="text")
    return read_translations(spark, path)


def q_translated_texts(spark, d):
    """K5: one text per document, also for the documents without a sentence."""
    some = _sentences(spark, d).where("doc_id % 10 <> 3").select(
        "doc_id", "pos", fx.reverse_words("sentence").alias("translation"))
    return reassemble(some, documents=_docs(spark, d))


def q_mojibake_repair(spark, d):
    """P4 and P5 over sentences with injected defects of both kinds."""
    garbled = fx.garbled_sentences(_docs(spark, d))
    pairs = clean_columns(garbled.select("doc_id", "pos", "raw", F.col("raw").alias("source"),
                                         F.lit("x").alias("target")))
    return pairs.select("doc_id", "pos", "raw", F.col("source").alias("repaired"))


def q_safe_float_text(spark, d):
    """P11 on text: the first number inside every sentence."""
    return _sentences(spark, d).select("doc_id", "pos", safe_float("sentence").alias("number"))


def q_concat_runs(spark, d):
    """The result rows of several experiment cases appended."""
    runs = _runs(spark, d)
    cases = [runs_for_mode(runs, m).select("row_no", "mode", "batch_size", "elapsed_time")
             for m in ("batch_compare", "beam_compare", "cache_compare")]
    return concat_runs(*cases)


def q_pair_checks(spark, d):
    """per language the pairs left by the length filter, and whether they suffice."""
    p = fx.pairs_from_documents(_docs(spark, d)).withColumn(
        "doc_id", F.expr(f"CAST(line_no div {fx.LINE_STRIDE} AS BIGINT)"))
    kept = normalize_pairs(p).filter(keep_pair(normalized=True))
    return enough_pairs(kept.join(_docs(spark, d).select("doc_id", "lang"), "doc_id"), "lang", min_pairs=500)


def q_corpus_audit(spark, d):
    return prepare_corpus_with_audit(_pairs(spark, d))[1]


def q_corpus_audited_split(spark, d):
    return _text_key(prepare_corpus_with_audit(_pairs(spark, d))[0])


def q_stream_clean(spark, d):
    """Streaming cleaning (available-now trigger) of the derived pairs, landed
    as files under the shared checkpoint folder and read back as a table."""
    from ..streaming.cleaning import clean_pairs_stream, start_parquet_sink
    base = _scratch(spark, "stream")
    pairs = _pairs(spark, d)
    pairs.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(pairs.schema).parquet(f"{base}/in")
    q = start_parquet_sink(clean_pairs_stream(stream), f"{base}/out", name=f"clean_{uuid.uuid4().hex[:8]}",
                           checkpoint=f"{base}/progress")
    q.awaitTermination()
    return _text_key(spark.read.parquet(f"{base}/out").select("line_no", "source", "target"))


def q_compare_beams(spark, d):
    return compare_runs(_runs(spark, d), "beam_compare", "beam_size", 1, 5)


def q_fan_out(spark, d):
    pending = pending_sentences(_sentences(spark, d), _memory(spark, d))
    results = pending.select("sentence", fx.reverse_words("sentence").alias("translation"))
    return fan_out(_sentences(spark, d), results)


def q_repeat_rows(spark, d):
    return repeat_rows(_sentences(spark, d), 6)


QUERIES: dict[str, Query] = {
    "pairs_clean": q_pairs_clean,
    "clean_audit": q_clean_audit,
    "keep_pairs": q_keep_pairs,
    "token_counts": q_token_counts,
    "split_exact": q_split_exact,
    "split_hash": q_split_hash,
    "split_counts": q_split_counts,
    "prepare_corpus": q_prepare_corpus,
    "corpus_summary": q_corpus_summary,
    "conversation_corpus": q_conversation_corpus,
    "vocab_src": q_vocab_src,
    "vocab_tgt": q_vocab_tgt,
    "sentences": q_sentences,
    "glossary_protect": q_glossary_protect,
    "glossary_restore": q_glossary_restore,
    "memory_lookup": q_memory_lookup,
    "memory_pending": q_memory_pending,
    "cache_hits": q_cache_hits,
    "memory_upsert": q_memory_upsert,
    "translate_docs": q_translate_docs,
    "translate_stats": q_translate_stats,
    "translate_memory": q_translate_memory,
    "translate_nocache": q_translate_nocache,
    "translated_documents": q_translated_documents,
    "bleu_by_lang": q_bleu_by_lang,
    "evaluate_systems": q_evaluate_systems,
    "align_lines": q_align_lines,
    "throughput": q_throughput,
    "best_run": q_best_run,
    "model_compare": q_model_compare,
    "cache_compare": q_cache_compare,
    "metrics_rows": q_metrics_rows,
    "run_series": q_run_series,
    "highlights": q_highlights,
    "repeat_rows": q_repeat_rows,
    "pairs_csv_roundtrip": q_pairs_csv_roundtrip,
    "compare_beams": q_compare_beams,
    "corpus_audit": q_corpus_audit,
    "corpus_audited_split": q_corpus_audited_split,
    "stream_clean": q_stream_clean,
    "fan_out": q_fan_out,
    "report_text": q_report_text,
    "bitext_roundtrip": q_bitext_roundtrip,
    "splits_roundtrip": q_splits_roundtrip,
    "documents_from_files": q_documents_from_files,
    "glossary_roundtrip": q_glossary_roundtrip,
    "glossary_large": q_glossary_large,
    "memory_snapshots": q_memory_snapshots,
    "memory_json": q_memory_json,
    "runs_roundtrip": q_runs_roundtrip,
    "vocab_file": q_vocab_file,
    "translations_text": q_translations_text,
    "translated_texts": q_translated_texts,
    "mojibake_repair": q_mojibake_repair,
    "safe_float_text": q_safe_float_text,
    "concat_runs": q_concat_runs,
    "pair_checks": q_pair_checks,
}
