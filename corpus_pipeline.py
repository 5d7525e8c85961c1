"""Training-corpus pipeline over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each stage's result as Parquet under the shared checkpoint folder and reads it
back as the next one's ``docs``, so a lost executor never repeats an earlier stage.
All but the last return the columns of ``documents``. ``n_chars`` follows the text.

* quality: documents that the quality classifier rejects (score below 0.5) go.
  The classifier is fitted on the labelled ones among the documents it is given.
* near_duplicates: of each component of similar documents the smallest doc_id
  stays (with all rows of that id); texts without words are linked with nothing.
* repeated_passages: words covered by 50-word windows of an earlier document go.
  A text that loses nothing stays as it is; a changed one is its kept words
  joined by single blanks.
* decontamination: documents contaminated by benchmark items go.
* tokens: adds ``n_tokens, ids_sha256, decoded_sha256`` of the byte-level BPE round trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.llm._common import load_table
from bitext.llm.bpe import bpe_round_trip
from bitext.llm.decontaminate import decontaminate
from bitext.llm.quality import score_quality
from bitext.llm.similarity_join import similar_components
from bitext.llm.substring_dedup import remove_repeats
from bitext.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
OTHERS = ["text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score_quality(docs, load_table(spark, sf_dir, "labels"), columns=OTHERS)
    return scored.where("predicted = 1").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = similar_components(docs)
    gone = placed.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.select(COLUMNS).join(gone, "doc_id", "left_anti").select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def row(text, n_removed, kept):
        kept = kept.decode("utf-8", "surrogatepass") if n_removed else text
        return kept, None if kept is None else len(kept)

    return remove_repeats(docs, columns=["lang", "source"], schema="text string, n_chars long", make_row=row).select(
        COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = decontaminate(docs, load_table(spark, sf_dir, "benchmark"), columns=OTHERS)
    return marked.where("NOT contaminated").select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_round_trip(docs, columns=OTHERS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontamination", decontamination), ("tokens", tokens)]

#: The classifier cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents of ``sf_dir``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = load_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}_{name}")
        docs = spark.read.parquet(f"{folder}/{number}_{name}")
    return docs
